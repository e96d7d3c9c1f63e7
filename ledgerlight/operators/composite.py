"""The composite score: Z', text signals and trends blended to 0 ... 1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions import scores
from ledgerlight.functions.values import bare_cik, cik_key, clamp, classify_outcome, to_float
from ledgerlight.operators.silver import first_row, sort_key

SIGNAL_DEFAULTS = {
    "llm_component": K.NEUTRAL,
    "avg_sentiment_score": 0.0,
    "avg_risk_level": "unknown",
    "any_going_concern": 0,
    "any_liquidity_risk": 0,
    "any_restructuring": 0,
    "n_docs_analysed": 0,
}
ANY_FLAGS = {
    "going_concern": "any_going_concern",
    "liquidity_risk": "any_liquidity_risk",
    "restructuring": "any_restructuring",
}
TEXT_FEATURE_SCHEMA = "cik STRING, sentiment_score DOUBLE, risk_level STRING, " + ", ".join(
    f"{flag} INT" for flag in K.FLAG_WEIGHTS
)


def with_defaults(df: DataFrame, spec: dict[str, tuple[str, object]]) -> DataFrame:
    """Add absent columns with a typed default value."""
    missing = {name: F.lit(value).cast(kind) for name, (kind, value) in spec.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def normalise_cik(df: DataFrame, col: str = "cik") -> DataFrame:
    return df.withColumn("cik_norm", bare_cik(col))


def doc_signals(features: DataFrame) -> DataFrame:
    """Distress signals per document. Absent columns count as no signal, an absent score as neutral."""
    whole = with_defaults(
        features,
        {"risk_level": ("string", None), "sentiment_score": ("double", None)}
        | {flag: ("int", 0) for flag in K.FLAG_WEIGHTS},
    )
    flags = {name: F.coalesce(to_float(name), F.lit(0.0)) for name in K.FLAG_WEIGHTS}
    flag_score = scores.weighted_sum(
        [(weight, clamp(flags[name], 0.0, 1.0)) for name, weight in K.FLAG_WEIGHTS.items()]
    )
    distress = (F.lit(1.0) - clamp(F.col("sentiment_score"), -1.0, 1.0)) / F.lit(2.0)
    if "sentiment_score" not in features.columns:
        distress = F.lit(K.NEUTRAL)
        whole = whole.withColumn("sentiment_score", F.lit(K.NEUTRAL))
    return whole.withColumns({
        "sent_distress": distress,
        "risk_points": scores.risk_points("risk_level"),
        "flag_score": clamp(flag_score, 0.0, 1.0),
        **{f"{name}_value": flags[name] for name in ANY_FLAGS},
    })


def company_signals(features: DataFrame) -> DataFrame:
    """One row per company with text. Partial sums per task keep a company of any size cheap to shuffle."""
    documents = doc_signals(features).withColumn("cik", cik_key("cik"))
    totals = documents.groupBy("cik").agg(
        F.avg("sent_distress").alias("mean_distress"),
        (F.sum("risk_points") / F.lit(100.0) / F.count("*")).alias("mean_risk"),
        F.max("flag_score").alias("max_flag_score"),
        F.avg("sentiment_score").alias("avg_sentiment_score"),
        *[F.max(f"{name}_value").alias(alias) for name, alias in ANY_FLAGS.items()],
        F.count("*").alias("n_docs_analysed"),
    )
    component = scores.weighted_sum([
        (K.SIGNAL_WEIGHTS["sentiment"], F.col("mean_distress")),
        (K.SIGNAL_WEIGHTS["risk"], F.col("mean_risk")),
        (K.SIGNAL_WEIGHTS["flags"], F.col("max_flag_score")),
    ])
    return totals.select(
        "cik",
        clamp(component, 0.0, 1.0).alias("llm_component"),
        "avg_sentiment_score",
        scores.risk_label("mean_risk").alias("avg_risk_level"),
        *ANY_FLAGS.values(),
        "n_docs_analysed",
    )


def with_components(gold: DataFrame) -> DataFrame:
    """Z and trend components; absent trend columns count as no signal."""
    whole = with_defaults(gold, {name: ("double", None) for name in K.TREND_WEIGHTS})
    scored = whole.withColumns({
        "z_component": scores.z_component("altman_z_score"), "trend_component": scores.trend_component(),
    })
    return scored.drop(*[name for name in K.TREND_WEIGHTS if name not in gold.columns])


def join_signals(gold: DataFrame, signals: DataFrame) -> DataFrame:
    """Attach company signals; a company without text is neutral.

    One signal row per company; the join strategy is left to Spark's own size checks.
    """
    joined = gold.join(signals, "cik", "left")
    filled = {
        name: F.coalesce(
            F.col(name).cast("int") if isinstance(value, int) else F.col(name), F.lit(value)
        )
        for name, value in SIGNAL_DEFAULTS.items()
    }
    return joined.withColumns(filled)


def score_composite(joined: DataFrame) -> DataFrame:
    scored = joined.withColumn("composite_score", scores.composite_score())
    outcome = F.lit("unknown")
    if "brd_after_emerging" in joined.columns:
        outcome = classify_outcome("brd_after_emerging")
    return scored.withColumns({
        "composite_zone": scores.composite_zone("composite_score"),
        "after_emerging_class": outcome,
    })


def empty_text_features(gold: DataFrame) -> DataFrame:
    """A typed table without rows, for runs that have no text."""
    return gold.sparkSession.createDataFrame([], TEXT_FEATURE_SCHEMA)


def top_distress(composite: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest scores in the distress zone, one row per company name."""
    zone = composite.filter(F.col("composite_zone") == "distress").select(
        "cik", "company_name", "period_end", "composite_score", "z_component", "llm_component",
        "trend_component", "composite_zone",
    )
    order = ["composite_score DESC", "cik", "period_end"]
    best = first_row(zone, ["company_name"], order)
    return best.orderBy(*[sort_key(term) for term in order]).limit(n)
