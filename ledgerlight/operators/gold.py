"""Labels, ratios, the Z' score and trends on top of silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions import scores
from ledgerlight.functions.values import cik_key, pad_cik, to_float, to_int
from ledgerlight.operators.silver import ensure_columns

PREVIOUS = {
    "revenue": "prev_revenue",
    "net_income": "prev_net_income",
    "assets_total": "prev_assets",
    "equity": "prev_equity",
}


def trend() -> WindowSpec:
    """One filing form of one company over time.

    Silver has one row per company and period end, so such a group is bounded by the calendar whatever the
    number of facts behind it.
    """
    return Window.partitionBy("cik", "form_type").orderBy("period_end")


def universe_labels(universe: DataFrame) -> DataFrame:
    """Typed labels and enrichment out of the all-text universe; absent columns come back as nulls."""
    readers = {"int": to_int, "double": to_float, "string": F.col}
    kinds = {"distress_label": "int", "distress_event_date": "string", "distress_event_type": "string"}
    kinds |= K.ENRICHMENT_TYPES
    typed = universe.select(
        pad_cik("cik").alias("cik"),
        *[readers[kind](name).alias(name) for name, kind in kinds.items() if name in universe.columns],
    )
    return ensure_columns(typed, kinds).select("cik", *kinds)


def join_labels(silver: DataFrame, labels: DataFrame) -> DataFrame:
    """Every silver row with positive assets, with its company's label; companies outside get label 0.

    The universe has one row per company. No broadcast is forced: Spark broadcasts it below its own size
    threshold, and above it joins on ``cik``, where no company has more rows than it has period ends.
    """
    key = labels.withColumn("cik", cik_key("cik"))
    scored = silver.filter(F.col("assets_total") > 0)
    joined = scored.join(key, "cik", "left")
    return joined.withColumn("distress_label", F.coalesce("distress_label", F.lit(0)))


def with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(scores.z_ratios())


def with_z_score(df: DataFrame) -> DataFrame:
    return df.withColumn("altman_z_score", scores.z_score())


def with_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("distress_zone", scores.z_zone("altman_z_score"))


def with_previous(df: DataFrame) -> DataFrame:
    """Values of the row before, of the same company and form."""
    return df.withColumns({alias: F.lag(name).over(trend()) for name, alias in PREVIOUS.items()})


def with_growth(df: DataFrame) -> DataFrame:
    """Relative change to the row before; needs `with_previous`."""
    return df.withColumns({
        "revenue_growth_qoq": scores.growth("revenue", F.col("prev_revenue")),
        "net_income_growth_qoq": scores.growth("net_income", F.col("prev_net_income"), signed=True),
        "asset_growth_qoq": scores.growth("assets_total", F.col("prev_assets")),
    })


def declining(name: str, steps: int = 3) -> Column:
    """1 when the value fell at each of the last ``steps`` steps, else 0; a missing value breaks the run."""
    series = [F.col(name), *[F.lag(name, i).over(trend()) for i in range(1, steps + 1)]]
    falling = F.lit(True)
    for newer, older in zip(series, series[1:]):
        falling = falling & (newer < older)
    return F.when(falling, 1).otherwise(0)


def with_declines(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "revenue_declining_3q": declining("revenue"),
        "net_income_declining_3q": declining("net_income"),
    })


def score_and_trend(base: DataFrame) -> DataFrame:
    scored = with_zone(with_z_score(with_ratios(base)))
    return with_growth(with_declines(with_previous(scored)))


def gold_ordered(gold: DataFrame) -> DataFrame:
    """Presentation order. Period end is part of the key, so one company's rows may span tasks."""
    return gold.orderBy("cik", "period_end")


def zone_counts(df: DataFrame, zone: str = "distress_zone") -> DataFrame:
    return df.filter(F.col(zone).isNotNull()).groupBy(F.col(zone).alias("zone")).agg(F.count("*").alias("n"))
