"""The queries behind the dashboard; drawing is left to the user's tool."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions.values import cik_key, group_name
from ledgerlight.operators.quantiles import exact_median, five_numbers
from ledgerlight.operators.silver import first_row

FIRST = ["cik", "period_end"]  # the stored order of gold and composite rows


def filing_types(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col("form_type").isNotNull()).select("form_type").distinct().orderBy("form_type")


def year_bounds(gold: DataFrame) -> DataFrame:
    bounds = gold.agg(F.min("period_end").alias("first"), F.max("period_end").alias("last"))
    return bounds.select(F.year("first").alias("year_min"), F.year("last").alias("year_max"))


def slice_rows(
    df: DataFrame, forms: list[str], years: tuple[int, int] | None = None, label: int | None = None
) -> DataFrame:
    """Rows of some forms, an inclusive range of years and optionally one label.

    The years become bounds on the date itself, which Parquet statistics can use.
    """
    chosen = df.filter(F.col("form_type").isin(forms))
    if years:
        first, last = datetime.date(years[0], 1, 1), datetime.date(years[1], 12, 31)
        chosen = chosen.filter(F.col("period_end").between(F.lit(first), F.lit(last)))
    return chosen if label is None else chosen.filter(F.col("distress_label") == label)


def _distress_percent(zone: str) -> Column:
    return F.lit(100.0) * F.count_if(F.col(zone) == "distress") / F.greatest(F.count(zone), F.lit(1))


def gold_kpis(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count_distinct("cik").alias("companies"),
        F.count("*").alias("periods"),
        F.count("altman_z_score").alias("scored"),
        F.avg("altman_z_score").alias("mean_z"),
        _distress_percent("distress_zone").alias("distress_pct"),
    )


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts over equal bins of [low, high]; the upper end belongs to the last bin."""
    known = df.filter(F.col(value).isNotNull())
    bin_number = F.least(F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    return known.groupBy(bin_number.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def z_histogram(gold: DataFrame) -> DataFrame:
    return histogram(gold, "altman_z_score", -K.Z_LIMIT, K.Z_LIMIT, K.Z_BINS)


def composite_histogram(composite: DataFrame) -> DataFrame:
    return histogram(composite, "composite_score", 0.0, 1.0, K.COMPOSITE_BINS)


def median_over_time(df: DataFrame, value: str) -> DataFrame:
    """Median per period end and label."""
    scored = df.filter(F.col(value).isNotNull())
    scored = scored.select("period_end", "distress_label", value)
    medians = exact_median(scored, ["period_end", "distress_label"], value, "median_value")
    return medians.select("period_end", group_name("distress_label").alias("company_type"), "median_value")


def top_companies(df: DataFrame, value: str, n: int = K.TOP_COMPANIES) -> DataFrame:
    """Companies with the most scored rows; ties in name order."""
    known = df.filter(F.col(value).isNotNull())
    counts = known.groupBy("company_name").agg(F.count("*").alias("n_scored"))
    return counts.orderBy(F.desc("n_scored"), F.asc("company_name")).limit(n)


def of_companies(df: DataFrame, companies: DataFrame | list[str]) -> DataFrame:
    """Rows of selected companies, given as names or as the top few rows of `top_companies`."""
    if isinstance(companies, list):
        return df.filter(F.col("company_name").isin(companies))
    return df.join(companies.select("company_name"), "company_name", "left_semi")


def z_timeline(gold: DataFrame, companies: DataFrame | list[str]) -> DataFrame:
    scored = gold.filter(F.col("altman_z_score").isNotNull())
    return of_companies(scored, companies).select("company_name", "cik", "period_end", "altman_z_score")


def trend_flag_totals(gold: DataFrame) -> DataFrame:
    flags = {
        "revenue_declining_3q": "Revenue declining 3Q+",
        "net_income_declining_3q": "Net income declining 3Q+",
    }
    totals = gold.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(label) for name, label in flags.items()])
    return totals.unpivot([], list(flags.values()), "flag", "n")


def revenue_growth_spread(gold: DataFrame) -> DataFrame:
    spread = five_numbers(gold, ["distress_label"], "revenue_growth_qoq")
    return spread.withColumn(
        "company_type", group_name("distress_label", K.SHORT_GROUP_NAMES)
    ).drop("distress_label")


def company_names(gold: DataFrame) -> DataFrame:
    """One name per company, the one of its latest period."""
    last = F.max(F.struct("period_end", "company_name"))
    return gold.groupBy("cik").agg(last.alias("last")).select("cik", "last.company_name")


def named_texts(text_features: DataFrame, gold: DataFrame) -> DataFrame:
    """Text rows with their company's name; adaptive execution splits a company with very many texts."""
    keyed = text_features.withColumn("_key", cik_key("cik"))
    names = company_names(gold).withColumnRenamed("cik", "_key")
    joined = keyed.join(names, "_key", "left").drop("_key")
    return joined.withColumn("company_name", F.coalesce("company_name", F.lit("Unknown")))


def text_kpis(text_features: DataFrame) -> DataFrame:
    negative = F.coalesce(F.col("sentiment_score") < -0.2, F.lit(False))
    return text_features.agg(
        F.count("*").alias("documents"),
        F.count_distinct("cik").alias("companies"),
        (F.avg("going_concern") * 100).alias("going_concern_pct"),
        (F.avg(negative.cast("int")) * 100).alias("negative_pct"),
    )


def sentiment_spread(text_features: DataFrame) -> DataFrame:
    return five_numbers(text_features, ["section"], "sentiment_score")


def risk_level_counts(text_features: DataFrame) -> DataFrame:
    """Documents per known risk level, in order of severity."""
    position = F.array_position(F.array(*[F.lit(level) for level in K.RISK_LEVELS]), F.col("risk_level"))
    known = text_features.filter(F.col("risk_level").isin(K.RISK_LEVELS))
    counts = known.groupBy("risk_level").agg(F.count("*").alias("n"))
    return counts.withColumn("position", position.cast("int")).orderBy("position")


def sentiment_against_z(text_features: DataFrame, gold: DataFrame) -> DataFrame:
    """MD&A texts of companies that have a score, with the company's latest score and latest name."""
    scored = F.col("altman_z_score").isNotNull()
    rows = gold.groupBy(F.col("cik").alias("_key")).agg(
        F.max(F.when(scored, F.struct("period_end", "altman_z_score", "distress_zone"))).alias("score"),
        F.max(F.struct("period_end", "company_name")).alias("name"),
    )
    known = rows.where("score IS NOT NULL").select(
        "_key", F.coalesce("name.company_name", F.lit("Unknown")).alias("company_name"), "score.altman_z_score", "score.distress_zone"
    )
    mda = text_features.filter(F.col("section") == "mda").withColumn("_key", cik_key("cik"))
    return mda.join(known, "_key").select(
        "cik", "accession", "company_name", "sentiment_score", "risk_level", "going_concern",
        "altman_z_score", "distress_zone",
    )


def mda_summaries(text_features: DataFrame, gold: DataFrame) -> DataFrame:
    """MD&A rows by risk level (as text, descending) and going-concern flag.

    Name and document close the order: four levels alone would leave a range sort with four tasks.
    """
    rows = named_texts(text_features.filter(F.col("section") == "mda"), gold).select(
        "company_name", "sentiment_label", "risk_level", "going_concern", "distress_keywords", "llm_summary",
        "accession",
    )
    return rows.orderBy(
        F.desc_nulls_last("risk_level"), F.desc_nulls_last("going_concern"), "company_name", "accession"
    )


def composite_kpis(composite: DataFrame) -> DataFrame:
    return composite.agg(
        F.count_distinct("cik").alias("companies"),
        F.avg("composite_score").alias("mean_composite"),
        _distress_percent("composite_zone").alias("distress_pct"),
        F.count_if(F.col("n_docs_analysed") > 0).alias("rows_with_text"),
    )


def composite_zone_shares(composite: DataFrame) -> DataFrame:
    """Zone counts with a label that carries the share; the window runs over three counts."""
    known = composite.filter(F.col("composite_zone").isNotNull())
    counts = known.groupBy(F.col("composite_zone").alias("zone")).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy()) * 100
    return counts.withColumn("label", F.format_string("%s  %.1f%%", "zone", share))


def composite_scatter(composite: DataFrame) -> DataFrame:
    both = F.col("composite_score").isNotNull() & F.col("altman_z_score").isNotNull()
    return composite.filter(both).select(
        "company_name", "period_end", "altman_z_score", "composite_score", "composite_zone",
        *K.COMPOSITE_WEIGHTS,
    )


def contributions(composite: DataFrame, companies: DataFrame | list[str], digits: int = 4) -> DataFrame:
    """Weighted parts of the score over time for the companies that the caller chose, all of them."""
    parts = [
        F.round(F.col(name) * weight, digits).alias(name.replace("component", "contribution"))
        for name, weight in K.COMPOSITE_WEIGHTS.items()
    ]
    chosen = of_companies(composite, companies).select("company_name", "cik", "period_end", *parts)
    return chosen.orderBy("company_name", "period_end", "cik")


def distressed_companies(composite: DataFrame) -> DataFrame:
    """One row per name of a labelled company, the first in stored order."""
    columns = [
        "cik", "period_end", "company_name", "after_emerging_class", "composite_score",
        *K.COMPOSITE_WEIGHTS, "brd_disposition", "brd_after_emerging",
    ]
    rows = composite.filter(F.col("distress_label") == 1).select(*columns)
    return first_row(rows, ["company_name"], FIRST)


def outcome_counts(composite: DataFrame) -> DataFrame:
    companies = distressed_companies(composite)
    return companies.groupBy(F.col("after_emerging_class").alias("outcome")).agg(F.count("*").alias("companies"))


def outcome_detail(composite: DataFrame) -> DataFrame:
    detail = distressed_companies(composite).drop("cik", "period_end")
    return detail.orderBy(F.desc("composite_score"), F.asc("company_name"))


def raw_explorer(gold: DataFrame) -> DataFrame:
    """The explorer columns that exist, newest first."""
    shown = [name for name in K.EXPLORER_COLUMNS if name in gold.columns]
    return gold.select(*shown).orderBy(F.desc("period_end"), F.asc("cik"), F.asc("form_type"))
