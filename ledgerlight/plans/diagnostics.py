"""Analytical and data-quality queries over the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions.values import group_name
from ledgerlight.operators.quantiles import exact_median, exact_quantiles
from ledgerlight.session import checkpointed


def _percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.lit(100.0) * part / whole, digits)


def _in_zone(zone: str) -> Column:
    return F.count_if(F.col("distress_zone") == zone)


def zone_distribution(gold: DataFrame) -> DataFrame:
    """Rows per label and zone with their share of the label's rows; the window runs over the few counts."""
    counts = (
        gold.filter(F.col("distress_zone").isNotNull())
        .groupBy("distress_label", "distress_zone")
        .agg(F.count("*").alias("n_periods"))
    )
    total = F.sum("n_periods").over(Window.partitionBy("distress_label"))
    return counts.withColumn("pct", _percent(F.col("n_periods"), total))


def score_by_label(gold: DataFrame) -> DataFrame:
    report = exact_median(
        gold.select("distress_label", "altman_z_score"), ["distress_label"], "altman_z_score", "median_z",
        mean_z=F.avg("altman_z_score"), n_scores=F.count("altman_z_score"),
    )
    return report.withColumns({"mean_z": F.round("mean_z", 2), "median_z": F.round("median_z", 2)})


def _labelled_companies(gold: DataFrame) -> DataFrame:
    """Per labelled company whether it has a score and whether it was ever in the distress zone."""
    reached = F.coalesce(F.col("distress_zone") == "distress", F.lit(False))
    return gold.filter(F.col("distress_label") == 1).groupBy("cik").agg(
        F.max(F.col("altman_z_score").isNotNull()).alias("scored"), F.max(reached).alias("reached"),
    )


def recall(gold: DataFrame) -> DataFrame:
    """Labelled companies that were in the distress zone at least once."""
    counts = _labelled_companies(gold).agg(F.count_if("reached").alias("flagged"), F.count("*").alias("total"))
    share = _percent(F.col("flagged"), F.nullif(F.col("total"), F.lit(0)))
    return counts.withColumn("pct", share)


def group_table(gold: DataFrame) -> DataFrame:
    """Counts and mean per label out of per-company counts, joined by label with the median."""
    rows = checkpointed(gold.select("distress_label", "cik", "altman_z_score"))
    per_company = rows.groupBy("distress_label", "cik").agg(
        F.count("*").alias("periods"),
        F.count("altman_z_score").alias("scored"),
        F.sum("altman_z_score").alias("total_z"),
    )
    counts = per_company.groupBy("distress_label").agg(
        F.count("*").alias("companies"),
        F.sum("periods").alias("periods_total"),
        F.sum("scored").alias("periods_scored"),
        F.sum("total_z").alias("total_z"),
    )
    medians = exact_quantiles(rows, ["distress_label"], "altman_z_score", {"median_z": 0.5}, stored=True)
    mean = F.col("total_z") / F.nullif(F.col("periods_scored"), F.lit(0))
    return counts.join(medians, "distress_label").select(
        group_name("distress_label").alias("company_group"),
        "companies", "periods_total", "periods_scored",
        F.round(mean, 2).alias("mean_z"), F.round("median_z", 2).alias("median_z"),
    )


def zone_shares(gold: DataFrame) -> DataFrame:
    scored = gold.filter(F.col("altman_z_score").isNotNull())
    shares = scored.groupBy("distress_label").agg(
        *[_percent(_in_zone(z), F.count("*")).alias(f"pct_{z}") for z in ("distress", "grey", "safe")]
    )
    return shares.withColumn("company_group", group_name("distress_label")).drop("distress_label")


def recall_scored(gold: DataFrame) -> DataFrame:
    """Recall among the labelled companies that have a score at all."""
    counts = _labelled_companies(gold).agg(
        F.count("*").alias("companies_with_data"),
        F.count_if("scored").alias("companies_with_zscore"),
        F.count_if("reached").alias("reached_distress"),
    )
    share = _percent(F.col("reached_distress"), F.nullif(F.col("companies_with_zscore"), F.lit(0)))
    return counts.withColumn("recall_pct", share)


def coverage(gold: DataFrame) -> DataFrame:
    counts = gold.agg(
        F.count("*").alias("gold_rows_total"), F.count("altman_z_score").alias("gold_rows_scored")
    )
    share = _percent(F.col("gold_rows_scored"), F.nullif(F.col("gold_rows_total"), F.lit(0)))
    return counts.withColumn("pct_scored", share)


def duplicate_keys(df: DataFrame, keys: tuple[str, ...] = ("cik", "period_end")) -> DataFrame:
    """Keys that occur more than once; empty for a sound silver layer."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def null_rates(silver: DataFrame) -> DataFrame:
    checked = {"missing_ebit": "ebit", "missing_wc": "working_capital", "missing_assets": "assets_total"}
    return silver.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(name).isNull()).alias(alias) for alias, name in checked.items()],
    )


def year_coverage(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("fiscal_year")
        .agg(F.count("*").alias("n_rows"), F.count_distinct("cik").alias("companies"))
        .orderBy("fiscal_year")
    )


def sample_rows(silver: DataFrame, n: int = 5) -> DataFrame:
    """The first rows in key order with the columns worth a look; `DataFrame.columns` lists all others."""
    shown = ["cik", "company_name", "period_end", "assets_total", "ebit", "working_capital"]
    return silver.select(*shown).orderBy("cik", "period_end").limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    known = df.filter(F.col(column).isNotNull())
    return known.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def column_profile(df: DataFrame, text_only: bool = False) -> DataFrame:
    """Type and number of non-null values per column, from one pass over the table."""
    columns = [(name, kind) for name, kind in df.dtypes if kind == "string" or not text_only]
    counts = df.agg(*[F.count(F.col(name)).alias(name) for name, _ in columns])
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"), F.lit(kind).alias("column_type"), F.col(name).alias("non_null")
        )
        for name, kind in columns
    ])
    return counts.select(F.inline(rows))


def freshness_report(
    spark: SparkSession, layers: dict[str, str], max_age_days: int = K.FRESH_DAYS
) -> DataFrame:
    """File count, newest change, age in days and freshness per layer; a missing layer is not fresh.

    Only file metadata is read, no column.
    """
    reports = [_layer_freshness(spark, name, path, max_age_days) for name, path in layers.items()]
    return reduce(DataFrame.unionByName, reports)


def _layer_freshness(spark: SparkSession, name: str, path: str, max_age_days: int) -> DataFrame:
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").load(path).select("modificationTime")
        )
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "modificationTime TIMESTAMP")
    seen = files.agg(F.count("*").alias("n_files"), F.max("modificationTime").alias("newest"))
    age = (F.unix_micros(F.current_timestamp()) - F.unix_micros("newest")) / F.lit(86_400_000_000.0)
    return seen.select(
        F.lit(name).alias("layer"), "n_files", "newest", age.alias("age_days"),
        F.coalesce(age < max_age_days, F.lit(False)).alias("is_fresh"),
    )

