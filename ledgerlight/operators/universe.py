"""The company universe: index constituents and bankruptcy cases under one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions.values import (
    blank_if_null, cik_from_float, map_disposition, pad_cik, to_float, us_date, yes_no,
)
from ledgerlight.operators.silver import ensure_columns, first_row

MEASURES = set(K.CASE_MEASURES)
FLAGS = {"brd_chapter", *K.CASE_FLAGS}


def _blank(name: str) -> Column:
    """Enrichment of a company without a case: empty text, or null for measures and flags."""
    if name in MEASURES:
        return F.lit(None).cast("double")
    return F.lit(None).cast("int") if name in FLAGS else F.lit("")


def normalise_constituents(constituents: DataFrame) -> DataFrame:
    """Index members as healthy companies."""
    return constituents.select(
        F.replace("Symbol", F.lit("."), F.lit("-")).alias("ticker"),
        F.col("Security").alias("company_name"),
        pad_cik("CIK").alias("cik"),
        F.lit(K.CONSTITUENT_SOURCE).alias("source"),
        F.lit(0).alias("distress_label"),
        F.lit("").alias("distress_event_date"),
        F.lit("").alias("distress_event_type"),
        *[_blank(name).alias(name) for name in K.ENRICHMENT_TYPES],
    )


def filter_cases(
    cases: DataFrame, min_year: int = K.CASE_MIN_YEAR, min_assets_m: float = K.CASE_MIN_ASSETS_M
) -> DataFrame:
    """Chapter 11 cases with a company key, recent and large enough."""
    if "YearFiled" in cases.columns:
        year = to_float("YearFiled")
    else:
        year = F.year(us_date("DateFiled").try_cast("date")).cast("double")
    return cases.filter(
        (to_float("Chapter") == K.CASE_CHAPTER)
        & F.col("CikBefore").isNotNull()
        & (year >= min_year)
        & (to_float("AssetsBefore") >= min_assets_m)
    )


def enrich_cases(cases: DataFrame) -> DataFrame:
    """Case rows under the universe schema; a column the file lacks counts as its usual 'no'."""
    chapter = to_float("Chapter").cast("int")

    def flag(name: str) -> Column:
        source, true_values, absent = K.CASE_FLAGS[name]
        return yes_no(source if source in cases.columns else F.lit(absent), true_values)

    values = {name: flag(name) for name in K.CASE_FLAGS}
    whole = ensure_columns(cases, dict.fromkeys(K.CASE_COLUMNS, "string"))
    values |= {name: to_float(source) for name, source in K.CASE_MEASURES.items()}
    values |= {name: blank_if_null(source) for name, source in K.CASE_TEXTS.items()}
    values |= {
        "brd_chapter": chapter,
        "brd_disposition": map_disposition("Disposition"),
        "brd_date_emerging": us_date("DateEmerging"),
    }
    return whole.select(
        F.lit("").alias("ticker"),
        F.col("NameCorp").alias("company_name"),
        cik_from_float("CikBefore").alias("cik"),
        F.lit(K.CASE_SOURCE).alias("source"),
        F.lit(1).alias("distress_label"),
        us_date("DateFiled").alias("distress_event_date"),
        F.concat(F.lit("chapter_"), chapter.cast("string")).alias("distress_event_type"),
        *[values[name].alias(name) for name in K.ENRICHMENT_TYPES],
    )


def union_universe(constituents: DataFrame, cases: DataFrame) -> DataFrame:
    return constituents.unionByName(cases, allowMissingColumns=True)


def prefer_distressed(universe: DataFrame) -> DataFrame:
    """One row per company: a case beats an index entry, the latest case beats earlier ones."""
    first = ["distress_label", "distress_event_date"]
    rest = [c for c in universe.columns if c not in ("cik", "company_name", *first)]
    return first_row(universe, ["cik"], [*[f"{c} DESC" for c in first], "company_name", *rest])


def overlap_count(universe: DataFrame) -> DataFrame:
    """Rows that `prefer_distressed` drops."""
    return universe.agg((F.count("*") - F.count_distinct("cik")).alias("overlaps"))


def order_universe(universe: DataFrame) -> DataFrame:
    return universe.orderBy(F.desc("distress_label"), F.asc("company_name"), F.asc("cik"))


SUMMED_FLAGS = ["brd_emerged", "brd_dip_loan", "brd_sale_363", "brd_ceo_replaced", "brd_prepackaged"]


def enrichment_summary(cases: DataFrame) -> DataFrame:
    """How often each flag is set among the cases."""
    return cases.agg(F.count("*").alias("cases"), *[F.sum(name).alias(name) for name in SUMMED_FLAGS])


def disposition_counts(cases: DataFrame) -> DataFrame:
    return cases.groupBy("brd_disposition").agg(F.count("*").alias("n"))


def label_counts(universe: DataFrame) -> DataFrame:
    return universe.groupBy("distress_label").agg(F.count("*").alias("n"))
