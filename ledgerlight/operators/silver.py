"""Fact rows to one row per company and period.

Two equivalent forms. `silver_by_steps` states each step on its own. `silver` is the form to run: two
aggregations that are combined on the map side, so what is shuffled first is at most one row per task,
company-period and field, however many facts a company or a period has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions.values import period_rank

KEY = ["cik", "period_end"]
LAST = 2**31 - 1

# The latest filing wins. Facts filed on one day are told apart by form, period, the larger value and name,
# so the result does not depend on the order of the input.
LATEST = [
    "filed_date DESC NULLS LAST", "form_type", "fiscal_period", "value DESC", "company_name", "fiscal_year",
]
REPRESENTATIVE = [
    "_rank", "filed_date DESC NULLS LAST", "form_type", "fiscal_period", "company_name", "fiscal_year",
]


def sort_key(term: str) -> Column:
    """``name``, ``name DESC`` or ``name DESC NULLS LAST`` as a sort column; SQL's null order by default."""
    name, _, direction = term.partition(" ")
    return {
        "": F.asc, "DESC": F.desc, "NULLS LAST": F.asc_nulls_last, "DESC NULLS LAST": F.desc_nulls_last,
    }[direction](name)


def first_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key. Spark limits each task to one row per key before the shuffle (WindowGroupLimit)."""
    window = Window.partitionBy(*keys).orderBy(*[sort_key(term) for term in order])
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def latest_filed(facts: DataFrame) -> DataFrame:
    return first_row(facts, [*KEY, "field"], LATEST)


def pivot_facts(survivors: DataFrame, fields: list[str] = K.FACT_FIELDS) -> DataFrame:
    """One column per field; the fields are given, so no extra pass looks for them."""
    return survivors.groupBy(*KEY).pivot("field", fields).agg(F.last("value", ignorenulls=True))


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add absent columns as typed nulls."""
    missing = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def with_period_rank(df: DataFrame) -> DataFrame:
    return df.withColumn("period_rank", period_rank("fiscal_period"))


def representative_meta(survivors: DataFrame) -> DataFrame:
    """The filing that labels a period: annual first, then the latest filed, out of the surviving facts."""
    ranked = survivors.withColumn("_rank", period_rank("fiscal_period"))
    return first_row(ranked, KEY, REPRESENTATIVE).select("cik", *K.META_COLUMNS)


def attach_meta(pivoted: DataFrame, meta: DataFrame) -> DataFrame:
    return pivoted.join(meta, KEY, "left")


def working_capital() -> Column:
    return F.col("assets_current") - F.col("liabilities_current")


def ebit() -> Column:
    """Operating income, else net income plus interest expense as far as given, else null."""
    fallback = F.coalesce("net_income", F.lit(0.0)) + F.coalesce("interest_expense", F.lit(0.0))
    has_part = F.col("net_income").isNotNull() | F.col("interest_expense").isNotNull()
    return F.coalesce("operating_income", F.when(has_part, fallback))


def derive_measures(df: DataFrame) -> DataFrame:
    return df.withColumns({"ebit": ebit(), "working_capital": working_capital()})


def project_canonical(df: DataFrame) -> DataFrame:
    return df.select(*K.SILVER_COLUMNS)


def silver_by_steps(facts: DataFrame) -> DataFrame:
    survivors = latest_filed(facts)
    wide = ensure_columns(pivot_facts(survivors), dict.fromkeys(K.FACT_FIELDS, "double"))
    return project_canonical(derive_measures(attach_meta(wide, representative_meta(survivors))))


def silver(facts: DataFrame) -> DataFrame:
    """The same rows from two aggregations.

    First the latest fact per field: the smallest struct, because its parts are laid out in the order of
    `LATEST` and descending parts are negated. Then one pass over these survivors spreads the values over
    columns and takes the representative filing as the smallest struct in the order of `REPRESENTATIVE`.
    """
    filed = F.coalesce(-F.unix_date("filed_date"), F.lit(LAST))
    fact = F.struct(
        filed.alias("filed"), "form_type", "fiscal_period", (-F.col("value")).alias("negated"),
        "company_name", "fiscal_year",
    )
    latest = facts.groupBy(*KEY, "field").agg(F.min(fact).alias("won"))
    meta = F.struct(
        period_rank("won.fiscal_period").alias("rank"), "won.filed", "won.form_type", "won.fiscal_period",
        "won.company_name", "won.fiscal_year",
    )
    wide = latest.groupBy(*KEY).agg(
        F.min(meta).alias("meta"),
        *[F.max(F.when(F.col("field") == name, -F.col("won.negated"))).alias(name) for name in K.FACT_FIELDS],
    )
    labelled = wide.select(
        "cik", "meta.company_name", "period_end", "meta.fiscal_year", "meta.fiscal_period", "meta.form_type",
        F.when(F.col("meta.filed") != LAST, F.date_from_unix_date(-F.col("meta.filed"))).alias("filed_date"),
        *K.FACT_FIELDS,
    )
    return project_canonical(derive_measures(labelled))


def silver_counts(silver_df: DataFrame) -> DataFrame:
    return silver_df.agg(F.count("*").alias("total_rows"), F.count_distinct("cik").alias("companies"))


def hard_dedup(df: DataFrame) -> DataFrame:
    """One row per (cik, period_end), the one of the earliest fiscal year."""
    others = [c for c in df.columns if c not in (*KEY, "fiscal_year")]
    return first_row(df, KEY, ["fiscal_year NULLS LAST", *others])
