"""Exact quantiles of groups of any size.

`median` and `percentile` keep every distinct value of a group in one buffer of one task. Report groups
("all scored rows of healthy companies") grow with the data, so here the work per task is bounded instead:

0. the input is computed once and kept in the shared checkpoint folder; everything below reads that;
1. one pass over the values takes the count, the extremes and, per wanted quantile, two sketch quantiles
   that enclose it (`percentile_approx` guarantees its rank error, so the enclosure is certain);
2. a second pass counts the values below each enclosure and groups the values inside it by value, both
   combined on the map side;
3. only the enclosed values are ranked: at most ``accuracy`` values of a small group, else about
   25 / accuracy of a group's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.session import checkpointed

ACCURACY = 10_000
QUARTILES = {"q1": 0.25, "median_value": 0.5, "q3": 0.75}


def exact_quantiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    quantiles: dict[str, float],
    others: dict[str, Column] | None = None,
    accuracy: int = ACCURACY,
    stored: bool = False,
) -> DataFrame:
    """One row per group with one column per named quantile, linearly interpolated; nulls are skipped.

    ``others`` are further aggregates, taken in the first pass. Callers pass the columns that are needed and no
    others, as they are written once; ``stored`` says that ``df`` is stored already.
    """
    others = others or {}
    df = df if stored else checkpointed(df)
    margin = 10.0 / accuracy  # ten times the rank error of the sketch
    fractions = [q for p in quantiles.values() for q in (max(p - margin, 0.0), min(p + margin, 1.0))]
    number = F.col(value).cast("double")
    sketch = df.groupBy(*groups).agg(
        F.count(value).alias("_n"),
        F.percentile_approx(number, fractions, accuracy).alias("_q"),
        *[column.alias(name) for name, column in others.items()],
    )
    # A small group is enclosed whole: there the margin could be less than one rank.
    wide = F.col("_n") > accuracy
    enclosures = F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.lit(p).alias("p"),
            F.when(wide, F.col("_q")[2 * i]).otherwise(F.lit(float("-inf"))).alias("low"),
            F.when(wide, F.col("_q")[2 * i + 1]).otherwise(F.lit(float("inf"))).alias("high"),
        )
        for i, (name, p) in enumerate(quantiles.items())
    ])
    enclosed = sketch.select(*groups, F.struct("_n", enclosures.alias("e")).alias("_s"), *others)

    values = df.select(*groups, number.alias("_v"))
    if groups:
        located = _attach(values, enclosed.select(*groups, "_s"), groups, "inner")
    else:
        located = values.withColumn("_s", enclosed.select("_s").scalar())
    near = F.filter("_s.e", lambda e: F.col("_v") <= e["high"])
    pieces = located.select(*groups, "_v", F.col("_s._n").alias("_n"), F.explode(near).alias("e"))
    counted = pieces.groupBy(
        *groups, "_n", F.col("e.name").alias("name"), F.col("e.p").alias("p"),
        F.when(F.col("_v") >= F.col("e.low"), F.col("_v")).alias("x"),  # null stands for all values below
    ).agg(F.count("*").alias("c"))

    upto = Window.partitionBy(*groups, "name").orderBy(F.asc_nulls_first("x"))
    ranked = counted.withColumn("upto", F.sum("c").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    position = F.col("p") * (F.col("_n") - 1)
    at = [F.floor(position) + 1, F.ceil(position) + 1]
    low, high = [F.min(F.when(F.col("upto") >= rank, F.col("x"))) for rank in at]
    # "x" is null only for the values below the enclosure; they must not reach a wanted rank.
    missed = F.max(F.col("x").isNull() & (F.col("upto") >= at[0]))
    picked = ranked.groupBy(*groups, "name").agg(
        low.alias("low"), high.alias("high"), F.max(position - F.floor(position)).alias("part"),
        missed.alias("missed"),
    )
    value_at = F.when(
        F.col("missed") | F.col("high").isNull(), F.raise_error(F.lit("quantile outside its enclosure"))
    ).otherwise(F.col("low") + (F.col("high") - F.col("low")) * F.col("part"))
    found = picked.groupBy(*groups).agg(
        *[F.max(F.when(F.col("name") == name, value_at)).alias(name) for name in quantiles]
    )
    if groups:
        return _attach(enclosed.select(*groups, *others), found, groups, "left")
    if not others:
        return found
    whole = found.select(F.struct("*")).scalar()
    return enclosed.select(*others).withColumn("_f", whole).select(*others, "_f.*")


def _attach(left: DataFrame, report: DataFrame, groups: list[str], how: str) -> DataFrame:
    """Join a report of one row per group; null is a group like any other."""
    right = report.withColumnsRenamed({g: f"_g_{g}" for g in groups})
    on = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]
    return left.join(right, on, how).drop(*right.columns[: len(groups)])


def exact_median(df: DataFrame, groups: list[str], value: str, alias: str, **others: Column) -> DataFrame:
    """Median per group next to other aggregates; the median is null in a group without values."""
    return exact_quantiles(df, groups, value, {alias: 0.5}, others)


def five_numbers(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Count, minimum, quartiles and maximum per group that has values."""
    df = df.select(*groups, value)
    ends = {"n": F.count(value), "min_value": F.min(value), "max_value": F.max(value)}
    return exact_quantiles(df, groups, value, QUARTILES, ends).filter(F.col("n") > 0)


def describe(df: DataFrame, value: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of one column over the whole table, nulls skipped."""
    df = df.select(value)
    moments = {
        "n": F.count(value), "mean_value": F.avg(value), "std_value": F.stddev_samp(value),
        "min_value": F.min(value), "max_value": F.max(value),
    }
    return exact_quantiles(df, [], value, QUARTILES, moments)
