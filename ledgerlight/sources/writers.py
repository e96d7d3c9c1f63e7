"""Writers: layers as Parquet, the universe as CSV, landed objects with their lineage.

Partitioned layers are rebalanced on their partition column first. Adaptive execution then splits a folder
that holds most rows over many tasks and gives a small one a single file, instead of every task writing
into every folder.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.operators.filings import only_new
from ledgerlight.operators.text_features import processed_now
from ledgerlight.operators.universe import order_universe
from ledgerlight.sources.commits import CommitLog, Conflict
from ledgerlight.sources.keyed import merge_keyed

CSV_OPTIONS = {"header": True, "escape": '"', "emptyValue": "", "nullValue": ""}


def _write_partitioned(df: DataFrame, path: str, column: str, overwrite: str) -> None:
    (
        df.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("compression", "snappy")
        .partitionBy(column)
        .parquet(path)
    )


def write_silver(silver: DataFrame, path: str) -> None:
    """One folder per fiscal year; rows without a year are left out, years not in ``silver`` stay as they are."""
    _write_partitioned(silver.filter(F.col("fiscal_year").isNotNull()), path, "fiscal_year", "dynamic")


def write_gold(gold: DataFrame, path: str) -> None:
    """Full replacement, one folder per label."""
    label = F.coalesce(F.col("distress_label").cast("string"), F.lit("unknown"))
    _write_partitioned(gold.withColumn("distress_label", label), path, "distress_label", "static")


def write_bucketed(df: DataFrame, table: str, keys: list[str], order: list[str], buckets: int = 64) -> None:
    """A table of the catalog whose rows lie in buckets by ``keys``, one file each, sorted by ``keys`` and ``order``.

    Windows, aggregates and joins on the keys (or more columns) then need no exchange, and none of what follows in the same order needs a sort.
    Tables that are joined need the same keys and number of buckets.
    """
    spread = df.repartition(buckets, *keys)
    spread.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, *order).option("compression", "snappy").saveAsTable(table)


def write_text_features(features: DataFrame, path: str) -> None:
    """One folder per section; sections not in ``features`` stay as they are."""
    _write_partitioned(features, path, "section", "dynamic")


def append_text_features(features: DataFrame, path: str) -> None:
    """The features of one run, in a folder of their own beside those of earlier runs; nothing stored is touched.

    `streaming.incremental.current_features` reads the newest row of each document.
    """
    _write_partitioned(features, f"{path}/batch={time.time_ns()}", "section", "static")


def write_composite(composite: DataFrame, path: str) -> None:
    composite.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_universe(universe: DataFrame, path: str) -> None:
    """CSV files with a header; their order is the universe's order."""
    order_universe(universe).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def lineage_columns(
    df: DataFrame, content: str = "content", extra: list[str] | None = None, now: Column | None = None
) -> DataFrame:
    """Hash, size, time and a sidecar document for objects with object_name, source_url and http_status."""
    named = df.withColumns({
        "sha256": F.sha2(F.col(content).cast("binary"), 256),
        "size_bytes": F.octet_length(content),
        "fetched_at_utc": processed_now() if now is None else now,
    })
    parts = [
        "object_name", "source_url", "http_status", "fetched_at_utc", "size_bytes", "sha256", *(extra or []),
    ]
    return named.withColumn("meta_json", F.to_json(F.struct(*parts)))


def land_with_lineage(
    objects: DataFrame, path: str, landed: DataFrame | None = None, extra: list[str] | None = None
) -> DataFrame:
    """Store objects that are not landed yet; nothing landed is ever rewritten. Returns the rows as they are stored.

    ``landed`` holds the object names stored before; without it ``path`` must be new. Of several objects of one
    name the one with the smallest hash is stored. New names are chosen before any content is moved.
    """
    if landed is not None:
        names = only_new(objects, landed)
        objects = objects.join(names, "object_name", "left_semi")
    now = objects.sparkSession.range(1).select(processed_now().alias("now")).first().now
    named = lineage_columns(objects, extra=extra, now=F.lit(now))
    one = Window.partitionBy("object_name").orderBy("sha256", "source_url", "http_status")
    new = named.withColumn("_rn", F.row_number().over(one)).where("_rn = 1").drop("_rn")
    new.write.mode("errorifexists" if landed is None else "append").parquet(path)
    return objects.sparkSession.read.parquet(path).where(F.col("fetched_at_utc") == now)


def land_once(
    objects: DataFrame, path: str, landed: DataFrame | None = None, extra: list[str] | None = None
) -> DataFrame:
    """Store objects whose names are not landed yet; nothing landed is ever rewritten. Returns the rows as they are stored.

    Unlike `land_with_lineage` this holds for runs at the same time, too: a run stores its objects in a folder of its own and commits it; if
    another run committed in between, the names that it landed are taken out and the rest is committed. A run that dies has landed
    nothing, and its names stay open (`clear_abandoned_landings`). ``landed`` holds further names that count as landed.
    Of several objects of one name the one with the smallest hash is stored. New names are chosen before any content is moved.
    """
    spark, log = objects.sparkSession, CommitLog(objects.sparkSession, path)
    if landed is not None:
        objects = objects.join(only_new(objects, landed), "object_name", "left_semi")
    at, entry = log.latest()
    runs = entry.get("runs", [])
    if runs:
        objects = objects.join(only_new(objects, _landed_runs(spark, path, runs)), "object_name", "left_semi")
    now = spark.range(1).select(processed_now().alias("now")).first().now
    named = lineage_columns(objects, extra=extra, now=F.lit(now))
    one = Window.partitionBy("object_name").orderBy("sha256", "source_url", "http_status")
    new = named.withColumn("_rn", F.row_number().over(one)).where("_rn = 1").drop("_rn")
    while True:
        run = f"run-{uuid.uuid4().hex}"
        new.write.parquet(f"{path}/{run}")
        while True:
            try:
                log.commit(at + 1, {"runs": [*runs, run]})
                return spark.read.parquet(f"{path}/{run}")
            except Conflict:
                at, entry = log.latest()
                others = [name for name in entry["runs"] if name not in runs]
                runs = entry["runs"]
                mine = spark.read.parquet(f"{path}/{run}")
                theirs = _landed_runs(spark, path, others)
                if mine.join(theirs, "object_name", "left_semi").limit(1).count():
                    new = mine.join(theirs, "object_name", "left_anti")
                    break


def _landed_runs(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    """The names that these runs landed."""
    return spark.read.parquet(*(f"{path}/{run}" for run in runs)).select("object_name")


def clear_abandoned_landings(spark: SparkSession, path: str, older_than_s: float = 86_400) -> list[str]:
    """Remove what runs left behind that ended before they committed. Returns the folders' names."""
    log = CommitLog(spark, path)
    return log.clear_abandoned(set(log.latest()[1].get("runs", [])), older_than_s)


def merge_text_features(features: DataFrame, path: str, version: str | None = None, number: int | None = None, **kept: int) -> int:
    """Merge new feature rows into a table with one row for each document; only the buckets they fall into are rewritten (`keyed`)."""
    return merge_keyed(features, path, K.TEXT_KEY, version, number=number, **kept)


def write_summary(results: DataFrame, path: str) -> None:
    """Outcomes item by item."""
    results.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def dry_run(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The first rows by key, to look at; nothing is written."""
    return df.orderBy(*keys).limit(n)
