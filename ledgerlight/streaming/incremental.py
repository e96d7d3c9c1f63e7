"""Resumable text features as a stream: only section texts that arrived since the last run are processed.

This is the batch resume (`resume_filter` and `upsert_latest`) with the list of finished files kept by
Structured Streaming. Each micro-batch is merged into a table with one row for each document (`sources.keyed`), which is the state: the
row with the greatest version stays, so a version that arrives late changes nothing, and only the buckets of a batch are
rewritten. A batch that is repeated after a failure is known by its number and not applied again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions.text import decode_text
from ledgerlight.operators.text_features import Scorer, latest_batch, parse_object_name
from ledgerlight.plans.layers import build_text_features
from ledgerlight.sources.commits import CommitLog
from ledgerlight.sources.keyed import BUCKETS, read_keyed
from ledgerlight.sources.readers import read_partitioned
from ledgerlight.sources.writers import merge_text_features

FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
PACKED_SCHEMA = "object_name STRING, content BINARY"
VERSION = "_version"


def incremental_features(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    make_scorer: Callable[[], Scorer] | None = None,
    max_files: int = 10_000,
    packed: bool = False,
    buckets: int = BUCKETS,
) -> None:
    """Process all new ``.txt`` objects below ``source``, or with ``packed`` all new Parquet files of (object_name,
    content), and return when none is left.

    An object's version is the ingestion date in its name (``ingestion_date=...``, else none); of equal versions the later batch wins.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    if packed:
        files = reader.schema(PACKED_SCHEMA).parquet(source)
    else:
        files = (
            reader.format("binaryFile").schema(FILE_SCHEMA)
            .option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).load(source)
        ).withColumnRenamed("path", "object_name")
    documents = files.select("object_name", decode_text("content").alias("text"))

    def store(batch: DataFrame, number: int) -> None:
        dated = newest_versions(batch)
        features = build_text_features(dated.select("object_name", "text"), make_scorer=make_scorer)
        versions = parse_object_name(dated).select(*K.TEXT_KEY, VERSION)
        merge_text_features(features.join(versions, K.TEXT_KEY), sink, VERSION, number, buckets=buckets)

    query = (
        documents.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def newest_versions(documents: DataFrame) -> DataFrame:
    """Of several objects of one document the one with the greatest version, then the last name."""
    version = F.nullif(F.regexp_extract("object_name", r"ingestion_date=([0-9-]+)", 1), F.lit(""))
    dated = parse_object_name(documents.withColumn(VERSION, version))
    last = Window.partitionBy(*K.TEXT_KEY).orderBy(F.desc_nulls_last(VERSION), F.desc("object_name"), F.desc("text"))
    return dated.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").select("object_name", "text", VERSION)


def current_features(spark: SparkSession, sink: str) -> DataFrame:
    """The newest feature row of each document: as merged, or over the runs that `append_text_features` stored side by side."""
    if CommitLog(spark, sink).latest()[0]:
        return read_keyed(spark, sink).drop(VERSION)
    return latest_batch(read_partitioned(spark, sink), "batch").drop("batch")
