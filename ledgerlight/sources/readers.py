"""Readers: raw documents, section texts, CSV files and stored layers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions.text import decode_text
from ledgerlight.functions.values import pad_cik, strip
from ledgerlight.operators.filings import read_submission_rows
from ledgerlight.operators.text_features import parse_object_name
from ledgerlight.sources import typed
from ledgerlight.sources.commits import CommitLog


def read_documents(
    spark: SparkSession, path: str, prefix: str = "", packed: bool = False, pattern: str = "*.json"
) -> DataFrame:
    """JSON documents as (object_name, raw), without lineage sidecars.

    One document per file, or with ``packed`` one per line of larger files: at many millions of documents
    the packed layout spares the file listing and gives tasks of even size.
    """
    source = f"{path.rstrip('/')}/{prefix}"
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    lines = reader.text(source, wholetext=not packed)
    named = lines.select(F.col("_metadata.file_path").alias("object_name"), F.col("value").alias("raw"))
    return named.filter(~F.col("object_name").endswith(".meta.json"))


def read_company_facts(
    spark: SparkSession, path: str, prefix: str = "", packed: bool = False, pattern: str = "*.json"
) -> DataFrame:
    """Documents for `flatten_facts`, which skips those that are broken or hold no facts."""
    return read_documents(spark, path, prefix, packed, pattern)


def read_submissions(
    spark: SparkSession, path: str, prefix: str = "", packed: bool = False, pattern: str = "*.json"
) -> DataFrame:
    """One row per filing of every submissions document."""
    return read_submission_rows(read_documents(spark, path, prefix, packed, pattern))


def read_filing_text(
    spark: SparkSession, path: str | list[str], packed: bool = False, pattern: str = "*.txt"
) -> DataFrame:
    """Section texts with the parts of their object names; broken UTF-8 is replaced, never fatal.

    One section per file, or with ``packed`` Parquet files of (object_name, content bytes): at many millions of
    sections the packed layout spares the file listing and gives tasks of even size.
    """
    if packed:
        stored = spark.read.parquet(path)
    else:
        options = {"recursiveFileLookup": True, "pathGlobFilter": pattern}
        stored = spark.read.format("binaryFile").options(**options).load(path).withColumnRenamed("path", "object_name")
    return parse_object_name(stored.select("object_name", decode_text("content").alias("text")))


def list_filing_text(spark: SparkSession, path: str, packed: bool = False, pattern: str = "*.txt") -> DataFrame:
    """Object names and their parts; no content is read."""
    return read_filing_text(spark, path, packed, pattern).drop("text")


#: Bytes and files of a task that reads chosen objects.
CHOSEN_BYTES, CHOSEN_FILES = 128 << 20, 2_000


def open_arrow(name: str):
    """Open an object for reading by its address; credentials come from the environment of the worker."""
    from pyarrow import fs

    scheme, found, rest = name.partition(":")
    if not found or scheme == "file" or "/" in scheme:
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/") if scheme == "file" else name)
    if scheme not in ("s3", "s3a", "gs", "hdfs"):
        raise ValueError(f"{name}: pass an opener for {scheme}, or read all objects and use open_documents")
    store, path = fs.FileSystem.from_uri(name.replace("s3a://", "s3://", 1))
    return store.open_input_stream(path)


def read_chosen(spark: SparkSession, chosen: DataFrame, opener: Callable = open_arrow, max_files: int | None = None) -> DataFrame:
    """The texts of chosen objects, all of them and no other; more than ``max_files``, where a caller names it, are refused.

    Names stay in partitions: no file is listed and no name comes to the driver. Tasks open the objects with ``opener`` (address to a
    readable stream; the shipped one knows local files, S3, GCS and HDFS). With a column ``length`` (bytes, as a listing gives
    it) tasks get about CHOSEN_BYTES each, else CHOSEN_FILES objects. An object that is gone fails its task with its name.
    """
    sized = "length" in chosen.columns
    size = chosen.agg(F.count("*").alias("files"), (F.sum("length") if sized else F.lit(0)).alias("bytes")).first()
    if max_files is not None and size.files > max_files:
        raise ValueError(f"more than {max_files} objects are chosen: {size.files}")
    tasks = max(1, -(-size.files // CHOSEN_FILES), -(-(size.bytes or 0) // CHOSEN_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("object_name").to_pylist():
                with opener(name) as stream:
                    content = stream.read()
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], ["object_name", "content"])

    read = chosen.select("object_name").repartition(tasks).mapInArrow(run, "object_name string, content binary")
    return parse_object_name(read.select("object_name", decode_text("content").alias("text")))


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The objects of all landings that were committed (`writers.land_once`)."""
    runs = CommitLog(spark, path).latest()[1].get("runs", [])
    if not runs:
        raise ValueError(f"nothing is landed at {path}")
    return spark.read.option("mergeSchema", True).parquet(*(f"{path}/{run}" for run in runs))


def _read_csv(
    spark: SparkSession, path: str, encoding: str = "UTF-8", drop_wide: bool = False
) -> DataFrame:
    """All cells as text; quoted cells may hold line breaks. Short lines are filled with nulls; surplus cells are cut,
    or their lines dropped. Files of one folder must have the same header."""
    options = {"header": True, "encoding": encoding, "escape": '"', "multiLine": True}
    names = spark.read.options(**options).csv(path).columns
    # the reader of lines splits large files; the first line of each file is the one at its begin, wherever a task starts
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.where("at = 0").withColumn("nth", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "nth").alias("head"))
    heads = first.select(F.rtrim("head", F.lit("\r")).alias("head")).where("head <> ''").distinct().limit(2).collect()
    if len(heads) > 1:
        raise ValueError(f"files below {path} have different headers")
    schema = ", ".join(f"`{name}` STRING" for name in [*names, "_surplus"])
    rows = spark.read.options(**options, enforceSchema=True).schema(schema).csv(path)
    return (rows.filter(F.col("_surplus").isNull()) if drop_wide else rows).drop("_surplus")


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """The universe as text, with padded company keys; `universe_labels` types the rest."""
    return _read_csv(spark, path).withColumn("cik", pad_cik("cik"))


def read_bankruptcy_cases(spark: SparkSession, path: str, drop_malformed: bool = False) -> DataFrame:
    """The Latin-1 case file as text; blank cells are null. Optionally lines with too many cells are dropped."""
    cases = _read_csv(spark, path, "ISO-8859-1", drop_malformed)
    return cases.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in cases.columns})


def read_constituents(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path).withColumn("Security", strip("Security"))


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet layer: partition columns from the folder names, files of differing columns merged by name. Where files disagree on
    a column's type, it gets the smallest type that holds all of them (`typed`)."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except typed.MERGE_ERRORS as problem:
        if not typed.cannot_merge(problem):
            raise
    return typed.read_typed(spark, path)


def read_layer(spark: SparkSession, uri: str) -> DataFrame:
    """The same for an object-store address; credentials and endpoint are Hadoop settings of the session."""
    return read_partitioned(spark, uri.replace("s3://", "s3a://", 1))


def first_available(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """The first stored layer that can be read, else an empty one of the given schema."""
    for path in paths:
        try:
            return read_layer(spark, path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)
