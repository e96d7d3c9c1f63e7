"""Documents made from one row group are dealt out to all tasks, and stay the same."""

from pyspark.sql import functions as F

from ledgerlight.checks.inputs import BLOBS, Inputs

ROWS = 4000


def test_documents_of_one_row_group_come_in_several_tasks(spark, tmp_path):
    key = F.when(F.col("id") % 50 != 0, F.col("id") % 900)  # repeated and null keys
    rows = spark.range(ROWS).select(
        key.alias("l_orderkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"), (F.col("id") % 40).alias("l_suppkey"),
        (F.col("id") % 301).alias("l_partkey"), F.lit("2001-09-23 00:00:00").cast("timestamp_ntz").alias("l_shipdate"),
        (F.col("id") * 1.25).alias("l_extendedprice"), (F.col("id") % 50 * 1.0).alias("l_quantity"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    plain = spark.sql(BLOBS, lineitem=spark.read.parquet(f"{tmp_path}/lineitem.parquet"))
    dealt = Inputs(spark, str(tmp_path)).blobs
    largest = dealt.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]
    assert largest < ROWS / 2
    assert dealt.count() == ROWS
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
