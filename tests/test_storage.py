"""Layers with drifting types, landings and merges that run at the same time or die, chosen objects without the driver."""

import math
import os
import threading

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.sources import keyed as KY
from ledgerlight.sources import readers as RD
from ledgerlight.sources import typed as TY
from ledgerlight.sources import writers as WR
from ledgerlight.sources.commits import CommitLog, Conflict
from ledgerlight.streaming.incremental import current_features, incremental_features

VARIANTS = [
    "CAST(id AS INT) AS v; 'a' AS s", "CAST(id AS BIGINT) AS v; 1.5D AS extra", "id + 0.5D AS v", "id * 1e9D + 0.25D AS v", "id * 1e20D AS v",
    "CAST(id AS DECIMAL(10,2)) AS v", "CAST(id AS SMALLINT) AS v; DATE '2024-01-02' AS day", "CAST(id / 7 AS FLOAT) AS w; TIMESTAMP_NTZ '2024-01-02 03:04:05' AS day",
]


def write_variants(spark, path, variants, rows=3):
    for i, columns in enumerate(variants):
        spark.range(rows).selectExpr(*columns.split("; ")).coalesce(1).write.parquet(f"{path}/y=20{i:02d}")


def both(spark, path):
    ours = RD.read_partitioned(spark, path)
    theirs = duckdb.connect().sql(f"SELECT {', '.join(ours.columns)} FROM read_parquet('{path}/*/*.parquet', union_by_name=true, hive_partitioning=true)")
    return sorted(str(tuple(r)) for r in ours.collect()), sorted(str(r) for r in theirs.fetchall())


@pytest.mark.parametrize("pick", [[0, 1], [0, 1, 2, 3], [0, 2, 4], [5, 0], [5, 2], [6, 7], [0, 1, 2, 3, 4, 6, 7]])
def test_drifting_types_read_as_another_engine_does(spark, tmp_path, pick):
    write_variants(spark, str(tmp_path), [VARIANTS[i] for i in pick])
    ours, theirs = both(spark, str(tmp_path))
    assert ours == theirs


@pytest.mark.parametrize("pick", [range(len(VARIANTS))])
def test_numbers_beside_text(spark, tmp_path, pick):
    write_variants(spark, str(tmp_path), [VARIANTS[i] for i in (0, 2, 3, 4)] + ["concat('x', id) AS v"])
    ours, theirs = both(spark, str(tmp_path))
    assert ours == theirs and RD.read_partitioned(spark, str(tmp_path)).schema["v"].dataType == T.StringType()


def test_files_of_one_folder_disagree_and_names_differ_in_case(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(6):
        kind = ["INT", "DOUBLE", "STRING"][i % 3]
        spark.range(4).selectExpr(f"CAST(id AS {kind}) AS {'v' if i % 2 else 'V'}", "id AS k").coalesce(1).write.mode("append").parquet(f"{path}/label={'0' if i < 3 else 'unknown'}")
    df = RD.read_partitioned(spark, path)
    assert df.schema["v" if "v" in df.columns else "V"].dataType == T.StringType()
    assert df.count() == 24 and {r.label for r in df.select("label").distinct().collect()} == {"0", "unknown"}
    assert sorted({r[0] for r in df.select("v").collect()}) == ["0", "0.0", "1", "1.0", "2", "2.0", "3", "3.0"]
    scans = df.select("k").where("label = '0'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(label" in scans and "`v`" not in scans


def test_number_texts(spark):
    numbers = [0.0, -0.0, 1.0, 1e7, 12345678.5, 1e15, 1e16, 1.5e16, 1e-3, 1.5e-4, 1e-4, 1e-5, 1.25e-7, 1e100, -1.5e22, 123456789012345.6, math.inf, -math.inf, math.nan, 1e-300, 1.7976931348623157e308]
    ours = [r[0] for r in spark.createDataFrame([(x,) for x in numbers], "x double").select(TY.number_text(F.col("x"))).collect()]
    con = duckdb.connect()
    assert ours == [con.execute("SELECT CAST(CAST(? AS DOUBLE) AS VARCHAR)", [x]).fetchone()[0] for x in numbers]


def test_common_types():
    D = T.DecimalType
    assert TY.common_type(D(10, 2), T.IntegerType()) == D(12, 2) and TY.common_type(D(38, 2), D(38, 30)) == T.DoubleType()
    assert TY.common_type(T.LongType(), T.FloatType()) == T.DoubleType() and TY.common_type(T.BooleanType(), T.ShortType()) == T.ShortType()
    assert TY.common_type(T.BooleanType(), T.DoubleType()) == T.StringType() and TY.common_type(T.DateType(), T.StringType()) == T.StringType()
    a, b = (T.StructType([T.StructField("x", kind), T.StructField(name, T.StringType())]) for kind, name in ((T.IntegerType(), "p"), (T.DoubleType(), "q")))
    assert TY.common_type(T.ArrayType(a), T.ArrayType(b)).elementType.simpleString() == "struct<x:double,p:string,q:string>"
    with pytest.raises(ValueError, match="no common type"):
        TY.common_type(a, T.StringType())
    for kind in (a, D(10, 2), T.LongType(), T.StringType()):
        assert TY.common_type(kind, kind) == kind and TY.common_type(T.NullType(), kind) == kind


def test_nested_columns_and_union(spark):
    one = spark.sql("SELECT named_struct('x', 1, 'p', 'a') AS s, array(1, 2) AS a")
    two = spark.sql("SELECT named_struct('q', 'b', 'x', 1.5D) AS s, array(2.5D) AS a, 7 AS more UNION ALL SELECT null, null, null")
    rows = TY.union_by_name([one, two]).collect()
    assert [r.s and (r.s.x, r.s.p, r.s.q) for r in rows] == [(1.0, "a", None), (1.5, None, "b"), None]
    assert [r.a for r in rows] == [[1.0, 2.0], [2.5], None] and [r.more for r in rows] == [None, 7, None]


def test_schema_groups_split_where_files_disagree():
    kinds = {f"f{i}": T.StructType([T.StructField("v", T.IntegerType() if i % 5 else T.DoubleType()), T.StructField(f"c{i % 2}", T.StringType())]) for i in range(40)}
    calls = []

    def schema_of(files):
        calls.append(len(files))
        types = {kinds[f]["v"].dataType for f in files}
        return TY.common_schema([kinds[f] for f in files]) if len(types) == 1 else None

    groups = TY.schema_groups(schema_of, [list(kinds)[:20], list(kinds)[20:], []])
    assert len(groups) == 2 and sorted(f for _, files in groups for f in files) == sorted(kinds)
    assert all({kinds[f]["v"].dataType for f in files} == {schema["v"].dataType} for schema, files in groups)


SCHEMA = "object_name STRING, content STRING, source_url STRING, http_status INT"


def objects(spark, names, text):
    return spark.createDataFrame([(name, text, "u", 200) for name in names], SCHEMA)


def test_landings_at_the_same_time_give_each_name_once(spark, tmp_path):
    path, stored, errors = str(tmp_path / "landed"), [], []

    def land(i):
        try:
            stored.extend((r.object_name, r.content) for r in WR.land_once(objects(spark, [f"n{j}" for j in range(i, i + 6)], f"run {i}"), path).collect())
        except Exception as problem:  # noqa: BLE001 - shown by the assertion
            errors.append(problem)

    threads = [threading.Thread(target=land, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    rows = [(r.object_name, r.content) for r in RD.read_landed(spark, path).collect()]
    assert sorted(rows) == sorted(stored) and sorted(name for name, _ in rows) == [f"n{j}" for j in range(9)]
    number, entry = CommitLog(spark, path).latest()
    assert number == len(entry["runs"]) == 4


def test_a_landing_that_died_leaves_its_names_open(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "landed")
    WR.land_once(objects(spark, ["a"], "first"), path)
    monkeypatch.setattr(CommitLog, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        WR.land_once(objects(spark, ["b"], "died"), path)
    monkeypatch.undo()
    assert [r.object_name for r in RD.read_landed(spark, path).collect()] == ["a"]
    WR.land_once(objects(spark, ["a", "b"], "second"), path)
    assert sorted((r.object_name, r.content) for r in RD.read_landed(spark, path).collect()) == [("a", "first"), ("b", "second")]
    assert WR.clear_abandoned_landings(spark, path, 3600) == []
    assert len(WR.clear_abandoned_landings(spark, path, -10)) == 1
    assert RD.read_landed(spark, path).count() == 2


def test_entries_are_created_once(spark, tmp_path):
    log, other = CommitLog(spark, str(tmp_path / "t")), CommitLog(spark, f"file://{tmp_path}/t")
    assert log.latest() == (0, {})
    log.commit(1, {"x": "é"})
    with pytest.raises(Conflict):
        other.commit(1, {"x": 2})
    other.commit(2, {"x": 3})
    assert log.latest() == (2, {"x": 3}) and len(os.listdir(tmp_path / "t" / "_commits")) >= 2
    assert not [name for name in os.listdir(tmp_path / "t" / "_commits") if name.startswith("_")]


KEYS = ["k1", "k2"]


def features(spark, rows):
    return spark.createDataFrame(rows, "k1 STRING, k2 INT, version INT, value STRING")


def test_merge_keeps_the_greatest_version_and_touches_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    assert KY.merge_keyed(features(spark, [(f"c{i}", i % 3, 1, "old") for i in range(200)] + [(None, None, None, "null key")]), path, KEYS, "version", buckets=16) == 16
    before = CommitLog(spark, path).latest()[1]["folders"]
    written = KY.merge_keyed(features(spark, [("c1", 1, 2, "new"), ("c2", 2, 0, "late"), ("c3", 0, 1, "again"), ("c1", 1, 1, "older")]), path, KEYS, "version")
    after = CommitLog(spark, path).latest()[1]["folders"]
    assert written <= 3 and sum(after[b] != before[b] for b in before) == written
    rows = {(r.k1, r.k2): r.value for r in KY.read_keyed(spark, path).collect()}
    assert len(rows) == 201 == KY.read_keyed(spark, path).count()
    assert (rows["c1", 1], rows["c2", 2], rows["c3", 0], rows[None, None]) == ("new", "old", "again", "null key")
    plan = KY.read_keyed(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert KY.clear_replaced(spark, path) == [] and KY.read_keyed(spark, path).count() == 201


def test_merges_at_the_same_time_lose_nothing_and_numbers_apply_once(spark, tmp_path):
    path = str(tmp_path / "t")
    threads = [threading.Thread(target=KY.merge_keyed, args=(features(spark, [(f"c{i}", j, 1, f"run {i}") for j in range(5)]), path, KEYS, None, 2)) for i in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert KY.read_keyed(spark, path).count() == 15
    for value in ("first", "repeated"):
        KY.merge_keyed(features(spark, [("x", 1, 1, value)]), path, KEYS, number=7)
    KY.merge_keyed(features(spark, [("x", 1, 1, "before")]), path, KEYS, number=6)
    assert [r.value for r in KY.read_keyed(spark, path).where("k1 = 'x'").collect()] == ["first"]
    KY.merge_keyed(features(spark, []), path, KEYS, number=8)
    assert KY.read_keyed(spark, path).count() == 16


def test_new_columns_and_wider_types_are_merged(spark, tmp_path):
    path = str(tmp_path / "t")
    KY.merge_keyed(spark.sql("SELECT 'a' AS k1, 1 AS k2, 5 AS n"), path, KEYS, buckets=2)
    KY.merge_keyed(spark.sql("SELECT 'a' AS k1, 1 AS k2, 'more' AS extra UNION ALL SELECT 'b', 2, null"), path, KEYS)
    assert {(r.k1, r.n, r.extra) for r in KY.read_keyed(spark, path).collect()} == {("a", None, "more"), ("b", None, None)}


def put(folder, date, name, text):
    os.makedirs(f"{folder}/ingestion_date={date}", exist_ok=True)
    with open(f"{folder}/ingestion_date={date}/{name}", "w") as f:
        f.write(text)


def test_versions_that_arrive_late_change_nothing(spark, tmp_path):
    source, sink, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    put(source, "2024-02-01", "CIK1_a_mda.txt", "going concern")
    put(source, "2024-02-01", "CIK2_b_mda.txt", "restructuring")
    incremental_features(spark, source, sink, state, buckets=4)
    put(source, "2024-01-01", "CIK1_a_mda.txt", "fine, but older")
    put(source, "2024-03-01", "CIK2_b_mda.txt", "newer: going concern")
    put(source, "2024-03-01", "CIK3_c_mda.txt", "fine")
    incremental_features(spark, source, sink, state)
    rows = {r.accession: r for r in current_features(spark, sink).collect()}
    assert {name: (rows[name].going_concern, rows[name].restructuring) for name in rows} == {"a": (1, 0), "b": (1, 0), "c": (0, 0)}
    again = str(tmp_path / "out2")  # all at once from the start
    incremental_features(spark, source, again, str(tmp_path / "state2"), buckets=3)
    cells = lambda path: sorted(tuple(r) for r in current_features(spark, path).drop("processed_at", KY.BUCKET).select("accession", "section", "text_length", "going_concern").collect())
    assert cells(again) == cells(sink)
    # the batches come once more after a lost checkpoint: known numbers are not applied, later ones change nothing
    incremental_features(spark, source, sink, str(tmp_path / "state3"))
    assert cells(again) == cells(sink)


def test_chosen_names_stay_off_the_driver(spark, tmp_path, monkeypatch):
    for i in range(30):
        (tmp_path / f"CIK{i}_a b%{i}_mda.txt").write_bytes(f"text {i} ".encode() + b"\xff")
    listed = spark.read.format("binaryFile").load(str(tmp_path)).selectExpr("path AS object_name", "length")
    collected, real = [], type(listed).collect
    monkeypatch.setattr(type(listed), "collect", lambda df: collected.append(df.columns) or real(df))
    read = RD.read_chosen(spark, listed)
    monkeypatch.undo()
    assert collected == [["files", "bytes"]]  # one row of sums
    assert sorted(r.text for r in read.collect()) == sorted(f"text {i} �" for i in range(30))
    monkeypatch.setattr(RD, "CHOSEN_FILES", 7)
    assert RD.read_chosen(spark, listed).rdd.getNumPartitions() == 5
    many = spark.range(100_000).select(F.concat(F.lit("mem:/CIK1_"), "id", F.lit("_mda.txt")).alias("object_name"))
    monkeypatch.undo()
    import io

    assert RD.read_chosen(spark, many, opener=lambda name: io.BytesIO(name.encode())).where("length(text) > 0").count() == 100_000
    with pytest.raises(Exception, match="pass an opener for mem"):
        RD.read_chosen(spark, many.limit(1)).collect()
