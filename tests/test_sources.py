import datetime
import hashlib
import inspect
import os
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

from ledgerlight import constants as K
from ledgerlight.operators import filings as TX
from ledgerlight.operators import text_features as N
from ledgerlight.operators import universe as U
from ledgerlight.plans import diagnostics as A
from ledgerlight.operators.filings import land_sections, landed_sections
from ledgerlight.plans.layers import build_text_features, build_universe
from ledgerlight.session import scratch_path, shared_folder
from ledgerlight.sources import readers as RD
from ledgerlight.sources import writers as WR
from ledgerlight.streaming.incremental import current_features, incremental_features

SILVER = "cik BIGINT, period_end DATE, fiscal_year INT, v DOUBLE"


def silver_rows(spark, rows):
    return spark.createDataFrame([(c, datetime.date(2020, 1, 1), y, v) for c, y, v in rows], SILVER)


def test_silver_replaces_only_touched_years(spark, tmp_path):
    path = str(tmp_path / "silver")
    WR.write_silver(silver_rows(spark, [(1, 2019, 1.0), (1, 2020, 2.0), (1, None, 9.0)]), path)
    WR.write_silver(silver_rows(spark, [(2, 2020, 3.0)]), path)
    rows = RD.read_partitioned(spark, path).select("cik", "fiscal_year", "v").collect()
    assert sorted(map(tuple, rows)) == [(1, 2019, 1.0), (2, 2020, 3.0)]


def test_gold_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "gold")
    make = "SELECT 1 AS cik, CAST({} AS INT) AS distress_label"
    WR.write_gold(spark.sql(make.format(1)).union(spark.sql(make.format("NULL"))), path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["distress_label=1", "distress_label=unknown"]
    WR.write_gold(spark.sql(make.format(0)), path)
    assert [d for d in os.listdir(path) if "=" in d] == ["distress_label=0"]


def test_drifting_files_merge_by_name(spark, tmp_path):
    spark.sql("SELECT 1 AS a").write.parquet(str(tmp_path / "t/section=mda"))
    spark.sql("SELECT 2 AS b").write.parquet(str(tmp_path / "t/section=risk"))
    rows = RD.read_partitioned(spark, str(tmp_path / "t")).select("a", "b", "section").collect()
    assert sorted(map(tuple, rows), key=str) == [(1, None, "mda"), (None, 2, "risk")]


def test_first_available(spark, tmp_path):
    path = str(tmp_path / "layer")
    spark.sql("SELECT 1 AS a").write.parquet(path)
    assert RD.first_available(spark, [str(tmp_path / "none"), path], "a INT").count() == 1
    empty = RD.first_available(spark, [str(tmp_path / "none")], "a INT, b STRING")
    assert empty.count() == 0 and empty.columns == ["a", "b"]


def test_latin1_cases(spark, tmp_path):
    path = tmp_path / "cases.csv"
    path.write_bytes('NameCorp,CikBefore,Chapter\n"Caf\xe9, Inc",1.0,11\nB,,7\nC,2,11,extra\n'.encode("latin-1"))
    rows = RD.read_bankruptcy_cases(spark, str(path)).collect()
    assert [(r.NameCorp, r.CikBefore) for r in rows] == [("Café, Inc", "1.0"), ("B", None), ("C", "2")]
    assert RD.read_bankruptcy_cases(spark, str(path), drop_malformed=True).count() == 2


CASES = [
    # name, cik, chapter, filed, year, assets, prepackaged
    ("Old", "1.0", "11", "1/2/2009", "2009", "900", "yes"),
    ("Small", "2.0", "11", "1/2/2012", "2012", "499.9", "yes"),
    ("Seven", "3.0", "7", "1/2/2012", "2012", "900", "yes"),
    ("NoKey", None, "11", "1/2/2012", "2012", "900", "yes"),
    ("First", "4.0", "11", "1/2/2012", "2012", "500", "prenegotiated"),
    ("Again", "4", "11.0", "3/4/2014", "2014", "1e3", "free fall"),
    ("Member", "5.0", "11", "x", "2010", "900", None),
]


@pytest.fixture(scope="module")
def universe(spark):
    cases = spark.createDataFrame(
        CASES, "NameCorp STRING, CikBefore STRING, Chapter STRING, DateFiled STRING, YearFiled STRING, AssetsBefore STRING, Prepackaged STRING"
    )
    members = spark.createDataFrame([("BRK.B", "Member Inc", 5), ("X", "Xco", 6)], "Symbol STRING, Security STRING, CIK INT")
    return build_universe(members, cases), cases


def test_universe(universe):
    rows = universe[0].collect()
    assert [(r.cik, r.company_name, r.distress_label) for r in rows] == [
        ("0000000004", "Again", 1), ("0000000005", "Member", 1), ("0000000006", "Xco", 0),
    ]
    assert universe[0].columns == K.UNIVERSE_COLUMNS
    again, member, xco = rows
    assert (again.distress_event_date, again.distress_event_type, again.brd_prepackaged) == ("2014-03-04", "chapter_11", 0)
    assert (again.brd_voluntary, again.brd_emerged, again.brd_sic_division) == (1, 0, "")
    assert (member.distress_event_date, member.brd_assets_before_m) == ("", 900.0)
    assert (xco.ticker, xco.brd_chapter, xco.brd_disposition) == ("X", None, "")


def test_year_is_read_from_the_date_where_the_file_has_none(universe):
    kept = U.filter_cases(universe[1].drop("YearFiled"))
    assert sorted(r.NameCorp for r in kept.collect()) == ["Again", "First"]


def test_universe_csv(spark, universe, tmp_path):
    path = str(tmp_path / "universe")
    WR.write_universe(universe[0], path)
    back = RD.read_universe(spark, path)
    assert back.columns == K.UNIVERSE_COLUMNS
    assert {(r.cik, r.distress_label, r.brd_assets_before_m) for r in back.collect()} == {
        ("0000000004", "1", "1000.0"), ("0000000005", "1", "900.0"), ("0000000006", "0", None),
    }


def test_landing_writes_once_with_lineage(spark, tmp_path):
    path = str(tmp_path / "landed")
    schema = "object_name STRING, content STRING, source_url STRING, http_status INT, cik STRING"
    objects = spark.createDataFrame([("a", "é", "u", 200, "1"), ("b", "x", "u", 200, "2")], schema)
    WR.land_with_lineage(objects, path, extra=["cik"])
    changed = spark.createDataFrame([("a", "other", "u", 200, "1"), ("c", "y", "u", 200, "3")], schema)
    WR.land_with_lineage(changed, path, spark.read.parquet(path).select("object_name"))
    rows = {r.object_name: r for r in spark.read.parquet(path).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"].sha256 == hashlib.sha256("é".encode()).hexdigest() and rows["a"].size_bytes == 2
    assert '"cik":"1"' in rows["a"].meta_json and rows["a"].fetched_at_utc.endswith("+00:00")


def test_run_summary(spark):
    df = spark.createDataFrame([("ok", 1048576), ("ok", 524288), ("no_filings", None)], "status STRING, bytes INT")
    assert {(r.status, r.n, r.total_mb) for r in TX.run_summary(df).collect()} == {("ok", 2, 1.5), ("no_filings", 1, 0.0)}


def test_freshness(spark, tmp_path):
    fresh, stale = str(tmp_path / "fresh"), str(tmp_path / "stale")
    for path in (fresh, stale):
        spark.range(3).repartition(2).write.parquet(path)
    for name in os.listdir(stale):
        os.utime(os.path.join(stale, name), (0, 0))
    rows = {r.layer: r for r in A.freshness_report(spark, {"f": fresh, "s": stale, "n": str(tmp_path / "n")}).collect()}
    assert (rows["f"].n_files, rows["f"].is_fresh) == (2, True)
    assert (rows["s"].is_fresh, rows["s"].age_days > 7) == (False, True)
    assert (rows["n"].n_files, rows["n"].is_fresh, rows["n"].newest) == (0, False, None)


def test_column_profile(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", None)], "s STRING, n INT")
    assert {tuple(r) for r in A.column_profile(df).collect()} == {("s", "string", 2), ("n", "int", 2)}
    assert {tuple(r) for r in A.value_counts(df, "s").collect()} == {("a", 2)}


def test_scratch_folder_is_a_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root) and scratch_path(spark, "x") == scratch_path(spark, "x")
    assert shared_folder(spark) == root


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    def session(master, warehouse, checkpoint=None):
        conf = {"spark.sql.warehouse.dir": warehouse} | ({"spark.checkpoint.dir": checkpoint} if checkpoint else {})
        get = SimpleNamespace(get=lambda key, default=None: conf.get(key, default))
        return SimpleNamespace(conf=get, sparkContext=SimpleNamespace(master=master, getConf=lambda: get))

    assert shared_folder(session("local[4]", "file:/w")) == "file:/w/_checkpoints"
    assert shared_folder(session("yarn", "hdfs://n/w")) == "hdfs://n/w/_checkpoints"
    assert shared_folder(session("yarn", "file:/w", "s3a://b/c")) == "s3a://b/c"
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session("spark://h:7077", warehouse))


def test_section_files(spark, tmp_path):
    (tmp_path / "ingestion_date=2024-02-03").mkdir()
    (tmp_path / "ingestion_date=2024-02-03" / "CIK0000000009_acc_mda.txt").write_bytes(b"going\xff concern")
    row = RD.read_filing_text(spark, str(tmp_path)).first()
    assert (row.cik, row.accession, row.section, row.ingestion_date) == ("9", "acc", "mda", "2024-02-03")
    assert row.text == "going� concern"


def test_incremental_features(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / name) for name in ("in", "out", "state"))
    os.makedirs(source)

    def put(name, text):
        with open(os.path.join(source, name), "w") as f:
            f.write(text)

    put("CIK1_a_mda.txt", "going concern")
    put("CIK1_b_risk.txt", "fine")
    incremental_features(spark, source, sink, checkpoint)
    before = {r.accession: r.processed_at for r in current_features(spark, sink).collect()}
    incremental_features(spark, source, sink, checkpoint)  # nothing new
    put("CIK2_c_mda.txt", "restructuring")
    incremental_features(spark, source, sink, checkpoint)
    rows = {r.accession: r for r in current_features(spark, sink).collect()}
    assert set(rows) == {"a", "b", "c"} and rows["a"].going_concern == 1 and rows["c"].restructuring == 1
    assert {name: rows[name].processed_at for name in before} == before  # finished documents were left alone


def test_cells_with_line_breaks_and_headers_that_differ(spark, tmp_path):
    folder = tmp_path / "u"
    folder.mkdir()
    (folder / "a.csv").write_text('cik,company_name,x\n1,"two\nlines",a\n2,plain\n')
    rows = sorted((r.cik, r.company_name, r.x) for r in RD.read_universe(spark, str(folder)).collect())
    assert rows == [("0000000001", "two\nlines", "a"), ("0000000002", "plain", None)]
    (folder / "b.csv").write_text("company_name,cik,x\nother,3,c\n")
    with pytest.raises(ValueError, match="different headers"):
        RD.read_universe(spark, str(folder))


def test_only_missing_folders_count_as_unavailable(spark, tmp_path):
    assert RD.first_available(spark, [str(tmp_path / "none")], "a INT").count() == 0
    (tmp_path / "broken").mkdir()
    with pytest.raises(AnalysisException):
        RD.first_available(spark, [str(tmp_path / "broken")], "a INT")


def test_landing_is_write_once(spark, tmp_path):
    path = str(tmp_path / "landed")
    schema = "object_name STRING, content STRING, source_url STRING, http_status INT"
    objects = spark.createDataFrame([("a", "x", "u", 200), ("a", "y", "u", 200), ("b", "z", "u", 200)], schema)
    first = sorted(WR.land_with_lineage(objects, path).collect())
    assert first == sorted(spark.read.parquet(path).collect()) and [r.object_name for r in first] == ["a", "b"]
    with pytest.raises(AnalysisException):
        WR.land_with_lineage(objects, path)
    more = objects.unionAll(spark.createDataFrame([("c", "n", "u", 404)], schema))
    second = WR.land_with_lineage(more, path, spark.read.parquet(path)).collect()
    assert [(r.object_name, r.http_status) for r in second] == [("c", 404)]
    assert spark.read.parquet(path).count() == 3


def test_runs_of_text_features_stand_side_by_side(spark, tmp_path):
    path = str(tmp_path / "features")
    names = [f"ingestion_date=2024-01-01/CIK{i}_{i}_mda.txt" for i in range(4)]
    for upto in (2, 4):
        documents = spark.createDataFrame([(name, "going concern") for name in names[:upto]], "object_name STRING, text STRING")
        done = current_features(spark, path) if upto > 2 else None
        WR.append_text_features(build_text_features(documents, done=done), path)
        assert sorted(r.accession for r in current_features(spark, path).collect()) == [str(i) for i in range(upto)]
    assert len(os.listdir(path)) >= 2


def test_chosen_objects_are_read_whole_or_refused(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"CIK{i}_acc{i}_mda.txt").write_text(f"text {i}")
    listed = RD.list_filing_text(spark, str(tmp_path))
    assert inspect.signature(RD.read_chosen).parameters["max_files"].default is None
    assert RD.read_chosen(spark, listed).count() == RD.read_chosen(spark, listed, max_files=3).count() == 3
    with pytest.raises(ValueError, match="more than 2 objects"):
        RD.read_chosen(spark, listed, max_files=2)


def test_choices_are_made_on_names_alone(spark, tmp_path):
    """Nothing below an anti join, and nothing in a landing join, holds a text."""
    documents = spark.createDataFrame([("ingestion_date=2024-01-01/CIK1_a_mda.txt", "words")], "object_name STRING, text STRING")
    done = build_text_features(documents)
    names = N.parse_object_name(documents.select("object_name"))
    assert "text" not in N.resume_filter(N.parse_object_name(documents), done).columns
    assert N.resume_filter(names, N.done_keys(done)).count() == 0 and build_text_features(documents, done=done).count() == 0
    for i in range(3):
        (tmp_path / f"CIK{i}_acc{i}_mda.txt").write_text(f"text {i}")
    listed = RD.list_filing_text(spark, str(tmp_path))
    scan = N.resume_filter(listed, N.done_keys(done))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in scan.split("ReadSchema")[1].split("\n")[0]
    chosen = RD.read_chosen(spark, listed.where("cik <> '1'"))
    assert sorted(r.text for r in chosen.collect()) == ["text 0", "text 2"]
    assert RD.read_chosen(spark, listed.limit(0)).collect() == []
    landed = spark.createDataFrame([(object_key_of("1", "a", "mda"),)], "object_name STRING")
    stored = str(tmp_path / "filings")
    spark.createDataFrame([("1", "a", "word " * 50)], "cik STRING, accession STRING, text STRING").write.parquet(stored)
    filings = spark.read.parquet(stored)
    joins = landed_sections(filings, landed, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "text" not in joins.split("ReadSchema")[1].split("\n")[0]
    statuses = {r.section: r.status for r in land_sections(filings, landed, "2024-01-01").collect()}
    assert statuses["mda"] == "already_exists" and set(statuses.values()) == {"already_exists", "section_not_found"}


def object_key_of(cik, accession, section):
    return f"edgar_filings_text/ingestion_date=2024-01-01/CIK{cik:0>10}_{accession}_{section}.txt"
