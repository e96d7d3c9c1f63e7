import datetime
import json

from pyspark.sql import functions as F

from ledgerlight.operators import facts as FL
from ledgerlight.plans.layers import build_silver_from_documents
from ledgerlight.sources.readers import read_company_facts, read_submissions


def entry(end="2020-12-31", val=1.0, form="10-K", **more):
    return {"end": end, "val": val, "form": form, **more}


def doc(gaap=None, ifrs=None, cik=5, name="Acme", unit="USD"):
    def side(tags):
        return {tag: {"units": {unit: entries}} for tag, entries in (tags or {}).items()}

    return json.dumps({"cik": cik, "entityName": name, "facts": {"ifrs-full": side(ifrs), "us-gaap": side(gaap)}})


def flat(spark, *raws):
    df = spark.createDataFrame([(raw,) for raw in raws], "raw STRING")
    return [tuple(r) for r in FL.flatten_facts(df).select("cik", "field", "period_end", "form_type", "value").collect()]


DAY = datetime.date(2020, 12, 31)


def test_first_alias_with_a_usable_entry_takes_all_periods(spark):
    gaap = {
        "Revenues": [entry(form="8-K"), entry(end="bad"), entry(val=None)],
        "SalesRevenueNet": [entry(val=2), entry(end="2019-12-31", val=3)],
        "SalesRevenueGoodsNet": [entry(end="2018-12-31", val=4)],
    }
    assert sorted(flat(spark, doc(gaap))) == [
        (5, "revenue", datetime.date(2019, 12, 31), "10-K", 3.0), (5, "revenue", DAY, "10-K", 2.0),
    ]


def test_choice_is_per_document(spark):
    first, second = doc({"Revenues": [entry(val=1)]}), doc({"SalesRevenueNet": [entry(val=2)]})
    assert sorted(row[-1] for row in flat(spark, first, second)) == [1.0, 2.0]


def test_us_gaap_concept_replaces_the_other_whole(spark):
    raw = doc({"Assets": [entry(val=1)]}, {"Assets": [entry(val=9), entry(end="2019-12-31", val=9)], "Cash": [entry(val=3)]})
    assert sorted(row[-1] for row in flat(spark, raw)) == [1.0, 3.0]
    hidden = json.dumps({"cik": 1, "facts": {"us-gaap": {"Assets": {}}, "ifrs-full": {"Assets": {"units": {"USD": [entry()]}}}}})
    assert flat(spark, hidden) == []


def test_only_dollars_and_relevant_forms(spark):
    assert flat(spark, doc({"Assets": [entry()]}, unit="EUR")) == []
    forms = ["10-K/A", "10-KT", "6-K", "S-1", "8-K", "K-10"]
    rows = flat(spark, doc({"Assets": [entry(form=form) for form in forms]}))
    assert sorted(row[3] for row in rows) == ["10-K/A", "10-KT", "6-K"]


def test_broken_and_empty_documents_yield_nothing(spark):
    good = doc({"Assets": [entry()]})
    raws = [good[:-3], "", "[]", "{}", '{"facts": {}}', '{"facts": []}', "null", None, good]
    assert len(flat(spark, *raws)) == 1
    df = spark.createDataFrame([(raw,) for raw in raws], "raw STRING")
    rejected = {r.raw for r in FL.rejected_documents(df).collect()}
    assert good[:-3] in rejected and good not in rejected


def test_defaults_and_types(spark):
    raw = json.dumps({"facts": {"us-gaap": {"Assets": {"units": {"USD": [
        {"end": "2020-06-30", "val": "12", "form": "10-Q", "fy": 1999, "filed": "soon"}]}}}}})
    row = FL.flatten_facts(spark.createDataFrame([(raw,)], "raw STRING")).first()
    assert (row.cik, row.company_name, row.fiscal_year, row.fiscal_period, row.filed_date, row.value) == (
        0, "Unknown", 2020, "", None, 12.0,
    )


def test_row_form_agrees_with_documents(spark):
    gaap = {
        "Revenues": [entry(form="8-K")], "SalesRevenueNet": [entry(val=2), entry(end="2019-12-31", val=3)],
        "Assets": [entry(val=7, fp="FY")], "Unlisted": [entry(val=8)],
    }
    blobs = spark.createDataFrame([("a", doc(gaap)), ("b", doc(ifrs={"Assets": [entry(val=1)]}))], "file_key STRING, raw STRING")
    rows = FL.explode_facts(blobs)
    assert rows.filter("tag = 'Unlisted'").count() == 1
    usable = FL.filter_forms(rows).filter("try_to_date(end_str, 'yyyy-MM-dd') IS NOT NULL AND val IS NOT NULL")
    ours = FL.resolve_tag_aliases(usable).select("field", F.col("val").cast("double")).collect()
    theirs = FL.flatten_facts(blobs).select("field", "value").collect()
    assert sorted(map(tuple, ours)) == sorted(map(tuple, theirs))


def test_only_named_fields_are_decoded(spark):
    gaap = {"Assets": [entry(val=7, fp="FY"), entry(val="abc")], "Cash": [entry(val=None)]}
    raws = [("a", doc(gaap, {"Assets": [entry(val=1)], "Debt": [None, entry(val=True)]})), ("b", doc(gaap)[:-3]), ("c", doc(gaap, unit="EUR")), ("d", None)]
    blobs = spark.createDataFrame(raws, "file_key STRING, raw STRING")
    whole, narrow = FL.explode_facts(blobs), FL.explode_facts(blobs, fields=("val",))
    assert narrow.columns == ["file_key", "tag", "val"]
    assert sorted(map(str, narrow.collect())) == sorted(map(str, whole.select(*narrow.columns).collect())) and narrow.count() == 5
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "entityName" not in plan and "filed" not in plan
    assert [r.file_key for r in FL.documents_with_bad_values(blobs).collect()] == ["a"]


def test_flattening_needs_no_shuffle_and_parses_once(spark):
    df = spark.createDataFrame([(doc({"Assets": [entry()]}),)], "raw STRING")
    plan = FL.flatten_facts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("from_json") == 1


def test_read_folders_without_sidecars(spark, tmp_path):
    day = tmp_path / "edgar_company_facts" / "ingestion_date=2024-01-01"
    day.mkdir(parents=True)
    (day / "CIK0000000005.json").write_text(doc({"Assets": [entry(val=6)]}).replace(", ", ",\n"))
    (day / "CIK0000000005.json.meta.json").write_text('{"cik": "5"}')
    (day / "CIK0000000006.json").write_text("{broken")
    subs = tmp_path / "edgar_submissions"
    subs.mkdir()
    (subs / "CIK5.json").write_text(
        '{"cik": "5", "filings": {"recent": {"form": ["10-K"], "accessionNumber": ["1-2"], '
        '"filingDate": ["2020-01-01"], "primaryDocument": ["a.htm"]}}}'
    )
    blobs = read_company_facts(spark, str(tmp_path))
    assert blobs.count() == 3
    silver = build_silver_from_documents(blobs).collect()
    assert [(r.cik, r.assets_total) for r in silver] == [(5, 6.0)]
    assert read_company_facts(spark, str(tmp_path), "edgar_company_facts/").count() == 2
    filings = read_submissions(spark, str(tmp_path), "edgar_submissions/").collect()
    assert [(r.form, r.primary_document) for r in filings] == [("10-K", "a.htm")]
