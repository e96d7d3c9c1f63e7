"""All registered queries of the engine against their oracles; those of the llm subpackage have tests of their own."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: plan for name, plan in entry.queries().items() if name in entry.QUERIES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@needs_data
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_oracle(spark, con, name):
    verdict, _, _ = compare(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert verdict in ("ok", "rows only"), verdict


def test_every_operator_of_the_survey_is_registered():
    covered = {name.split("_")[0].upper() for name in QUERIES}
    wanted = {
        f"{prefix}{i}" for prefix, n in {
            "SRC": 9, "SNK": 8, "FLT": 7, "SLV": 11, "GLD": 10, "TXT": 8, "NLP": 16, "CMP": 14, "UNI": 12,
            "QRY": 13, "DSH": 28,
        }.items() for i in range(1, n + 1)
    }
    assert wanted <= covered
    assert set(ORACLES) == set(QUERIES)


@needs_data
def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["distress_label", "distress_zone", "n_periods", "pct"]
    assert result.count() > 0


@needs_data
def test_plans_have_no_cartesian_product_and_no_python(spark):
    scoring = {"nlp14_score_documents"}
    writing = {name for name in QUERIES if name.startswith(("src1_read", "src2", "src4", "src5", "src7", "snk", "inc1"))}
    for name in sorted(set(QUERIES) - writing):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
        assert ("EvalPython" in plan or "InPandas" in plan) == (name in scoring), name


@needs_data
def test_scans_read_only_what_is_needed(spark):
    plan = QUERIES["qry1_zone_distribution"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    lineitem = next(scan for scan in scans if "l_orderkey" in scan)
    assert "l_tax" not in lineitem and "l_discount" not in lineitem


@needs_data
@pytest.mark.parametrize("name", ["qry2_score_by_label", "qry4_group_table", "gld10_describe", "dsh7_median_z_over_time"])
def test_reports_compute_their_input_once(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan  # all steps read the stored input
