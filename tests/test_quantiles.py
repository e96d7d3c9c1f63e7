import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlight.operators import quantiles as Q

WANTED = {"low": 0.1, "q1": 0.25, "mid": 0.5, "q3": 0.75, "high": 0.99}


def expected(values):
    return [float(np.quantile(values, p)) for p in WANTED.values()]


def test_large_groups_take_the_narrow_way(spark):
    """A group with a hot value, a spread group, a small one, a null key and one without values."""
    rng = random.Random(5)
    data = [("hot", 1.5 if rng.random() < 0.4 else rng.gauss(0, 9)) for _ in range(9000)]
    data += [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 9)) for _ in range(9000)]
    data += [("few", float(i)) for i in range(7)] + [(None, 2.0), (None, None), ("none", None)]
    df = spark.createDataFrame(data, "g STRING, v DOUBLE").repartition(7)
    out = {r.g: r for r in Q.exact_quantiles(df, ["g"], "v", WANTED, {"n": F.count("v")}, accuracy=500).collect()}
    assert set(out) == {"hot", "wide", "few", None, "none"}
    for name in ("hot", "wide", "few", None):
        values = [v for g, v in data if g == name and v is not None]
        assert out[name].n == len(values)
        assert [out[name][q] for q in WANTED] == pytest.approx(expected(values), rel=1e-12)
    assert out["none"].mid is None and out["none"].n == 0


def test_whole_table(spark):
    values = [float(i * i % 1013) for i in range(4000)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v DOUBLE").repartition(5)
    row = Q.exact_quantiles(df, [], "v", WANTED, accuracy=200).first()
    assert [row[q] for q in WANTED] == pytest.approx(expected(values))
    summary = Q.describe(df, "v").first()
    assert (summary.n, summary.min_value, summary.max_value) == (4000, min(values), max(values))
    assert summary.std_value == pytest.approx(np.std(values, ddof=1))


def test_only_the_enclosed_values_are_ranked(spark):
    df = spark.range(50_000).selectExpr("CAST(id AS DOUBLE) AS v", "1 AS g")
    plan = Q.exact_median(df, ["g"], "v", "m")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" in plan and " percentile(" not in plan and "median(" not in plan
    assert Q.exact_median(df, ["g"], "v", "m").first().m == 24_999.5


def test_empty_table(spark):
    df = spark.createDataFrame([], "g STRING, v DOUBLE")
    assert Q.exact_median(df, ["g"], "v", "m").count() == 0
    assert Q.describe(df, "v").first().n == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5).map(float) | st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_any_small_list(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    row = Q.exact_quantiles(df.withColumn("g", F.lit("x")), ["g"], "v", WANTED, accuracy=20).first()
    assert [row[q] for q in WANTED] == pytest.approx(expected(values), rel=1e-9, abs=1e-9)
