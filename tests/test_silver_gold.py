import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.operators import gold as G
from ledgerlight.operators import silver as S
from ledgerlight.plans import diagnostics as A

SCHEMA = (
    "cik BIGINT, company_name STRING, period_end DATE, fiscal_year INT, fiscal_period STRING, "
    "form_type STRING, filed_date DATE, field STRING, value DOUBLE"
)
D = datetime.date


def fact(field, value, filed=D(2021, 2, 1), fp="FY", form="10-K", cik=1, end=D(2020, 12, 31), name="Acme"):
    return (cik, name, end, end.year, fp, form, filed, field, float(value))


def test_latest_filing_wins_and_ties_are_total(spark):
    rows = [
        fact("revenue", 1, None), fact("revenue", 2, D(2021, 2, 1)), fact("revenue", 3, D(2021, 3, 1), form="10-K/A"),
        fact("revenue", 5, D(2021, 3, 1)), fact("revenue", 9, D(2021, 3, 1)), fact("cash", 7, None),
    ]
    out = S.latest_filed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.field, r.value, r.form_type) for r in out} == {("revenue", 9.0, "10-K"), ("cash", 7.0, "10-K")}


def test_representative_comes_from_the_survivors(spark):
    rows = [
        fact("revenue", 1, D(2021, 1, 1), "FY"), fact("revenue", 2, D(2021, 5, 1), "Q1", "10-Q"),
        fact("cash", 3, D(2021, 4, 1), "Q2", "10-Q"),
    ]
    for build in (S.silver, S.silver_by_steps):
        row = build(spark.createDataFrame(rows, SCHEMA)).first()
        assert (row.fiscal_period, row.filed_date, row.revenue, row.cash) == ("Q2", D(2021, 4, 1), 2.0, 3.0)


def test_measures(spark):
    rows = []
    for cik, values in enumerate([
        {"operating_income": 4, "net_income": 1}, {"net_income": 1, "interest_expense": 2}, {"interest_expense": 2},
        {"net_income": -1}, {"cash": 1}, {"assets_current": 5, "liabilities_current": 2}, {"assets_current": 5},
    ]):
        rows += [fact(field, value, cik=cik) for field, value in values.items()]
    out = {r.cik: r for r in S.silver(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [out[i].ebit for i in range(7)] == [4.0, 3.0, 2.0, -1.0, None, None, None]
    assert (out[5].working_capital, out[6].working_capital) == (3.0, None)


@pytest.fixture(scope="module")
def skewed_facts(spark):
    """A third of all facts belongs to one company, and much of that to one period."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        hot = i % 3 == 0
        cik = 1 if hot else rng.randrange(2, 60)
        end = D(2020, 12, 31) if hot and i % 2 else D(2000 + rng.randrange(20), rng.choice([3, 6, 9, 12]), 28)
        filed = None if rng.random() < 0.1 else D(2021, 1, rng.randrange(1, 6))
        fp, form = rng.choice([("FY", "10-K"), ("Q1", "10-Q"), ("Q4", "10-Q"), ("", "20-F"), ("H1", "6-K")])
        rows.append(fact(
            rng.choice(K.FACT_FIELDS), rng.randrange(-3, 4), filed, fp, form, cik, end, rng.choice(["Acme", "Bolt", "Unknown"])
        ))
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def test_both_silver_forms_agree_on_skewed_facts(skewed_facts):
    fused = sorted(map(str, S.silver(skewed_facts).collect()))
    assert fused == sorted(map(str, S.silver_by_steps(skewed_facts).collect()))
    assert A.duplicate_keys(S.silver(skewed_facts)).count() == 0


def test_silver_does_not_depend_on_the_order_of_input(skewed_facts):
    shuffled = skewed_facts.orderBy(F.rand(3)).repartition(3)
    assert sorted(map(str, S.silver(skewed_facts).collect())) == sorted(map(str, S.silver(shuffled).collect()))


def test_facts_are_combined_before_they_are_shuffled(skewed_facts):
    plan = S.silver(skewed_facts.coalesce(2))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(cik" in line]
    assert len(exchanges) == 2
    after = plan.splitlines()[plan.splitlines().index(exchanges[1]) + 1]
    assert "partial_min" in after


def test_hard_dedup_keeps_the_earliest_year(spark):
    df = spark.createDataFrame([(1, "p", 2021, 1.0), (1, "p", 2020, 2.0), (1, "p", None, 0.0)], "cik INT, period_end STRING, fiscal_year INT, v DOUBLE")
    assert S.hard_dedup(df).first().v == 2.0


def test_ensure_columns(spark):
    out = S.ensure_columns(spark.range(1), {"id": "int", "x": "double"})
    assert out.dtypes == [("id", "bigint"), ("x", "double")]


GOLD = "cik BIGINT, form_type STRING, period_end DATE, revenue DOUBLE, net_income DOUBLE, assets_total DOUBLE, equity DOUBLE"


def test_trends_stay_inside_company_and_form(spark):
    def row(form, year, revenue, income=1.0, assets=10.0):
        return (1, form, D(year, 12, 31), revenue, income, assets, 1.0)

    rows = [row("10-K", 2015 + i, r) for i, r in enumerate([9.0, 8.0, 7.0, 6.0, 6.0, None, 4.0])]
    rows += [row("10-Q", 2015, 100.0, 0.0), row("10-Q", 2016, 0.0, -2.0), row("10-Q", 2017, 5.0, 1.0)]
    df = G.with_growth(G.with_declines(G.with_previous(spark.createDataFrame(rows, GOLD))))
    annual = df.filter("form_type = '10-K'").orderBy("period_end").collect()
    assert [r.revenue_declining_3q for r in annual] == [0, 0, 0, 1, 0, 0, 0]
    assert [r.prev_revenue for r in annual] == [None, 9.0, 8.0, 7.0, 6.0, 6.0, None]
    quarters = df.filter("form_type = '10-Q'").orderBy("period_end").collect()
    assert [r.revenue_growth_qoq for r in quarters] == [None, -1.0, None]
    assert [r.net_income_growth_qoq for r in quarters] == [None, None, 1.5]
    assert [r.asset_growth_qoq for r in quarters] == [None, 0.0, 0.0]


def test_zone_bounds(evaluate):
    from ledgerlight.functions import scores

    zs = [None, -5.0, 1.2299, 1.23, 2.9, 2.9001]
    assert evaluate(zs, scores.z_zone, kind="double") == [None, "distress", "distress", "grey", "grey", "safe"]


RATIO_ROWS = "fiscal_period STRING, assets_total DOUBLE, liabilities_total DOUBLE, working_capital DOUBLE, retained_earnings DOUBLE, ebit DOUBLE, equity DOUBLE, revenue DOUBLE"


def test_score_guards_and_winsorising(spark):
    rows = [
        ("FY", 10.0, 5.0, 1.0, 2.0, 1.0, 4.0, 8.0), ("Q1", 10.0, 5.0, 1.0, 2.0, 1.0, 4.0, 8.0),
        ("FY", 10.0, 0.0, 1.0, 2.0, 1.0, 4.0, 8.0), ("FY", 10.0, 5.0, None, 2.0, 1.0, 4.0, 8.0),
        ("FY", 0.1, 5.0, 1000.0, 2.0, 1.0, 4.0, 8.0), ("FY", 0.1, 5.0, -1000.0, 2.0, 1.0, 4.0, 8.0),
    ]
    out = G.with_z_score(G.with_ratios(spark.createDataFrame(rows, RATIO_ROWS))).collect()
    expected = 0.717 * 0.1 + 0.847 * 0.2 + 3.107 * 0.1 + 0.420 * 0.8 + 0.998 * 0.8
    assert [r.altman_z_score for r in out] == [pytest.approx(expected), None, None, None, 20.0, -20.0]
    assert out[1].x1_wc_to_assets == 0.1 and out[2].x4_equity_to_liab is None


def test_labels(spark):
    universe = spark.createDataFrame(
        [("7", "1", "2012.0", "12.5", "n/a"), ("0000000008", "x", "", None, "3")],
        "cik STRING, distress_label STRING, brd_year_emerged STRING, brd_days_in_bk STRING, brd_chapter STRING",
    )
    labels = G.universe_labels(universe).orderBy("cik").collect()
    assert [(r.cik, r.distress_label, r.brd_year_emerged, r.brd_days_in_bk, r.brd_chapter) for r in labels] == [
        ("0000000007", 1, 2012, 12.5, None), ("0000000008", None, None, None, 3),
    ]
    silver = spark.createDataFrame([(7, 1.0), (8, 1.0), (9, 1.0), (7, 0.0), (7, None)], "cik BIGINT, assets_total DOUBLE")
    joined = G.join_labels(silver, G.universe_labels(universe)).orderBy("cik").collect()
    assert [(r.cik, r.distress_label) for r in joined] == [(7, 1), (8, 0), (9, 0)]
