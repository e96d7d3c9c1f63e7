import pytest

from ledgerlight.functions import scores
from ledgerlight.operators import composite as C
from ledgerlight.plans import dashboard as D
from ledgerlight.plans.layers import build_composite, latest_scored

GOLD = (
    "cik BIGINT, company_name STRING, period_end DATE, distress_label INT, altman_z_score DOUBLE, distress_zone STRING, "
    "revenue_declining_3q INT, net_income_declining_3q INT, revenue_growth_qoq DOUBLE, net_income_growth_qoq DOUBLE, "
    "brd_after_emerging STRING, brd_disposition STRING"
)
TEXT = (
    "cik STRING, accession STRING, section STRING, sentiment_score DOUBLE, risk_level STRING, going_concern STRING, "
    "going_concern_explicit INT, liquidity_risk INT, covenant_breach_mentioned INT, restructuring INT"
)


def day(text):
    import datetime

    return datetime.date.fromisoformat(text)


@pytest.fixture(scope="module")
def gold(spark):
    rows = [
        (1, "A", day("2020-12-31"), 1, -3.0, "distress", 1, 1, -0.5, -0.5, "merged, sold", "emerged"),
        (1, "A", day("2021-12-31"), 1, 6.0, "safe", 0, 0, 0.1, None, "merged, sold", "emerged"),
        (2, "B", day("2020-12-31"), 0, None, None, None, 0, -0.10, -0.15, None, None),
        (3, "C", day("2020-12-31"), 0, 2.5, "grey", 0, 0, None, None, None, None),
    ]
    return spark.createDataFrame(rows, GOLD)


@pytest.fixture(scope="module")
def texts(spark):
    rows = [
        ("0000000001", "a", "mda", -1.0, "CRITICAL", "1", 1, 1, 1, 1),
        ("1", "b", "risk", 5.0, "odd", "x", 0, None, 0, 0),
        ("3", "c", "mda", None, None, None, None, None, None, None),
        ("9", "d", "mda", 0.0, "low", "0", 0, 0, 0, 0),
    ]
    return spark.createDataFrame(rows, TEXT)


def test_z_component(evaluate):
    zs = [None, -1.0, 0.0, 2.5, 5.0, 9.0]
    assert evaluate(zs, scores.z_component, kind="double") == [0.5, 1.0, 1.0, 0.5, 0.0, 0.0]


def test_zone_bounds_are_strict(evaluate):
    values = [0.6, 0.6000001, 0.35, 0.3499999, None]
    assert evaluate(values, scores.composite_zone, kind="double") == ["grey", "distress", "grey", "safe", None]


def test_risk_labels(evaluate):
    assert evaluate([0.0, 0.2, 0.5, 0.85], scores.risk_label, kind="double") == ["low", "medium", "high", "critical"]


def test_company_signals(texts):
    out = {r.cik: r for r in C.company_signals(texts).collect()}
    assert set(out) == {1, 3, 9}
    one = out[1]
    assert one.n_docs_analysed == 2 and one.any_going_concern == 1
    assert one.avg_sentiment_score == 2.0
    assert one.llm_component == pytest.approx(0.4 * 0.5 + 0.3 * (1.0 + 0.33) / 2 + 0.3 * 1.0)
    assert one.avg_risk_level == "high"
    assert out[3].llm_component is None and out[3].avg_risk_level == "medium"
    assert out[9].llm_component == pytest.approx(0.4 * 0.5) and out[9].avg_risk_level == "low"


def test_composite(gold, texts):
    out = {(r.cik, r.period_end.year): r for r in build_composite(gold, texts).collect()}
    assert len(out) == 4
    first = out[1, 2020]
    assert first.trend_component == pytest.approx(1.0) and first.z_component == 1.0
    assert first.composite_score == pytest.approx(0.6 + 0.2 * first.llm_component + 0.2)
    assert (first.composite_zone, first.after_emerging_class) == ("distress", "acquired")
    assert out[2, 2020].trend_component == 0.0  # drops exactly at the bound do not count
    assert out[3, 2020].llm_component == 0.5 and out[3, 2020].n_docs_analysed == 1
    assert (out[2, 2020].avg_risk_level, out[2, 2020].n_docs_analysed) == ("unknown", 0)
    assert all(0 <= r.composite_score <= 1 for r in out.values())


def test_without_text_and_without_columns(gold, spark):
    assert {r.llm_component for r in build_composite(gold).collect()} == {0.5}
    bare = build_composite(gold.select("cik", "altman_z_score"), spark.createDataFrame([("1",)], "cik STRING"))
    assert {r.after_emerging_class for r in bare.collect()} == {"unknown"}
    assert {r.trend_component for r in bare.collect()} == {0.0}
    one = bare.filter("cik = 1").first()
    assert one.llm_component == pytest.approx(0.4 * 0.5 + 0.3 * 0.33)
    assert one.avg_sentiment_score == 0.5


def test_top_distress_has_one_row_per_name(spark):
    rows = [(i, f"n{i % 15}", "2020-01-01", 0.61 + (i % 29) / 100, "distress" if i % 5 else "grey") for i in range(90)]
    df = spark.createDataFrame(rows, "cik INT, company_name STRING, period_end STRING, composite_score DOUBLE, composite_zone STRING")
    df = df.selectExpr("*", "0.1 AS z_component", "0.1 AS llm_component", "0.1 AS trend_component")
    best = {}
    for cik, name, _, score, zone in rows:
        if zone == "distress" and (name not in best or score > best[name]):
            best[name] = score
    top = C.top_distress(df).collect()
    assert [r.composite_score for r in top] == sorted(best.values(), reverse=True)[:10]
    assert len({r.company_name for r in top}) == 10


def test_latest_scored(gold):
    assert {(r.cik, r.altman_z_score) for r in latest_scored(gold).collect()} == {(1, 6.0), (3, 2.5)}


def test_text_reports(gold, texts):
    rows = {r.accession: r for r in D.named_texts(texts, gold).collect()}
    assert (rows["a"].company_name, rows["d"].company_name) == ("A", "Unknown")
    scatter = D.sentiment_against_z(texts, gold).collect()
    assert {(r.accession, r.altman_z_score) for r in scatter} == {("a", 6.0), ("c", 2.5)}
    spread = {r.section: r for r in D.sentiment_spread(texts).collect()}
    assert (spread["mda"].n, spread["mda"].median_value) == (2, -0.5)


def test_outcomes_use_the_first_stored_row(gold, texts):
    composite = build_composite(gold, texts)
    assert [(r.outcome, r.companies) for r in D.outcome_counts(composite).collect()] == [("acquired", 1)]
    assert D.outcome_detail(composite).first().z_component == 1.0


def test_histogram_bins(spark):
    df = spark.createDataFrame([(-20.0,), (20.0,), (0.0,), (None,)], "v DOUBLE")
    assert {(r.bin, r.n) for r in D.histogram(df, "v", -20.0, 20.0, 80).collect()} == {(1, 1), (80, 1), (41, 1)}


def test_contributions_for_a_handful(gold, texts):
    parts = D.contributions(build_composite(gold, texts), ["A"]).collect()
    assert [r.period_end.year for r in parts] == [2020, 2021]
    assert (parts[0].z_contribution, parts[0].trend_contribution) == (0.6, 0.2)


def test_all_trend_signals_with_neutral_parts_stay_grey(spark):
    """0.5 * 0.6 + 0.5 * 0.2 + trend * 0.2 is not above 0.60 in double arithmetic."""
    row = (7, "N", day("2020-12-31"), 0, None, None, 1, 1, -0.5, -0.5, None, None)
    out = build_composite(spark.createDataFrame([row], GOLD)).first()
    trend = 0.40 + 0.30 + 0.20 + 0.10
    assert out.composite_score == 0.60 * 0.5 + 0.20 * 0.5 + 0.20 * trend
    assert out.composite_zone == "grey"
