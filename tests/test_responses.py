import json

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import text_features as N
from ledgerlight.plans.layers import build_text_features

CASES = [
    # section, raw, expected fields
    ("mda", '{"sentiment_score": -3}', {"sentiment_score": -1.0, "sentiment_label": "negative"}),
    ("mda", '{"sentiment_score": "0.5"}', {"sentiment_score": 0.5, "sentiment_label": "positive"}),
    ("mda", '{"sentiment_score": true}', {"sentiment_score": 1.0}),
    ("mda", '{"sentiment_score": 0.9, "sentiment_label": "neutral"}', {"sentiment_label": "neutral"}),
    ("mda", '{"sentiment_score": 0.9, "sentiment_label": "Neutral"}', {"sentiment_label": "positive"}),
    ("mda", '{"sentiment_score": -0.2}', {"sentiment_label": "negative"}),
    ("mda", '{"sentiment_score": 0.2}', {"sentiment_label": "positive"}),
    ("mda", '{"sentiment_score": -0.19}', {"sentiment_label": "neutral"}),
    ("mda", '{"sentiment_score": null, "management_tone": "evasive"}',
     {"sentiment_score": 0.0, "risk_level": "medium", "management_tone": None, "key_distress_signal": "",
      "llm_raw": "sentiment_score is not a number"}),
    ("mda", '{"sentiment_score": "abc"}', {"llm_raw": "sentiment_score is not a number"}),
    ("mda", '{"sentiment_score": [1]}', {"llm_raw": "sentiment_score is not a number"}),
    ("mda", "[1, 2]", {"llm_raw": "response is not a JSON object", "liquidity_signal": None}),
    ("mda", "null", {"llm_raw": "response is not a JSON object"}),
    ("mda", "3", {"llm_raw": "response is not a JSON object"}),
    ("mda", "no json", {"llm_raw": "no json", "sentiment_score": 0.0, "management_tone": "neutral",
                        "liquidity_signal": "adequate", "risk_level": "medium", "going_concern_explicit": 0,
                        "key_distress_signal": "none detected", "llm_summary": ""}),
    ("mda", 'Sure:\n{"sentiment_score": 0.3,\n "summary": "ok"} bye', {"sentiment_score": 0.3, "llm_summary": "ok"}),
    ("mda", '{"a": 1} and {"b": 2}', {"sentiment_score": 0.0, "llm_raw": '{"a": 1} and {"b": 2}'}),
    ("mda", '{"liquidity_signal": " Critical "}', {"liquidity_signal": "critical", "risk_level": "medium"}),
    ("mda", '{"liquidity_signal": "CRITICAL"}', {"liquidity_signal": "critical", "risk_level": "critical"}),
    ("mda", '{"liquidity_signal": "strong"}', {"risk_level": "low"}),
    ("mda", '{"going_concern_explicit": "YES", "cash_burn_mentioned": 2, "covenant_breach_mentioned": 1.5, '
            '"debt_restructuring_mentioned": "no"}',
     {"going_concern_explicit": 1, "cash_burn_mentioned": 1, "covenant_breach_mentioned": 0,
      "debt_restructuring_mentioned": 0}),
    ("mda", '{"going_concern_explicit": null, "cash_burn_mentioned": 0, "covenant_breach_mentioned": true}',
     {"going_concern_explicit": 0, "cash_burn_mentioned": 0, "covenant_breach_mentioned": 1}),
    ("mda", '{"key_distress_signal": null, "summary": false}', {"key_distress_signal": "None", "llm_summary": "False"}),
    ("risk", '{"risk_level": "HIGH", "severity_language": "sure", "top_risk_category": "legal"}',
     {"risk_level": "high", "severity_language": "possible", "top_risk_category": "legal", "management_tone": None}),
    ("business", '{"business_model_viability": "fragile"}',
     {"risk_level": "high", "competitive_position": "adequate", "key_vulnerability": "none identified"}),
    ("notes", '{"risk_level": "low", "management_tone": "evasive"}', {"risk_level": "low", "management_tone": None}),
    ("notes", '{"risk_level": "odd"}', {"risk_level": "medium"}),
]


@pytest.fixture(scope="module")
def answers(spark):
    df = spark.createDataFrame([(i, s, raw) for i, (s, raw, _) in enumerate(CASES)], "i INT, section STRING, raw STRING")
    return {row.i: row.asDict() for row in N.response_fields(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_response(answers, i):
    expected = CASES[i][2]
    assert {name: answers[i][name] for name in expected} == expected


def test_nothing_is_cut(spark):
    raw = json.dumps({"key_distress_signal": "a" * 999, "summary": "b" * 999})
    row = N.response_fields(spark.createDataFrame([("mda", raw)], "section STRING, raw STRING")).first()
    assert (len(row.key_distress_signal), len(row.llm_summary), row.llm_raw) == (999, 999, raw)


@pytest.fixture
def scorer():
    def answer(prompt):
        if "fail" in prompt:
            raise RuntimeError("server away " + "x" * 500)
        return '{"sentiment_score": -0.4, "risk_level": "high"}'

    return N.one_by_one(answer)


DOCUMENTS = [
    ("edgar_filings_text/ingestion_date=2024-01-01/CIK0000000007_a_risk.txt", "liquidity is thin"),
    ("edgar_filings_text/ingestion_date=2024-01-01/CIK0000000007_b_risk.txt", "this will fail"),
    ("edgar_filings_text/ingestion_date=2024-01-01/CIK0000000007_c_notes.txt", "unknown section"),
    ("edgar_filings_text/ingestion_date=2024-01-01/CIK0000000007_d_mda.txt", "   "),
]


def test_one_failed_call_stays_its_own(spark, scorer):
    documents = spark.createDataFrame(DOCUMENTS, "object_name STRING, text STRING")
    rows = {r.accession: r for r in build_text_features(documents, make_scorer=scorer).collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"].sentiment_score, rows["a"].risk_level, rows["a"].liquidity_risk) == (-0.4, "high", 1)
    assert rows["b"].llm_raw == "server away " + "x" * 500
    assert (rows["b"].risk_level, rows["b"].severity_language) == ("medium", None)


def test_skip_resume_and_upsert(spark, scorer):
    documents = spark.createDataFrame(DOCUMENTS, "object_name STRING, text STRING")
    skipped = build_text_features(documents)
    assert {r.llm_raw for r in skipped.collect()} == {"skipped"}
    assert build_text_features(documents, done=skipped, make_scorer=scorer).count() == 0
    redone = build_text_features(documents, done=skipped, make_scorer=scorer, redo_skipped=True)
    assert redone.count() == 2
    assert build_text_features(documents, done=skipped.limit(0), limit=1).first().accession == "a"
    merged = N.upsert_latest(skipped, redone)
    assert {r.accession: r.risk_level for r in merged.collect()} == {"a": "high", "b": "medium"}
    again = N.upsert_latest(merged, redone)
    assert sorted(again.drop("processed_at").collect()) == sorted(merged.drop("processed_at").collect())


def test_upsert_unites_columns(spark):
    old = spark.createDataFrame([("1", "a", "mda", 1), ("1", "b", "mda", 2)], "cik STRING, accession STRING, section STRING, x INT")
    new = spark.createDataFrame([("1", "b", "mda", "n")], "cik STRING, accession STRING, section STRING, y STRING")
    rows = sorted((r.accession, r.x, r.y) for r in N.upsert_latest(old, new).collect())
    assert rows == [("a", 1, None), ("b", None, "n")]


def test_scorer_is_called_once_per_row(spark, tmp_path):
    log, made = str(tmp_path / "calls"), str(tmp_path / "made")

    def make_scorer():
        with open(made, "a") as f:
            f.write("x")

        def answer(prompts):
            with open(log, "a") as f:
                f.write("x" * len(prompts))
            return ["{}"] * len(prompts)

        return answer

    df = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "i INT, prompt STRING")
    scored = N.score_documents(df.repartition(2), make_scorer, batch_size=3).select("i", F.col("response.raw"), F.col("response.error"))
    assert scored.filter("raw IS NOT NULL").count() == 20
    assert len(open(log).read()) == 20 and len(open(made).read()) == 2
