import re

from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions import text as X
from ledgerlight.operators import text_features as N
from ledgerlight.operators.filings import land_sections, recent_annual_filings, recent_annual_rows


def cleaned(raw):
    text = re.sub("<[^>]+>", " ", raw)
    for entity, plain in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = text.replace(entity, plain)
    return re.sub(r"\s{2,}", " ", text).strip()


def test_clean_html_follows_unicode_whitespace(evaluate):
    pages = [
        "<p>a</p><b>b</b>", "x &amp;lt; y &nbsp;&gt; z", "one\nline", "   wide 　 gap",
        "<unclosed", "", "a\x1c\x1db", "tab\there", "<a\nb>c",
    ]
    assert evaluate(pages, X.clean_html) == [cleaned(page) for page in pages]


def test_section_cut(evaluate):
    filler = "words " * 20
    texts = [
        f"Intro ITEM 7. Management and its Discussion {filler}Item 7A. Market {filler}",
        f"\U0001f600\U0001f600 Item 7 - none. item 7 MD&A {filler} item 8. Financial statements",
        f"Item 7. Management's discussion {filler}",
        "Item 7. Management's discussion item 7a too close",
        "nothing here",
        None,
        f"item 7. management's\ndiscussion {filler}",
    ]
    found = evaluate(texts, lambda c: X.extract_section(c, "mda"))
    assert found[0] == f"ITEM 7. Management and its Discussion {filler}".strip()
    assert found[1] == f"item 7 MD&A {filler}".strip()
    assert found[2] == f"Item 7. Management's discussion {filler}".strip()
    assert found[3] == "Item 7. Management's discussion item 7a too close"  # inside the heading's 50 characters
    assert found[4:6] == [None, None]
    assert found[6] is None  # the gap inside the heading may not hold a line break


def test_section_starts_at_the_first_listed_pattern(evaluate):
    pad = "y" * 60
    text = f"item 7 md&a early {pad} item 7. management discussion late {pad}"
    assert evaluate([text], lambda c: X.extract_section(c, "mda"))[0].startswith("item 7. management discussion")


def test_end_is_the_first_listed_pattern(evaluate):
    pad = "z" * 60
    text = f"item 1a. risk factors {pad} item 2. {pad} item 1b. end"
    assert evaluate([text], lambda c: X.extract_section(c, "risk"))[0].endswith(pad)
    assert "item 2." in evaluate([text], lambda c: X.extract_section(c, "risk"))[0]


def test_truncate_utf8(evaluate):
    texts = ["abcdef", "äöü", "a€b", "\U0001f600x", "", None]
    for size in (1, 2, 3, 4, 6):
        expected = [None if t is None else t.encode()[:size].decode("utf-8", errors="replace") for t in texts]
        assert evaluate(texts, lambda c: X.truncate_utf8(c, size)) == expected


def test_decode_text_replaces_broken_bytes(spark):
    row = spark.range(1).select(X.decode_text(F.unhex(F.lit("61ff62c3"))).alias("t")).first()
    assert row.t == b"a\xffb\xc3".decode("utf-8", errors="replace")


def test_vocabulary_counts_terms_not_occurrences(spark):
    text = "Default, default. A Going Concern note; tariffs; wind-down."
    row = N.keyword_features(spark.createDataFrame([(text,)], "text STRING")).first()
    lower = text.lower()
    assert row.distress_keywords == sum(term in lower for term in K.DISTRESS_TERMS) == 3
    assert (row.going_concern, row.liquidity_risk, row.restructuring) == (1, 0, 1)


def test_object_names(spark):
    names = [
        "edgar_filings_text/ingestion_date=2024-01-01/CIK0000012345_000111_mda.txt",
        "CIK0000000000_x.txt", "plain", "a/ICK7__.txt",
    ]
    df = spark.createDataFrame([(n,) for n in names], "object_name STRING")
    rows = [(r.cik, r.accession, r.section, r.ingestion_date) for r in N.parse_object_name(df).collect()]
    assert rows == [
        ("12345", "000111", "mda", "2024-01-01"), ("0", "x", "", ""), ("plain", "", "", ""), ("7", "", "", ""),
    ]


def test_prompts_hold_whole_texts(spark):
    df = spark.createDataFrame([("mda", 'say "x"' + "y" * 5000), ("notes", "z" * 5000)], "section STRING, text STRING")
    templates = {"mda": ("[", "]"), "other": ("(", ")")}
    prompts = [r.prompt for r in N.build_prompt(df, templates).collect()]
    assert prompts == ["[" + "say 'x'" + "y" * 5000 + "]", "(" + "z" * 5000 + ")"]
    parts = N.build_prompt(df.unionAll(spark.createDataFrame([("mda", "")], df.schema)), templates, chunk_chars=4000)
    rows = [(r.section, r.chunk, r.prompt) for r in parts.collect()]
    assert rows == [
        ("mda", 0, "[say 'x'" + "y" * 3993 + "]"), ("mda", 1, "[" + "y" * 1007 + "]"), ("notes", 0, "(" + "z" * 4000 + ")"),
        ("notes", 1, "(" + "z" * 1000 + ")"), ("mda", 0, "[]"),
    ]
    default = N.build_prompt(df).collect()
    assert all(name in default[0].prompt for name in ("liquidity_signal", "covenant_breach_mentioned"))


def test_recent_annual_filings_keep_list_order(spark):
    raw = """{"cik": "9", "filings": {"recent": {"form": ["10-K/A", "20-F", "10-K", "40-F", "10-K"],
      "accessionNumber": ["0-1", "0-2", "0-3", "0-4", "0-5"], "filingDate": ["d1", "d2", "d3", "d4"],
      "primaryDocument": ["p1", "p2", "p3", "p4", "p5"]}}}"""
    rows = recent_annual_filings(spark.createDataFrame([(raw,), ("{}",), ("broken",)], "raw STRING"), 4).collect()
    assert [(r.form, r.accession) for r in rows] == [("20-F", "02"), ("10-K", "03"), ("40-F", "04")]


def test_recent_annual_rows_limit_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr(
        "id DIV 5000 AS cik", "'10-K' AS form", "CAST(id AS STRING) AS accession", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS filing_date"
    )
    result = recent_annual_rows(df)
    assert sorted(r.accession for r in result.collect()) == ["997", "998", "999"]
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 3, Final") < plan.index("Exchange") < plan.index("row_number(), 3, Partial")


def test_landing_outcomes(spark):
    pad = "w" * 60
    text = f"Item 1. Business {pad} Item 1A. Risk Factors é{pad} Item 1B."
    documents = spark.createDataFrame(
        [(1, "a", text), (2, None, None), (3, "c", None), (4, "d", "")], "cik INT, accession STRING, text STRING"
    )
    landed = spark.createDataFrame(
        [("edgar_filings_text/ingestion_date=D/CIK0000000001_a_business.txt",)], "object_name STRING"
    )
    rows = {(r.cik, r.section): r for r in land_sections(documents, landed, "D").collect()}
    assert {k: r.status for k, r in rows.items()} == {
        (1, "mda"): "section_not_found", (1, "risk"): "ok", (1, "business"): "already_exists",
        (2, None): "no_filings", (3, None): "fetch_failed", (4, None): "fetch_failed",
    }
    stored = rows[1, "risk"]
    assert stored.bytes == len(stored.section_text.encode()) == len(stored.section_text) + 1
    trial = {(r.cik, r.section): r for r in land_sections(documents, landed, "D", dry_run=True).collect()}
    assert trial[1, "business"].status == "dry_run" and trial[1, "risk"].bytes == len(stored.section_text)
    assert all(r.section_text is None for r in trial.values())
    short = land_sections(documents, landed, "D", max_bytes=30).filter("status = 'ok'").first()
    assert short.bytes <= 32
