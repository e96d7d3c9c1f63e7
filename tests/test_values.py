import datetime
import re

from ledgerlight.functions import values as V


def test_strip_removes_all_unicode_whitespace(evaluate):
    texts = ["  x  ", "\t\n", "", None, "a b", "\x1c y\x1f"]
    assert evaluate(texts, V.strip) == [None if t is None else t.strip() for t in texts]


def test_numbers(evaluate):
    texts = ["12", " -3.5 ", "1e3", ".5", "7.", "1d", "0x1", "n/a", "", None, "1_0"]
    floats, ints = evaluate(texts, V.to_float, V.to_int)
    assert floats == [12.0, -3.5, 1000.0, 0.5, 7.0, None, None, None, None, None, None]
    assert ints[:4] == [12, -4, 1000, 1]
    assert evaluate(["2012.0", "2012.5"], V.to_int) == [2012, 2013]


def test_flags(evaluate):
    texts = [" Yes ", "Y", "TRUE", "1", "refiled", "no", "", None]
    assert evaluate(texts, V.yes_no) == [1, 1, 1, 1, 1, 0, 0, 0]
    assert evaluate(["prenegotiated", "yes"], lambda c: V.yes_no(c, ["prenegotiated"])) == [1, 0]


def test_dates(evaluate):
    texts = ["2024-02-29", "2023-02-29", "2024-1-5", "", "bad", None, "2024-01-05T00:00"]
    assert evaluate(texts, V.iso_date) == [datetime.date(2024, 2, 29), None, None, None, None, None, None]
    texts = ["3/7/2020", "12/31/1999", "2/30/2015", "2015-04-01", "", None, " 1/2/2003 "]
    assert evaluate(texts, V.us_date) == ["2020-03-07", "1999-12-31", "", "2015-04-01", "", "", "2003-01-02"]


def test_company_keys(evaluate):
    texts = ["42", "0000000042", "0", "000", "12345678901"]
    padded, bare, keys = evaluate(texts, V.pad_cik, V.bare_cik, V.cik_key)
    assert padded == [t.zfill(10) for t in texts]
    assert bare == ["42", "42", "0", "0", "12345678901"]
    assert keys == [42, 42, 0, 0, 12345678901]
    assert evaluate(["12345.0", "7", "x", None], V.cik_from_float) == ["0000012345", "0000000007", None, None]


def test_disposition_takes_the_first_rule(evaluate):
    texts = ["Plan Confirmed", "Converted to Chapter 7", "converted", " Dismissed ", "363 Sale", "PENDING", "?", None]
    expected = ["emerged", "liquidated", "converted", "dismissed", "363_sale", "pending", "other", "other"]
    assert evaluate(texts, V.map_disposition) == expected


def test_outcome_classes(evaluate):
    texts = [
        "Assets were LIQUIDATED after sale", "merger", "second time in bankruptcy", "second\nbankrupt",
        "second" + "x" * 10 + "bankrupt", "second" + "x" * 11 + "bankrupt", "second\rbankrupt",
        "still there", "   ", "", None, "no record",
    ]
    expected = [
        "liquidated", "acquired", "refiled", "unknown", "refiled", "unknown", "refiled",
        "survived", "unknown", "unknown", "unknown", "unknown",
    ]
    assert evaluate(texts, V.classify_outcome) == expected


def test_period_rank(evaluate):
    assert evaluate(["FY", "Q4", "Q3", "Q2", "Q1", "", "H1", None], V.period_rank) == [0, 1, 2, 3, 4, 9, 9, 9]


def test_clamp_keeps_null(evaluate):
    assert evaluate([-2.0, 0.5, 3.0, None], lambda c: V.clamp(V._col(c), -1.0, 1.0), kind="double") == [-1.0, 0.5, 1.0, None]


def test_number_pattern_is_plain():
    assert re.fullmatch(V.NUMERIC, "1.5e-3") and not re.fullmatch(V.NUMERIC, "1e")
