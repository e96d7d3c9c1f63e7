"""Filing text: cleaning, cutting sections, object names, vocabulary counts. All inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions.values import _col, bare_cik, pad_cik, strip


def decode_text(content: Column | str) -> Column:
    """UTF-8 bytes to text; broken bytes become U+FFFD."""
    return F.make_valid_utf8(_col(content).cast("string"))


def clean_html(raw: Column | str) -> Column:
    """Drop tags, resolve the four common entities in a fixed order, fold whitespace runs, strip.

    ``&amp;`` is resolved before ``&lt;``, so ``&amp;lt;`` ends as ``<``. A single newline or tab is kept.
    """
    text = F.regexp_replace(_col(raw), "<[^>]+>", " ")
    for entity, plain in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return strip(F.regexp_replace(text, f"[{K.WS}]{{2,}}", " "))


def truncate_utf8(text: Column | str, max_bytes: int) -> Column:
    """At most ``max_bytes`` bytes; a character cut in two becomes U+FFFD."""
    text = _col(text)
    head = F.substring(text.cast("binary"), 1, max_bytes)
    return F.when(F.octet_length(text) > max_bytes, decode_text(head)).otherwise(text)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed one time, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), 0)


def _from_match(text: Column, pattern: str) -> Column:
    """The text from the first match on, or null."""
    return F.nullif(F.regexp_extract(text, f"(?s){pattern}.*", 0), F.lit(""))


def _before_match(text: Column, pattern: str) -> Column:
    """The text up to the first match, or null."""
    return once(F.split(text, pattern, 2), lambda parts: F.when(F.size(parts) == 2, F.get(parts, 0)))


def extract_section(text: Column | str, section: str, max_bytes: int | None = None) -> Column:
    """One section of a cleaned filing, or null when its heading is not found.

    The start is the first start pattern of the list that occurs at all, at its first place. The end is the
    first end pattern that occurs past the heading, else the end of the text. The cut works on matched text
    rather than on positions: Java counts UTF-16 units where SQL counts characters.
    """
    text = _col(text)
    tail = F.coalesce(*[_from_match(text, f"(?i){pattern}") for pattern in K.SECTION_STARTS[section]])

    def body(rest: Column) -> Column:
        return F.coalesce(*[_before_match(rest, f"(?i){end}") for end in K.SECTION_ENDS[section]], rest)

    def cut(found: Column) -> Column:
        heading = F.substring(found, 1, K.SECTION_HEADING_CHARS)
        rest = F.substr(found, F.lit(K.SECTION_HEADING_CHARS + 1))
        return strip(F.concat(heading, once(rest, body)))

    section_text = once(tail, cut)
    return section_text if max_bytes is None else once(section_text, lambda t: truncate_utf8(t, max_bytes))


def count_terms(text: Column | str, terms: list[str]) -> Column:
    """How many of ``terms`` occur in the text as substrings; repeats of one term count once."""
    lower = F.lower(_col(text))
    return reduce(Column.__add__, [lower.contains(term).cast("int") for term in terms])


def any_term(text: Column | str, terms: list[str]) -> Column:
    lower = F.lower(_col(text))
    return reduce(Column.__or__, [lower.contains(term) for term in terms]).cast("int")


def object_key(cik: Column | str, accession: Column | str, section: Column | str, date: Column | str) -> Column:
    """``edgar_filings_text/ingestion_date=<date>/CIK<10 digits>_<accession>_<section>.txt``"""
    return F.concat(
        F.lit("edgar_filings_text/ingestion_date="), _col(date), F.lit("/CIK"), pad_cik(cik),
        F.lit("_"), _col(accession), F.lit("_"), _col(section), F.lit(".txt"),
    )


def facts_key(cik: Column | str, date: Column | str, dataset: str = "edgar_company_facts") -> Column:
    return F.concat(
        F.lit(f"{dataset}/ingestion_date="), _col(date), F.lit("/CIK"), _col(cik), F.lit(".json")
    )


def document_path(cik: Column | str, accession: Column | str, primary_document: Column | str) -> Column:
    """Path of a filing's main document below the archive root."""
    return F.concat(
        F.lit("edgar/data/"), _col(cik).cast("bigint").cast("string"), F.lit("/"),
        F.replace(_col(accession), F.lit("-"), F.lit("")), F.lit("/"), _col(primary_document),
    )


def object_name_parts(name: Column | str) -> dict[str, Column]:
    """cik, accession, section and ingestion date out of a section object's name; absent parts are empty."""
    name = _col(name)
    base = F.replace(F.substring_index(name, "/", -1), F.lit(".txt"), F.lit(""))
    parts = F.split(base, "_")

    def part(i: int) -> Column:
        return F.coalesce(F.get(parts, i), F.lit(""))

    return {
        "cik": bare_cik(F.ltrim(part(0), F.lit("CIK"))),
        "accession": part(1),
        "section": part(2),
        "ingestion_date": F.regexp_extract(name, r"ingestion_date=([0-9]{4}-[0-9]{2}-[0-9]{2})", 1),
    }
