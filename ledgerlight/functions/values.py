"""Cleaning of single values: blanks, numbers, flags, dates and company keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlight import constants as K

NUMERIC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace (`trim` alone removes spaces only)."""
    return F.btrim(_col(c), F.lit(K.WHITESPACE))


def blank_if_null(c: Column | str) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def to_float(c: Column | str) -> Column:
    """A number, or null. The pattern keeps out Java-only spellings such as ``1d``."""
    text = strip(_col(c).cast("string"))
    return F.when(text.rlike(NUMERIC), text.try_cast("double"))


def fact_number(c: Column | str) -> Column:
    """The number of a fact: a JSON number, or a boolean as 1 and 0; null for anything else."""
    text = _col(c)
    return F.coalesce(to_float(text), F.when(text == "true", 1.0).when(text == "false", 0.0))


def to_int(c: Column | str) -> Column:
    """A whole number, or null; ``2012.0`` is 2012."""
    return F.round(to_float(c)).try_cast("int")


def yes_no(c: Column | str, true_values: list[str] = K.DEFAULT_TRUE) -> Column:
    """1 when the value is one of ``true_values`` in any case, else 0."""
    return F.coalesce(F.lower(strip(_col(c).cast("string"))).isin(true_values), F.lit(False)).cast("int")


def iso_date(c: Column | str) -> Column:
    """A DATE from ``YYYY-MM-DD``, else null."""
    return F.try_to_date(_col(c), "yyyy-MM-dd")


def us_date(c: Column | str) -> Column:
    """``YYYY-MM-DD`` text from a month-first, ISO or named-month date, with or without a time; else an empty string.

    Years of two digits are 1970 to 2069.
    """
    text = F.regexp_replace(strip(c), r"[T ]+[0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?( ?[AaPp][Mm])?$", "")
    text = F.regexp_replace(text, r"^([0-9]{1,2})[-./]([0-9]{1,2})[-./]([0-9]{4}|[0-9]{2})$", r"$1/$2/$3")
    short = F.regexp_replace(text, r"/([0-9]{2})$", r"/20$1")
    century = F.when(F.regexp_extract(text, r"/([0-9]{2})$", 1).try_cast("int") >= 70, F.regexp_replace(text, r"/([0-9]{2})$", r"/19$1"))
    named = F.initcap(F.regexp_replace(F.regexp_replace(text, r"[.,]", " "), r"\s+", " "))
    parsed = F.coalesce(
        F.try_to_date(F.coalesce(century, short), "M/d/yyyy"), F.try_to_date(text, "yyyy-M-d"), F.try_to_date(text, "yyyy/M/d"),
        F.try_to_date(named, "MMM d yyyy"), F.try_to_date(named, "MMMM d yyyy"), F.try_to_date(named, "d MMM yyyy"),
        F.try_to_date(named, "d MMMM yyyy"),
    )
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.lit(""))


def clamp(c: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null although greatest and least skip nulls."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def pad_cik(c: Column | str) -> Column:
    """Ten digits with leading zeros; longer keys are left alone (`lpad` alone would cut them)."""
    text = _col(c).cast("string")
    return F.when(F.length(text) < 10, F.lpad(text, 10, "0")).otherwise(text)


def bare_cik(c: Column | str) -> Column:
    """The key without leading zeros; a key of zeros only is ``0``."""
    stripped = F.ltrim(_col(c).cast("string"), F.lit("0"))
    return F.when(stripped == "", F.lit("0")).otherwise(stripped)


def cik_key(c: Column | str) -> Column:
    """The one key type used for joins inside the engine."""
    return _col(c).cast("string").try_cast("bigint")


def cik_from_float(c: Column | str) -> Column:
    """``12345.0`` -> ``0000012345``."""
    return pad_cik(to_float(c).try_cast("bigint"))


def first_match(default: Column, rules: list[tuple[Column, Column]]) -> Column:
    """The value of the first rule whose condition holds."""
    return reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), reversed(rules), default)


def map_disposition(c: Column | str) -> Column:
    text = F.lower(_col(c).cast("string"))
    rules = [
        (reduce(Column.__or__, [text.contains(word) for word in words]), F.lit(label))
        for label, words in K.DISPOSITIONS
    ]
    return first_match(F.lit(K.OTHER_DISPOSITION), rules)


def classify_outcome(c: Column | str) -> Column:
    """Outcome class of a free text: first pattern that occurs anywhere wins, no text is ``unknown``."""
    text = F.lower(_col(c))
    rules = [(text.rlike(pattern), F.lit(label)) for label, pattern in K.OUTCOME_PATTERNS]
    return first_match(F.lit("unknown"), rules)


def period_rank(c: Column | str) -> Column:
    """Annual before Q4 before ... before Q1; anything else last."""
    rules = [(_col(c) == period, F.lit(rank)) for period, rank in K.PERIOD_RANK.items()]
    return first_match(F.lit(K.UNRANKED_PERIOD), rules)


def group_name(label: Column | str, names: dict[int, str] = K.GROUP_NAMES) -> Column:
    return F.when(_col(label) == 1, names[1]).otherwise(names[0])
