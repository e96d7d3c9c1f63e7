"""Reading a scorer's free-form answer: JSON recovery and typed fields on VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions.values import _col, clamp, first_match, strip, to_float


def recover_json(raw: Column | str) -> Column:
    """The answer as VARIANT: the whole text, else the widest ``{...}`` in it, else an empty object.

    A whole text that is valid JSON but not an object (a list, a number, ``null``) comes back as such.
    """
    raw = _col(raw)
    inner = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    return F.coalesce(F.try_parse_json(raw), F.try_parse_json(inner), F.parse_json(F.lit("{}")))


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def field_text(value: Column, name: str) -> Column:
    """Scalar field as text; null when absent or JSON null."""
    return F.try_variant_get(value, f"$.{name}", "string")


def kind(value: Column, name: str) -> Column:
    """Type name of a field (BOOLEAN, BIGINT, STRING, VOID, ...); null when absent."""
    return F.schema_of_variant(field(value, name))


def safe_bool(value: Column, name: str) -> Column:
    """0/1: booleans as they are, whole numbers by being non-zero, ``true``/``yes``/``1`` as text, else 0."""
    type_name, text = kind(value, name), field_text(value, name)
    truthy = first_match(
        F.lit(False),
        [
            (type_name == "BOOLEAN", text == "true"),
            (type_name == "BIGINT", text != "0"),
            (type_name == "STRING", F.lower(text).isin("true", "yes", "1")),
        ],
    )
    return F.coalesce(truthy, F.lit(False)).cast("int")


def safe_enum(value: Column, name: str, choices: list[str], default: str) -> Column:
    text = strip(F.lower(field_text(value, name)))
    return F.when(text.isin(choices), text).otherwise(default)


def spoken(value: Column, name: str, default: str) -> Column:
    """A field as display text: absent gives the default, JSON null ``None``, booleans ``True``/``False``."""
    type_name, text = kind(value, name), field_text(value, name)
    return first_match(
        text,
        [
            (type_name.isNull(), F.lit(default)),
            (type_name == "VOID", F.lit("None")),
            (type_name == "BOOLEAN", F.initcap(text)),
        ],
    )


def raw_score(value: Column) -> Column:
    """The sentiment number as given: 0 when absent, null when it is not a number."""
    type_name, text = kind(value, "sentiment_score"), field_text(value, "sentiment_score")
    return first_match(
        to_float(text),
        [
            (type_name.isNull(), F.lit(0.0)),
            (type_name == "BOOLEAN", (text == "true").cast("double")),
            (type_name.rlike("^(ARRAY|OBJECT)"), F.lit(None).cast("double")),
        ],
    )


def sentiment_label(value: Column, score: Column) -> Column:
    given = field_text(value, "sentiment_label")
    return first_match(
        F.lit("neutral"),
        [
            (given.isin(K.SENTIMENT_LABELS), given),
            (score <= K.SENTIMENT_NEGATIVE_UP_TO, F.lit("negative")),
            (score >= K.SENTIMENT_POSITIVE_FROM, F.lit("positive")),
        ],
    )


def derived_risk(value: Column, section: str) -> Column:
    """Risk level implied by another field; unlike the enums the text is not stripped first."""
    name, levels = K.DERIVED_RISK[section]
    text = F.lower(field_text(value, name))
    return first_match(F.lit("medium"), [(text == word, F.lit(level)) for word, level in levels.items()])


def shared_fields(value: Column) -> dict[str, Column]:
    """Fields every section has."""
    score = clamp(raw_score(value), -1.0, 1.0)
    return {
        "sentiment_score": score,
        "sentiment_label": sentiment_label(value, score),
        "key_distress_signal": spoken(value, "key_distress_signal", "none detected"),
        "llm_summary": spoken(value, "summary", ""),
    }


def section_fields(value: Column, section: str) -> dict[str, Column]:
    """Fields of one section; a section outside the three known ones has a risk level only."""
    if section not in K.SECTIONS:
        return {"risk_level": safe_enum(value, "risk_level", K.RISK_LEVELS, "medium")}
    fields = {
        name: safe_enum(value, name, choices, default)
        for name, (choices, default) in K.RESPONSE_ENUMS[section].items()
    }
    fields.update({name: safe_bool(value, name) for name in K.RESPONSE_FLAGS[section]})
    if section in K.DERIVED_RISK:
        fields["risk_level"] = derived_risk(value, section)
    if section == "business":
        fields["key_vulnerability"] = spoken(value, "key_vulnerability", "none identified")
    return fields
