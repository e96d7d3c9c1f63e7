"""Raw fact documents to long fact rows.

A document holds all facts of one company at one landing date. Choosing among alias tags is a decision
inside one document, so `flatten_facts` takes it with array functions before exploding: no shuffle, whatever
the number of documents or the share of one company. `resolve_tag_aliases` is the same rule for facts that
are already rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions.values import _col, fact_number, iso_date

CORRUPT = "_corrupt_record"
# Scalars are read as text: a number of an unexpected type must not make the parser drop the document.
HEAD = ("cik", "entityName")
ENTRY = ("end", "val", "fp", "form", "filed")
RENAMED = {"end": "end_str", "filed": "filed_str"}


def _concept(entry: tuple[str, ...] = ENTRY) -> str:
    return "STRUCT<units: STRUCT<USD: ARRAY<STRUCT<" + ", ".join(f"`{name}`: STRING" for name in entry) + ">>>>"


def _document_schema(tags: list[str] | None, head: tuple[str, ...] = HEAD, entry: tuple[str, ...] = ENTRY) -> str:
    """Schema of a document. With ``tags`` only those are decoded, the parser skips all others."""
    if tags is None:
        concepts = f"MAP<STRING, {_concept(entry)}>"
    else:
        concepts = "STRUCT<" + ", ".join(f"`{tag}`: {_concept(entry)}" for tag in tags) + ">"
    fields = [*(f"{name} STRING" for name in head), f"facts STRUCT<`ifrs-full`: {concepts}, `us-gaap`: {concepts}>", f"{CORRUPT} STRING"]
    return ", ".join(fields)


def _parse(blobs: DataFrame, tags: list[str] | None, raw: str, head: tuple[str, ...] = HEAD, entry: tuple[str, ...] = ENTRY) -> DataFrame:
    options = {"columnNameOfCorruptRecord": CORRUPT}
    return blobs.withColumn("_doc", F.from_json(F.col(raw), _document_schema(tags, head, entry), options))


def rejected_documents(blobs: DataFrame, raw: str = "raw") -> DataFrame:
    """Documents that are not valid JSON of the expected shape; flattening skips them."""
    parsed = _parse(blobs, None, raw)
    return parsed.filter(F.col(f"_doc.{CORRUPT}").isNotNull()).drop("_doc")


def documents_with_bad_values(blobs: DataFrame, raw: str = "raw") -> DataFrame:
    """Documents with a value that is neither a number nor a boolean; flattening skips these values, and the documents are
    listed so that somebody can look at them."""
    keep = [c for c in blobs.columns if c != raw]
    entries = explode_facts(blobs, raw, ("val",))
    return entries.filter(F.col("val").isNotNull() & fact_number("val").isNull()).select(*keep).distinct()


def has_form(form: Column | str, prefixes: tuple[str, ...] = K.FORM_PREFIXES) -> Column:
    """The form starts with one of the prefixes, so amendments such as ``10-K/A`` count."""
    return reduce(Column.__or__, [_col(form).startswith(prefix) for prefix in prefixes])


def filter_forms(df: DataFrame, prefixes: tuple[str, ...] = K.FORM_PREFIXES, form: str = "form") -> DataFrame:
    return df.filter(has_form(form, prefixes))


def merge_namespaces(ifrs: Column | str, gaap: Column | str, entry: tuple[str, ...] = ENTRY) -> Column:
    """Union of two tag maps; where both have a tag the us-gaap concept replaces the other one whole."""
    ifrs, gaap = _col(ifrs), _col(gaap)
    empty = F.map_from_arrays(F.array(), F.array()).cast(f"MAP<STRING, {_concept(entry)}>")
    return F.map_zip_with(F.coalesce(ifrs, empty), F.coalesce(gaap, empty), lambda tag, a, b: F.coalesce(b, a))


def explode_facts(blobs: DataFrame, raw: str = "raw", fields: tuple[str, ...] = (*HEAD, *ENTRY)) -> DataFrame:
    """One row per document, tag and US-dollar entry, every tag of the document, values still as text.

    Only the ``fields`` of documents and entries that are named are decoded and returned; Spark does not see by itself that
    the parser could leave out what nobody reads. At least one is a field of the entries.
    """
    keep = [c for c in blobs.columns if c != raw]
    head, entry = (tuple(name for name in known if name in fields) for known in (HEAD, ENTRY))
    parsed = _parse(blobs, None, raw, head, entry)
    merged = merge_namespaces("_doc.facts.`ifrs-full`", "_doc.facts.`us-gaap`", entry)
    sound = F.when(F.col(f"_doc.{CORRUPT}").isNull(), merged)
    tags = parsed.select(*keep, *(F.col(f"_doc.{name}") for name in head), F.explode(sound).alias("tag", "concept"))
    return tags.select(*keep, *head, "tag", F.inline("concept.units.USD")).withColumnsRenamed(RENAMED)


def usable(entry: Column) -> Column:
    """An entry counts when its form is relevant, its end is a date and it has a value."""
    return has_form(entry["form"]) & iso_date(entry["end"]).isNotNull() & fact_number(entry["val"]).isNotNull()


def flatten_facts(
    blobs: DataFrame, aliases: dict[str, list[str]] = K.TAG_ALIASES, raw: str = "raw"
) -> DataFrame:
    """Documents to fact rows, all in one narrow stage.

    Per field the first alias tag, in priority order, that has at least one usable entry supplies all rows
    of the document; the other aliases are ignored for every period.
    """
    tags = [tag for names in aliases.values() for tag in names]
    parsed = _parse(blobs, tags, raw)

    def entries(tag: str) -> Column:
        concept = F.coalesce(F.col(f"_doc.facts.`us-gaap`.`{tag}`"), F.col(f"_doc.facts.`ifrs-full`.`{tag}`"))
        return concept["units"]["USD"]

    def chosen(names: list[str]) -> Column:
        if len(names) == 1:
            return entries(names[0])
        # `exists` stops at the first usable entry; all others are judged after the explode, in generated code
        return F.coalesce(*[F.when(F.exists(entries(tag), usable), entries(tag)) for tag in names])

    per_field = F.array(*[
        F.struct(F.lit(name).alias("field"), chosen(names).alias("entries")) for name, names in aliases.items()
    ])
    # A broken document has no fields. A filter would say the same, but would parse every document twice.
    sound = F.when(F.col(f"_doc.{CORRUPT}").isNull(), per_field)
    fields = parsed.select(F.col("_doc.cik"), F.col("_doc.entityName").alias("company_name"), F.inline(sound))
    rows = fields.select("cik", "company_name", "field", F.explode("entries").alias("e"))
    return coerce_fact_row(rows.select("cik", "company_name", "field", "e.*").filter(has_form("form")))


def resolve_tag_aliases(
    df: DataFrame, aliases: dict[str, list[str]] = K.TAG_ALIASES, document: tuple[str, ...] = ("file_key",)
) -> DataFrame:
    """Alias rule for usable facts in row form: keep the rows of the best tag per document and field.

    The best priority is a map-side combined minimum, at most one small row per document and field reaches
    the shuffle; joining it back leaves a very large document to the skew-join split of adaptive execution.
    A window over the document would pull all its rows into one task instead.
    """
    lookup = {
        tag: (field, priority) for field, tags in aliases.items() for priority, tag in enumerate(tags)
    }
    pairs = F.create_map(*[
        part for tag, (field, priority) in lookup.items()
        for part in (F.lit(tag), F.struct(F.lit(field).alias("field"), F.lit(priority).alias("priority")))
    ])
    known = (
        df.withColumn("_alias", F.try_element_at(pairs, F.col("tag")))
        .filter(F.col("_alias").isNotNull())
        .select("*", "_alias.field", F.col("_alias.priority").alias("_priority"))
        .drop("_alias")
    )
    keys = [*document, "field"]
    best = known.groupBy(*keys).agg(F.min("_priority").alias("_priority"))
    return known.join(best, [*keys, "_priority"]).drop("_priority")


def coerce_fact_row(df: DataFrame) -> DataFrame:
    """Typed fact rows from text entries.

    The fiscal year is the year of the period end, not the filing's own. A missing company key is 0, a
    missing name ``Unknown``, a missing period empty, a bad filing date null; rows without a period end or
    a value are dropped.
    """
    period_end = iso_date("end")
    return df.select(
        F.coalesce(F.col("cik").try_cast("bigint"), F.lit(0).cast("bigint")).alias("cik"),
        F.coalesce("company_name", F.lit("Unknown")).alias("company_name"),
        period_end.alias("period_end"),
        F.year(period_end).alias("fiscal_year"),
        F.coalesce("fp", F.lit("")).alias("fiscal_period"),
        F.col("form").alias("form_type"),
        iso_date("filed").alias("filed_date"),
        "field",
        fact_number("val").alias("value"),
    ).filter(F.col("period_end").isNotNull() & F.col("value").isNotNull())


def cast_dates(df: DataFrame, columns: tuple[str, ...] = ("period_end", "filed_date")) -> DataFrame:
    return df.withColumns({name: iso_date(F.col(name).cast("string")) for name in columns})
