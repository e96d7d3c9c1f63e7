"""Filing lists, filing text and what becomes of each section when it is landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions.text import clean_html, extract_section, object_key
from ledgerlight.functions.values import first_match

SUBMISSIONS_SCHEMA = (
    "cik STRING, filings STRUCT<recent: STRUCT<form: ARRAY<STRING>, accessionNumber: ARRAY<STRING>, "
    "filingDate: ARRAY<STRING>, primaryDocument: ARRAY<STRING>>>"
)
LISTS = {
    "form": "form", "accessionNumber": "accession_dashed", "filingDate": "filing_date",
    "primaryDocument": "primary_document",
}


def submission_lists(blobs: DataFrame, raw: str = "raw") -> DataFrame:
    """The parallel lists of a submissions document as one list of filings per document.

    Lists of unequal length are cut to the shortest one.
    """
    doc = F.from_json(F.col(raw), SUBMISSIONS_SCHEMA)
    keep = [c for c in blobs.columns if c != raw]
    parsed = blobs.select(*keep, doc.alias("_d")).select(*keep, "_d.cik", "_d.filings.recent.*")
    length = F.least(*[F.size(name) for name in LISTS])
    zipped = F.arrays_zip(*[F.col(name).alias(alias) for name, alias in LISTS.items()])
    return parsed.select(*keep, "cik", F.slice(zipped, F.lit(1), length).alias("filings"))


def read_submission_rows(blobs: DataFrame, raw: str = "raw") -> DataFrame:
    """One row per filing."""
    lists = submission_lists(blobs, raw)
    keep = [c for c in lists.columns if c != "filings"]
    return lists.select(*keep, F.inline("filings"))


def recent_annual_filings(
    blobs: DataFrame, n: int = 3, forms: tuple[str, ...] = K.ANNUAL_FORMS, raw: str = "raw"
) -> DataFrame:
    """The first ``n`` annual filings of each submissions document in list order; amendments do not count."""
    lists = submission_lists(blobs, raw)
    keep = [c for c in lists.columns if c != "filings"]
    annual = F.slice(F.filter("filings", lambda f: f["form"].isin(*forms)), 1, n)
    rows = lists.select(*keep, F.inline(annual))
    return rows.withColumn("accession", F.replace("accession_dashed", F.lit("-"), F.lit("")))


def recent_annual_rows(
    filings: DataFrame, n: int = 3, forms: tuple[str, ...] = K.ANNUAL_FORMS
) -> DataFrame:
    """The same choice for filings that are rows already, latest filing date first.

    Each task keeps at most ``n`` rows per company before the shuffle (WindowGroupLimit).
    """
    newest = Window.partitionBy("cik").orderBy(F.desc("filing_date"), F.asc("accession"))
    annual = filings.filter(F.col("form").isin(*forms))
    return annual.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= n)


def document_text(documents: DataFrame, body: str = "body", is_html: str = "is_html") -> DataFrame:
    """Cleaned text of a downloaded document; plain text is taken as it is, and whole."""
    return documents.withColumn(
        "text", F.when(F.col(is_html), clean_html(body)).otherwise(F.col(body))
    )


def sections_of(
    documents: DataFrame, max_bytes: int | None = None, text: str = "text", skip: Column | None = None
) -> DataFrame:
    """One row per document and known section; ``section_text`` is null where the section is not found, or where it is
    among the names in ``skip``."""

    def body(name: str) -> Column:
        found = extract_section(text, name, max_bytes)
        return found if skip is None else F.when(~F.array_contains(skip, name), found)

    found = F.array(*[F.struct(F.lit(name).alias("section"), body(name).alias("section_text")) for name in K.SECTIONS])
    return documents.select(*[c for c in documents.columns if c != text], F.inline(found))


def only_new(candidates: DataFrame, landed: DataFrame, key: str = "object_name") -> DataFrame:
    """The keys among the candidates that are not landed yet, each once; contents are no part of this choice."""
    return candidates.select(key).distinct().join(landed.select(key), key, "left_anti")


def landed_sections(documents: DataFrame, landed: DataFrame, date: str) -> DataFrame:
    """cik, accession and the known sections of it that are landed already. Names alone are compared."""
    keys = documents.select("cik", "accession").where("accession IS NOT NULL").distinct()
    named = keys.withColumn("section", F.explode(F.array(*map(F.lit, K.SECTIONS))))
    named = named.withColumn("object_name", object_key("cik", "accession", "section", F.lit(date)))
    seen = named.join(landed.select("object_name"), "object_name", "left_semi")
    return seen.groupBy("cik", "accession").agg(F.collect_set("section").alias("_landed_sections"))


def land_sections(
    documents: DataFrame,
    landed: DataFrame,
    date: str,
    max_bytes: int | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """What happens to each section of each downloaded filing, and the text to store where it is new.

    ``documents`` has cik, accession and text, null where there is no filing (null accession) or the
    download failed (null text). ``landed`` has the object names stored before; they are matched with names, and
    sections that are landed are not cut out. A dry run looks at no stored object and sizes sections in
    characters, as nothing is encoded.
    """
    readable = documents.withColumn("_readable", F.coalesce(F.length("text") > 0, F.lit(False)))
    none = F.array().cast("array<string>")
    if dry_run:
        known = readable.withColumn("_landed_sections", none)
    else:
        seen = landed_sections(documents, landed, date)
        known = readable.join(seen, ["cik", "accession"], "left")
        known = known.withColumn("_landed_sections", F.coalesce("_landed_sections", none))
    located = sections_of(known, max_bytes, skip=F.col("_landed_sections"))
    keyed = located.withColumns({
        "object_name": object_key("cik", "accession", "section", F.lit(date)),
        "_landed": F.array_contains("_landed_sections", F.col("section")),
    })
    return ingest_status(keyed, dry_run)


def ingest_status(sections: DataFrame, dry_run: bool = False) -> DataFrame:
    """Outcome per section; a filing that could not be read has one outcome instead of one per section."""
    stored = F.lit("dry_run") if dry_run else F.lit("ok")
    text = F.col("section_text")
    status = first_match(
        stored,
        [
            (F.col("accession").isNull(), F.lit("no_filings")),
            (~F.col("_readable"), F.lit("fetch_failed")),
            (F.col("_landed"), F.lit("already_exists")),
            (text.isNull(), F.lit("section_not_found")),
        ],
    )
    size = F.length(text) if dry_run else F.octet_length(text)
    judged = sections.withColumn("status", status)
    whole = F.col("status").isin("no_filings", "fetch_failed")
    kept = F.col("status").isin("ok", "dry_run")
    return judged.filter(~whole | (F.col("section") == K.SECTIONS[0])).select(
        "cik",
        "accession",
        F.when(~whole, F.col("section")).alias("section"),
        F.when(~whole, F.col("object_name")).alias("object_name"),
        "status",
        F.when(kept, size).when(~whole, F.lit(0)).alias("bytes"),
        F.when(F.col("status") == "ok", text).alias("section_text"),
    )


def facts_ingest_status(companies: DataFrame, fetched: DataFrame, landed: DataFrame) -> DataFrame:
    """Outcome per company of landing its facts document.

    ``companies`` has cik and object_name; ``fetched`` has object_name, size and an error text, with a null
    size where the download gave nothing; a company that was not tried is not in it.
    """
    tried = fetched.select("object_name", "size", "error").withColumn("_tried", F.lit(True))
    seen = landed.select("object_name").distinct().withColumn("_seen", F.lit(True))
    status = first_match(
        F.lit("ok"),
        [
            (F.col("_seen").isNotNull(), F.lit("already_exists")),
            (F.col("_tried").isNull(), F.lit("skipped")),
            (F.col("error").isNotNull(), F.lit("error")),
            (F.col("size").isNull(), F.lit("failed")),
        ],
    )
    joined = companies.join(tried, "object_name", "left").join(seen, "object_name", "left")
    return joined.withColumn("status", status).select(
        "cik", "object_name", "status",
        F.when(F.col("status") == "ok", F.col("size")).otherwise(0).alias("bytes"),
    )


def head_companies(universe: DataFrame, n: int) -> DataFrame:
    """The first ``n`` companies in the universe's own order."""
    return universe.orderBy(F.desc("distress_label"), F.asc("company_name"), F.asc("cik")).limit(n)


def run_summary(results: DataFrame) -> DataFrame:
    """Outcomes per status and the volume stored."""
    return results.groupBy("status").agg(
        F.count("*").alias("n"),
        (F.coalesce(F.sum("bytes"), F.lit(0)) / F.lit(1048576.0)).alias("total_mb"),
    )
