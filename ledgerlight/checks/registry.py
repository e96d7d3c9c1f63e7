"""Every operator as a named query over whole tables, with its oracle where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.checks import oracle as O
from ledgerlight.checks.inputs import Inputs
from ledgerlight.functions import text as X
from ledgerlight.functions import values as V
from ledgerlight.operators import composite as C
from ledgerlight.operators import facts as FL
from ledgerlight.operators import filings as TX
from ledgerlight.operators import gold as G
from ledgerlight.operators import quantiles as Q
from ledgerlight.operators import silver as S
from ledgerlight.operators import text_features as N
from ledgerlight.operators import universe as U
from ledgerlight.plans import dashboard as D
from ledgerlight.plans import diagnostics as A
from ledgerlight.plans import incremental_gold as IG
from ledgerlight.plans import layers as L
from ledgerlight.session import checkpointed, scratch_path
from ledgerlight.sources import keyed as KY
from ledgerlight.sources import readers as RD
from ledgerlight.sources import writers as WR
from ledgerlight.streaming import incremental as IN

Plan = Callable[[Inputs], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The SQL of each query before its inputs are put in.
ORACLES_OF: dict[str, str] = {}


def add(name: str, plan: Plan, sql: str | None = None, digits: dict[str, int] | None = None) -> None:
    """Register a query. ``digits`` rounds computed doubles alike on both sides, where the order of summing
    or a library's last bit could differ."""
    digits = digits or {}

    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = plan(Inputs(spark, folder))
        return result.withColumns({c: F.round(c, n) for c, n in digits.items()}) if digits else result

    QUERIES[name] = run
    if sql is not None:
        ORACLES_OF[name] = sql
        ORACLES[name] = O.rounded(O.oracle(sql), digits) if digits else O.oracle(sql)


SILVER = ", ".join(K.SILVER_COLUMNS)
KEYS = "cik, period_end"
Z = {"altman_z_score": 8}
# Single divisions are left unrounded: both engines agree on every bit, while rounding can meet a tie.
GROWTHS = ["revenue_growth_qoq", "net_income_growth_qoq", "asset_growth_qoq"]
PARTS = dict.fromkeys(K.COMPOSITE_WEIGHTS, 8)


# ------------------------------------------------------------------------------------ sources and sinks


def _packed_facts(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "facts-documents")
    # compressed files are read by one task each, so their lines are bounded
    t.blobs.select("raw").write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", 250_000).text(path)
    return FL.flatten_facts(RD.read_company_facts(t.spark, path, packed=True, pattern="*.txt.snappy"))


FLAT = "cik, company_name, period_end, fiscal_year, fiscal_period, form_type, filed_date, field, value"
add("src1_read_company_facts", _packed_facts, f"SELECT {FLAT} FROM flattened")
add(
    "src1_rejected_documents",
    lambda t: FL.rejected_documents(t.blobs).select("object_name"),
    """SELECT concat('edgar_company_facts/ingestion_date=2024-01-0', CAST(l_linenumber AS STRING), '/CIK',
        lpad(CAST(l_suppkey AS STRING), 10, '0'), '-', CAST(l_orderkey AS STRING), '.json') AS object_name
       FROM lineitem WHERE l_linenumber = 7 AND l_partkey % 5 = 0""",
)
add(
    "src1_documents_with_bad_values",
    lambda t: FL.documents_with_bad_values(t.blobs).select("object_name"),
    """SELECT DISTINCT concat('edgar_company_facts/ingestion_date=2024-01-0', CAST(l_linenumber AS STRING), '/CIK',
        lpad(CAST(l_suppkey AS STRING), 10, '0'), '-', CAST(l_orderkey AS STRING), '.json') AS object_name
       FROM lineitem WHERE NOT (l_linenumber = 7 AND l_partkey % 5 = 0) AND l_partkey % 17 <> 0 AND l_partkey % 13 <> 0
         AND (l_partkey % 23 = 0 OR (l_partkey % 31 = 0 AND l_partkey % 29 <> 0))""",
)


def _stored_section_texts(t: Inputs) -> DataFrame:
    """Section texts as packed bytes, some of them broken, read back."""
    path = scratch_path(t.spark, "sections")
    broken = F.when(F.col("doc_id") % 7 == 0, F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF")))).otherwise(F.col("text").cast("binary"))
    t.filing_text.select("object_name", broken.alias("content")).write.mode("overwrite").parquet(path)
    return RD.read_filing_text(t.spark, path, packed=True)


add(
    "src2_read_filing_text",
    lambda t: _stored_section_texts(t).select("cik", "accession", "section", "ingestion_date", "text"),
    """SELECT cik, accession, section, ingestion_date, concat(text, CASE WHEN doc_id % 7 = 0 THEN chr(65533) ELSE '' END) AS text
       FROM parsed_names""",
)
add(
    "src2_decode_text",
    lambda t: t.table("documents").select("doc_id", X.decode_text(F.col("text").cast("binary")).alias("text")),
    "SELECT doc_id, text FROM documents",
)
add(
    "src3_parse_object_name",
    lambda t: N.parse_object_name(t.filing_text).select(
        "doc_id", "cik", "accession", "section", "ingestion_date"
    ),
    "SELECT doc_id, cik, accession, section, ingestion_date FROM parsed_names",
)


def _stored_universe(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "universe")
    WR.write_universe(t.universe_built, path)
    return RD.read_universe(t.spark, path)


STORED_UNIVERSE = (
    "SELECT cik, nullif(ticker, '') AS ticker, company_name, source, "
    "CAST(distress_label AS VARCHAR) AS distress_label, nullif(distress_event_date, '') AS distress_event_date, "
    "nullif(brd_disposition, '') AS brd_disposition, CAST(brd_prepackaged AS VARCHAR) AS brd_prepackaged, "
    "nullif(brd_after_emerging, '') AS brd_after_emerging FROM universe_built"
)
STORED_COLUMNS = [
    "cik", "ticker", "company_name", "source", "distress_label", "distress_event_date", "brd_disposition",
    "brd_prepackaged", "brd_after_emerging",
]
add("src4_read_universe", lambda t: _stored_universe(t).select(*STORED_COLUMNS), STORED_UNIVERSE)


def _stored_silver(t: Inputs) -> str:
    path = scratch_path(t.spark, "silver")
    WR.write_silver(t.silver, path)
    return path


add(
    "src5_read_partitioned",
    lambda t: RD.read_partitioned(t.spark, _stored_silver(t)).select(*K.SILVER_COLUMNS),
    f"SELECT {SILVER} FROM silver",
)


def _drifting(t: Inputs) -> DataFrame:
    """Line items whose quantity has another type in each folder and whose price is whole in one of them."""
    path = f"{scratch_path(t.spark, 'drifting')}/{uuid.uuid4().hex}"
    kinds = ["INT", "BIGINT", "DOUBLE", "STRING", "SMALLINT"]
    for i, kind in enumerate(kinds):
        price = "CAST(floor(l_extendedprice) AS BIGINT)" if kind == "BIGINT" else "l_extendedprice"
        rows = t.table("lineitem").where(F.col("l_linenumber") % len(kinds) == i).selectExpr(
            "l_orderkey", "l_linenumber", f"CAST({'l_quantity' if kind == 'DOUBLE' else 'CAST(l_quantity AS INT)'} AS {kind}) AS quantity", f"{price} AS price",
        )
        (rows.withColumn("note", F.lit(kind)) if i % 2 else rows).write.parquet(f"{path}/part={i}")
    return RD.read_partitioned(t.spark, path)


add(
    "src5_read_drifting_types",
    _drifting,
    """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 2 THEN CAST(l_quantity AS VARCHAR) ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS quantity,
         CASE l_linenumber % 5 WHEN 1 THEN floor(l_extendedprice) ELSE CAST(l_extendedprice AS DOUBLE) END AS price,
         CASE l_linenumber % 5 WHEN 1 THEN 'BIGINT' WHEN 3 THEN 'STRING' END AS note, CAST(l_linenumber % 5 AS INT) AS part
       FROM lineitem""",
)
add(
    "src6_read_layer",
    lambda t: RD.read_layer(t.spark, f"{t.folder}/supplier.parquet").select("s_suppkey", "s_name"),
    "SELECT s_suppkey, s_name FROM supplier",
)


def _stored_cases(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "cases")
    t.cases.write.mode("overwrite").options(**WR.CSV_OPTIONS, encoding="ISO-8859-1").csv(path)
    return RD.read_bankruptcy_cases(t.spark, path, drop_malformed=True)


CASE_CELLS = ["NameCorp", "CikBefore", "Chapter", "DateFiled", "YearFiled", "AssetsBefore", "Prepackaged"]
add(
    "src7_read_bankruptcy_cases",
    lambda t: _stored_cases(t).select(*CASE_CELLS),
    f"SELECT {', '.join(CASE_CELLS)} FROM cases",
)

STEPS_SUBMISSIONS = """
SELECT doc, cik, idx, form, concat(acc, CAST(idx AS VARCHAR)) AS accession_dashed, day AS filing_date,
  primary_document
FROM (
  SELECT o_orderkey AS doc, CAST(o_custkey AS VARCHAR) AS cik, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
    concat(lpad(CAST(o_custkey AS STRING), 10, '0'), '-20-', lpad(CAST(o_orderkey % 100000 AS STRING), 5, '0')) AS acc,
    idx,
    CASE idx WHEN 0 THEN CASE o_orderkey % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-K/A' ELSE '10-Q' END
      WHEN 1 THEN CASE o_orderkey % 5 WHEN 0 THEN '20-F' WHEN 1 THEN '8-K' ELSE '10-K' END
      WHEN 2 THEN CASE o_orderkey % 7 WHEN 0 THEN '40-F' ELSE '10-K' END
      WHEN 3 THEN '10-K' ELSE '40-F' END AS form,
    CASE idx WHEN 0 THEN 'a.htm' WHEN 1 THEN 'b.htm' WHEN 2 THEN 'c.txt' WHEN 3 THEN 'd.htm' ELSE 'e.htm' END
      AS primary_document
  FROM orders CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS v(idx)
  WHERE idx < 4 OR o_orderkey % 4 <> 0) q
"""
O.STEPS["submission_rows"] = STEPS_SUBMISSIONS
SUBMISSION_CELLS = ["doc", "cik", "form", "accession_dashed", "filing_date", "primary_document"]
add(
    "src8_read_submissions",
    lambda t: TX.read_submission_rows(t.submissions).select(*SUBMISSION_CELLS),
    f"SELECT {', '.join(SUBMISSION_CELLS)} FROM submission_rows",
)
add(
    "src9_first_available",
    lambda t: RD.first_available(
        t.spark, [f"{t.folder}/no_such_layer", f"{t.folder}/nation.parquet"], "n_nationkey INT, n_name STRING"
    ).select("n_nationkey", "n_name"),
    "SELECT n_nationkey, n_name FROM nation",
)

add(
    "snk1_write_silver",
    lambda t: t.spark.read.parquet(_stored_silver(t)).groupBy("fiscal_year").agg(F.count("*").alias("n")),
    "SELECT fiscal_year, count(*) AS n FROM silver WHERE fiscal_year IS NOT NULL GROUP BY fiscal_year",
)


def _stored_gold(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "gold")
    WR.write_gold(t.gold, path)
    return RD.read_partitioned(t.spark, path)


add(
    "snk2_write_gold",
    lambda t: _stored_gold(t).select("cik", "period_end", "distress_label", "altman_z_score"),
    "SELECT cik, period_end, distress_label, altman_z_score FROM gold",
    Z,
)


def _stored_texts(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "text-features")
    WR.write_text_features(t.text_features, path)
    return RD.read_partitioned(t.spark, path)


add(
    "snk3_write_text_features",
    lambda t: _stored_texts(t).select("accession", "section", "sentiment_score"),
    "SELECT accession, section, sentiment_score FROM text_features",
)


def _stored_composite(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "composite")
    WR.write_composite(t.composite, path)
    return t.spark.read.parquet(path)


add(
    "snk4_write_composite",
    lambda t: _stored_composite(t).select("cik", "period_end", "composite_score", "composite_zone"),
    "SELECT cik, period_end, composite_score, composite_zone FROM composite",
    {"composite_score": 8},
)
add(
    "snk5_write_universe",
    lambda t: _stored_universe(t).groupBy("source", "distress_label").agg(F.count("*").alias("n")),
    "SELECT source, CAST(distress_label AS VARCHAR) AS distress_label, count(*) AS n FROM universe_built "
    "GROUP BY source, distress_label",
)


def _landed_pages(t: Inputs) -> DataFrame:
    """Land the pages, each name twice with different content, then land them again: the second time nothing is new.

    What is read are the rows that both calls return.
    """
    path = f"{scratch_path(t.spark, 'landed')}/{uuid.uuid4().hex}"
    objects = t.table("pages").select(
        F.col("url").alias("object_name"), F.col("html").alias("content"), F.col("url").alias("source_url"),
        F.lit(200).alias("http_status"),
    )
    again = objects.withColumn("content", F.concat("content", F.lit("\n<!-- again -->")))
    first = WR.land_with_lineage(objects.unionByName(again), path)
    landed = t.spark.read.parquet(path).select("object_name")
    stored = first.unionByName(WR.land_with_lineage(objects, path, landed))
    meta = F.get_json_object("meta_json", "$.sha256").alias("meta_sha256")
    return stored.select("object_name", "sha256", F.col("size_bytes").cast("bigint"), meta)


add(
    "snk6_land_with_lineage",
    _landed_pages,
    """SELECT object_name, min(sha256) AS sha256, arg_min(size_bytes, sha256) AS size_bytes, min(sha256) AS meta_sha256
       FROM (SELECT url AS object_name, sha256(body) AS sha256, CAST(octet_length(encode(body)) AS BIGINT) AS size_bytes
         FROM (SELECT url, html AS body FROM pages UNION ALL SELECT url, concat(html, chr(10), '<!-- again -->') FROM pages) b) q
       GROUP BY object_name""",
)


def _landed_by_two_runs(t: Inputs) -> DataFrame:
    """Two runs land overlapping pages; the second began before the first was done, so its choice is made anew when it commits."""
    path = f"{scratch_path(t.spark, 'landed-once')}/{uuid.uuid4().hex}"
    objects = t.table("pages").select(
        F.concat(F.col("page_id").cast("string"), F.lit(" "), F.col("url")).alias("object_name"), F.col("html").alias("content"), F.col("url").alias("source_url"),
        F.lit(200).alias("http_status"), "page_id",
    )
    WR.land_once(objects.where("page_id % 3 = 0").drop("page_id"), path)
    WR.land_once(objects.where("page_id % 3 <> 1").withColumn("content", F.concat("content", F.lit("again"))).drop("page_id"), path)
    WR.land_once(objects.drop("page_id"), path)
    return RD.read_landed(t.spark, path).select("object_name", "sha256")


add(
    "snk6_land_once",
    _landed_by_two_runs,
    """SELECT concat(CAST(page_id AS VARCHAR), ' ', url) AS object_name, sha256(CASE page_id % 3 WHEN 2 THEN concat(html, 'again') ELSE html END) AS sha256 FROM pages""",
)

# Landing of filing sections: page texts as filings, some without a filing, some that failed to download.
LAND_DATE = "2024-01-01"


def _land_documents(t: Inputs) -> DataFrame:
    return t.filing_html.select(
        F.col("cik"),
        F.when(F.col("page_id") % 10 != 0, F.lpad(F.col("page_id").cast("string"), 18, "0")).alias("accession"),
        F.when(F.col("page_id") % 9 != 0, X.clean_html("html")).alias("text"),
    )


def _landed_names(t: Inputs) -> DataFrame:
    key = X.object_key(
        F.col("page_id") % 100, F.lpad(F.col("page_id").cast("string"), 18, "0"), F.lit("business"),
        F.lit(LAND_DATE),
    )
    return t.table("pages").select(F.when(F.col("page_id") % 4 == 1, key).alias("object_name"))


O.STEPS["land_sections"] = """
SELECT p.cik, p.accession, CASE WHEN p.accession IS NOT NULL AND p.readable THEN p.section END AS section,
  CASE WHEN p.accession IS NULL THEN 'no_filings' WHEN NOT p.readable THEN 'fetch_failed'
    WHEN p.page_id % 4 = 1 AND p.section = 'business' THEN 'already_exists'
    WHEN p.section_text IS NULL THEN 'section_not_found' ELSE 'ok' END AS status,
  p.section_text
FROM (SELECT page_id, cik, section, section_text, page_id % 9 <> 0 AS readable,
    CASE WHEN page_id % 10 <> 0 THEN lpad(CAST(page_id AS VARCHAR), 18, '0') END AS accession
  FROM page_sections) p
WHERE (p.accession IS NOT NULL AND p.readable) OR p.section = 'mda'
"""
O.STEPS["land_outcomes"] = """
SELECT cik, accession, section, status,
  CASE status WHEN 'ok' THEN octet_length(encode(section_text)) WHEN 'no_filings' THEN NULL WHEN 'fetch_failed' THEN NULL
    ELSE 0 END AS bytes
FROM land_sections
"""
add(
    "snk7_run_summary",
    lambda t: TX.run_summary(TX.land_sections(_land_documents(t), _landed_names(t), LAND_DATE)),
    "SELECT status, count(*) AS n, coalesce(sum(bytes), 0) / 1048576.0 AS total_mb FROM land_outcomes GROUP BY status",
    {"total_mb": 8},
)


def _outcome_file(t: Inputs) -> DataFrame:
    """The outcome of every item, written as a file and read back."""
    path = scratch_path(t.spark, "outcomes")
    WR.write_summary(TX.land_sections(_land_documents(t), _landed_names(t), LAND_DATE).drop("section_text"), path)
    cells = "cik STRING, accession STRING, section STRING, object_name STRING, status STRING, bytes BIGINT"
    stored = t.spark.read.options(**WR.CSV_OPTIONS).schema(cells).csv(path)
    return stored.select("cik", "accession", "section", "status", "bytes")


add(
    "snk7_write_summary",
    _outcome_file,
    """SELECT CAST(cik AS VARCHAR) AS cik, accession, section, status, CAST(bytes AS BIGINT) AS bytes FROM land_outcomes""",
)
add(
    "snk8_dry_run",
    lambda t: WR.dry_run(t.silver.select(*K.SILVER_COLUMNS), ["cik", "period_end"], 5),
    f"SELECT {SILVER} FROM silver ORDER BY cik, period_end LIMIT 5",
)

# ------------------------------------------------------------------------------------- flattening facts

add(
    "flt1_merge_namespaces",
    lambda t: FL.explode_facts(t.blobs, fields=("val",)).groupBy("tag").agg(
        F.count("*").alias("n"), F.sum(V.fact_number("val")).alias("total")
    ),
    "SELECT tag, count(*) AS n, sum(val) AS total FROM blob_entries GROUP BY tag",
    {"total": 2},
)
add(
    "flt2_explode_facts",
    lambda t: FL.explode_facts(t.blobs).select(
        "object_name", F.col("cik").cast("bigint").alias("cik"), "tag", "end_str",
        V.fact_number("val").alias("val"), "fp", "form", "filed_str",
    ),
    "SELECT object_name, cik, tag, end_str, val, fp, form, filed_str FROM blob_entries",
)


def _usable_tagged(t: Inputs) -> DataFrame:
    usable = FL.filter_forms(t.tagged).filter(V.iso_date("end_str").isNotNull() & F.col("val").isNotNull())
    return FL.resolve_tag_aliases(usable)


O.STEPS["tagged_best"] = f"""
SELECT * EXCLUDE (priority, best) FROM (
  SELECT t.*, a.field, a.priority, min(a.priority) OVER (PARTITION BY t.file_key, a.field) AS best
  FROM tagged t JOIN aliases a ON t.tag = a.tag
  WHERE ({O.FORM_OK}) AND TRY_CAST(end_str AS DATE) IS NOT NULL AND val IS NOT NULL) q
WHERE priority = best
"""
TAGGED_CELLS = ["cik", "file_key", "tag", "field", "end_str", "form", "filed_str", "val"]
add(
    "flt3_resolve_tag_aliases",
    lambda t: _usable_tagged(t).select(*TAGGED_CELLS),
    f"SELECT {', '.join(TAGGED_CELLS)} FROM tagged_best",
)
add(
    "flt3_flatten_facts",
    lambda t: FL.flatten_facts(t.blobs),
    f"SELECT {FLAT} FROM flattened",
)
add(
    "flt4_filter_forms",
    lambda t: FL.filter_forms(t.tagged).groupBy("form").agg(F.count("*").alias("n")),
    f"SELECT form, count(*) AS n FROM tagged WHERE {O.FORM_OK} GROUP BY form",
)
add(
    "flt5_iso_date",
    lambda t: t.tagged.select(
        "cik", "tag", V.iso_date("end_str").alias("period_end"), V.iso_date("filed_str").alias("filed_date")
    ),
    "SELECT cik, tag, TRY_CAST(end_str AS DATE) AS period_end, TRY_CAST(nullif(filed_str, '') AS DATE) AS filed_date "
    "FROM tagged",
)
add(
    "flt6_coerce_fact_row",
    lambda t: FL.coerce_fact_row(
        t.tagged.select(
            F.col("cik").cast("string").alias("cik"), F.lit(None).cast("string").alias("company_name"),
            F.col("end_str").alias("end"), F.col("val").cast("string").alias("val"),
            F.lit(None).cast("string").alias("fp"), "form", F.col("filed_str").alias("filed"),
            F.col("tag").alias("field"),
        )
    ),
    """SELECT cik, 'Unknown' AS company_name, TRY_CAST(end_str AS DATE) AS period_end,
         CAST(year(TRY_CAST(end_str AS DATE)) AS INTEGER) AS fiscal_year, '' AS fiscal_period, form AS form_type,
         TRY_CAST(nullif(filed_str, '') AS DATE) AS filed_date, tag AS field, val AS value
       FROM tagged WHERE TRY_CAST(end_str AS DATE) IS NOT NULL AND val IS NOT NULL""",
)
add(
    "flt7_cast_dates",
    lambda t: FL.cast_dates(
        t.tagged.select("cik", "tag", F.col("end_str").alias("period_end"), F.col("filed_str").alias("filed_date"))
    ),
    "SELECT cik, tag, TRY_CAST(end_str AS DATE) AS period_end, TRY_CAST(nullif(filed_str, '') AS DATE) AS filed_date "
    "FROM tagged",
)

# ----------------------------------------------------------------------------------------------- silver

FACT_CELLS = "cik, company_name, period_end, fiscal_year, fiscal_period, form_type, filed_date, field, value"
add("slv1_latest_filed", lambda t: S.latest_filed(t.facts), f"SELECT {FACT_CELLS} FROM survivors")
add(
    "slv2_pivot_facts",
    lambda t: S.pivot_facts(S.latest_filed(t.facts)),
    f"SELECT {KEYS}, {', '.join(K.FACT_FIELDS)} FROM pivoted",
)
add(
    "slv3_ensure_columns",
    lambda t: S.ensure_columns(
        S.pivot_facts(S.latest_filed(t.facts), K.FACT_FIELDS[:6]), dict.fromkeys(K.FACT_FIELDS, "double")
    ),
    f"SELECT {KEYS}, {', '.join(K.FACT_FIELDS[:6])}, "
    + ", ".join(f"CAST(NULL AS DOUBLE) AS {name}" for name in K.FACT_FIELDS[6:])
    + " FROM pivoted",
)
add(
    "slv4_period_rank",
    lambda t: S.with_period_rank(t.facts).groupBy("fiscal_period", "period_rank").agg(F.count("*").alias("n")),
    f"SELECT fiscal_period, {O.RANK} AS period_rank, count(*) AS n FROM facts GROUP BY fiscal_period",
)
META = ", ".join(["cik", *K.META_COLUMNS])
add("slv5_representative_meta", lambda t: S.representative_meta(S.latest_filed(t.facts)), f"SELECT {META} FROM meta")


def _attached(t: Inputs) -> DataFrame:
    survivors = S.latest_filed(t.facts)
    return S.attach_meta(S.pivot_facts(survivors), S.representative_meta(survivors))


add(
    "slv6_attach_meta",
    _attached,
    "SELECT p.*, m.* EXCLUDE (cik, period_end) FROM pivoted p JOIN meta m ON p.cik = m.cik AND p.period_end = m.period_end",
)
add(
    "slv7_working_capital",
    lambda t: t.silver.select("cik", "period_end", "working_capital"),
    "SELECT cik, period_end, assets_current - liabilities_current AS working_capital FROM pivoted",
)
add(
    "slv8_ebit",
    lambda t: t.silver.select("cik", "period_end", "ebit"),
    "SELECT cik, period_end, ebit FROM silver",
)
add("slv9_silver", lambda t: t.silver, f"SELECT {SILVER} FROM silver")
add("slv9_silver_by_steps", lambda t: S.silver_by_steps(t.facts), f"SELECT {SILVER} FROM silver")
add(
    "slv10_silver_counts",
    lambda t: S.silver_counts(t.silver),
    "SELECT count(*) AS total_rows, count(DISTINCT cik) AS companies FROM silver",
)
O.STEPS["deduped"] = """
SELECT * EXCLUDE (pos) FROM (
  SELECT cik, period_end, fiscal_year, field, value, form_type, row_number() OVER (PARTITION BY cik, period_end
    ORDER BY fiscal_year, field, value, form_type) AS pos FROM facts) q
WHERE pos = 1
"""
add(
    "slv11_hard_dedup",
    lambda t: S.hard_dedup(t.facts.select("cik", "period_end", "fiscal_year", "field", "value", "form_type")),
    "SELECT * FROM deduped",
)

# ------------------------------------------------------------------------------------------------- gold

LABEL_CELLS = ", ".join(
    ["cik", "distress_label", "distress_event_date", "distress_event_type", *K.ENRICHMENT_TYPES]
)
add("gld1_universe_labels", lambda t: G.universe_labels(t.universe), f"SELECT {LABEL_CELLS} FROM labels_typed")
BASE_CELLS = ["cik", "period_end", "assets_total", "distress_label", "distress_event_type", "brd_days_in_bk"]
add("gld2_join_labels", lambda t: t.base.select(*BASE_CELLS), f"SELECT {', '.join(BASE_CELLS)} FROM base")
add(
    "gld3_altman_ratios",
    lambda t: G.with_ratios(t.base).select("cik", "period_end", *K.Z_WEIGHTS),
    f"SELECT {KEYS}, {', '.join(K.Z_WEIGHTS)} FROM ratios",
)
add(
    "gld4_altman_z",
    lambda t: G.with_z_score(G.with_ratios(t.base)).select("cik", "period_end", "altman_z_score"),
    f"SELECT {KEYS}, altman_z_score FROM scored",
    Z,
)
add(
    "gld5_z_zone",
    lambda t: G.with_zone(G.with_z_score(G.with_ratios(t.base))).select("cik", "period_end", "distress_zone"),
    f"SELECT {KEYS}, distress_zone FROM scored",
)
PREVIOUS = ", ".join(G.PREVIOUS.values())
add(
    "gld6_prev_values",
    lambda t: G.with_previous(t.base).select("cik", "period_end", *G.PREVIOUS.values()),
    f"SELECT {KEYS}, {PREVIOUS} FROM gold",
)
add(
    "gld7_growth",
    lambda t: G.with_growth(G.with_previous(t.base)).select("cik", "period_end", *GROWTHS),
    f"SELECT {KEYS}, {', '.join(GROWTHS)} FROM gold",
)
add(
    "gld8_declining_3",
    lambda t: G.with_declines(t.base).select("cik", "period_end", "revenue_declining_3q", "net_income_declining_3q"),
    f"SELECT {KEYS}, revenue_declining_3q, net_income_declining_3q FROM gold",
)
GOLD_CELLS = [
    *K.SILVER_COLUMNS, "distress_label", "distress_event_date", "distress_event_type", *K.ENRICHMENT_TYPES,
    *K.Z_WEIGHTS, "altman_z_score", "distress_zone", *G.PREVIOUS.values(), *GROWTHS,
    "revenue_declining_3q", "net_income_declining_3q",
]
add(
    "gld9_gold_ordered",
    lambda t: G.gold_ordered(t.gold).select(*GOLD_CELLS),
    f"SELECT {', '.join(GOLD_CELLS)} FROM gold",
    Z,
)
add(
    "gld10_zone_counts",
    lambda t: G.zone_counts(t.gold),
    "SELECT distress_zone AS zone, count(*) AS n FROM gold WHERE distress_zone IS NOT NULL GROUP BY distress_zone",
)


def describe_sql(value: str, source: str) -> str:
    return (
        f"SELECT count({value}) AS n, avg({value}) AS mean_value, stddev_samp({value}) AS std_value, "
        f"min({value}) AS min_value, max({value}) AS max_value, quantile_cont({value}, 0.25) AS q1, "
        f"median({value}) AS median_value, quantile_cont({value}, 0.75) AS q3 FROM {source}"
    )


MOMENTS = dict.fromkeys(["mean_value", "std_value", "min_value", "max_value", "q1", "median_value", "q3"], 6)
add(
    "gld10_quartiles_of_facts",
    lambda t: Q.exact_quantiles(t.facts.select("field", "value"), ["field"], "value", Q.QUARTILES, {"n": F.count("value")}, accuracy=100),
    """SELECT field, count(value) AS n, quantile_cont(value, 0.25) AS q1, median(value) AS median_value, quantile_cont(value, 0.75) AS q3
       FROM facts GROUP BY field""",
    {"q1": 6, "median_value": 6, "q3": 6},
)
add(
    "gld10_describe",
    lambda t: Q.describe(t.gold, "altman_z_score"),
    describe_sql("altman_z_score", "gold"),
    MOMENTS,
)

# ----------------------------------------------------------------------------------------------- filings

add(
    "txt1_clean_html",
    lambda t: t.table("pages").select("page_id", X.clean_html("html").alias("text")),
    "SELECT page_id, text FROM raw_pages_clean",
)


def _page_sections(t: Inputs) -> DataFrame:
    cleaned = t.filing_html.select("page_id", "cik", X.clean_html("html").alias("text"))
    return TX.sections_of(cleaned)


add("txt2_extract_section", _page_sections, "SELECT page_id, cik, section, section_text FROM page_sections")
# The byte prefix as hex; the lead bytes of a character that the prefix ends in become U+FFFD.
CUT_CHARACTER = "^((?:[0-9A-F]{2})*?)(?:[CD][0-9A-F]|E[0-9A-F](?:[89AB][0-9A-F])?|F[0-7](?:[89AB][0-9A-F]){0,2})$"
add(
    "txt3_truncate_utf8",
    lambda t: t.table("documents").select("doc_id", F.hex(X.truncate_utf8("text", 501).cast("binary")).alias("head_hex")),
    f"""SELECT doc_id, CASE WHEN length(h) <= 1002 THEN h
         WHEN substr(h, 1003, 1) IN ('8', '9', 'A', 'B') THEN regexp_replace(substr(h, 1, 1002), '{CUT_CHARACTER}', '\\1EFBFBD')
         ELSE substr(h, 1, 1002) END AS head_hex
       FROM (SELECT doc_id, hex(encode(text)) AS h FROM documents) d""",
)
O.STEPS["annual_filings"] = """
SELECT doc, cik, form, accession_dashed, filing_date, primary_document, replace(accession_dashed, '-', '') AS accession
FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY idx) AS pos FROM submission_rows
  WHERE form IN ('10-K', '20-F', '40-F')) q
WHERE pos <= 3
"""
add(
    "txt4_recent_annual_filings",
    lambda t: TX.recent_annual_filings(t.submissions),
    "SELECT * FROM annual_filings",
)
add(
    "txt4_recent_annual_rows",
    lambda t: TX.recent_annual_rows(t.filings),
    """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY cik ORDER BY filing_date DESC, accession) AS INTEGER) AS rank
         FROM filings WHERE form IN ('10-K', '20-F', '40-F')) q WHERE rank <= 3""",
)
add(
    "txt5_object_key",
    lambda t: t.filings.select(
        X.object_key("cik", F.replace("accession", F.lit("-"), F.lit("")), F.lit("mda"), F.col("filing_date").cast("string"))
        .alias("object_name"),
        X.document_path("cik", "accession", "primary_document").alias("document_path"),
        X.facts_key(V.pad_cik("cik"), F.col("filing_date").cast("string")).alias("facts_name"),
    ),
    """SELECT concat('edgar_filings_text/ingestion_date=', CAST(filing_date AS VARCHAR), '/CIK', lpad(CAST(cik AS VARCHAR), 10, '0'),
           '_', replace(accession, '-', ''), '_mda.txt') AS object_name,
         concat('edgar/data/', CAST(cik AS VARCHAR), '/', replace(accession, '-', ''), '/', primary_document) AS document_path,
         concat('edgar_company_facts/ingestion_date=', CAST(filing_date AS VARCHAR), '/CIK', lpad(CAST(cik AS VARCHAR), 10, '0'),
           '.json') AS facts_name
       FROM filings""",
)
add(
    "txt6_only_new",
    lambda t: TX.only_new(
        t.filings.select(F.col("accession").alias("object_name")),
        t.filings.filter("form IN ('10-K', '10-Q')").select(F.col("accession").alias("object_name")),
    ),
    """SELECT DISTINCT accession AS object_name FROM filings f
       WHERE NOT EXISTS (SELECT 1 FROM filings g WHERE g.form IN ('10-K', '10-Q') AND g.accession = f.accession)""",
)
add(
    "txt7_ingest_status",
    lambda t: TX.land_sections(_land_documents(t), _landed_names(t), LAND_DATE).select(
        "cik", "accession", "section", "status", F.col("bytes").cast("bigint")
    ),
    "SELECT cik, accession, section, status, CAST(bytes AS BIGINT) AS bytes FROM land_outcomes",
)


def _facts_status(t: Inputs) -> DataFrame:
    key = X.facts_key(V.pad_cik("s_suppkey"), F.lit(LAND_DATE)).alias("object_name")
    suppliers = t.table("supplier").select(F.col("s_suppkey").alias("cik"), key, "s_acctbal", "s_nationkey")
    fetched = suppliers.filter("s_nationkey <> 3").select(
        "object_name",
        F.when(F.col("s_nationkey") != 4, F.length("object_name") * F.lit(100)).alias("size"),
        F.when(F.col("s_nationkey") == 5, F.lit("timeout")).alias("error"),
    )
    landed = suppliers.filter("s_acctbal > 8000").select("object_name")
    return TX.facts_ingest_status(suppliers.select("cik", "object_name"), fetched, landed)


add(
    "txt7_facts_status",
    _facts_status,
    """SELECT s_suppkey AS cik, concat('edgar_company_facts/ingestion_date=2024-01-01/CIK', lpad(CAST(s_suppkey AS VARCHAR), 10, '0'),
           '.json') AS object_name,
         CASE WHEN s_acctbal > 8000 THEN 'already_exists' WHEN s_nationkey = 3 THEN 'skipped' WHEN s_nationkey = 5 THEN 'error'
           WHEN s_nationkey = 4 THEN 'failed' ELSE 'ok' END AS status,
         CASE WHEN s_acctbal <= 8000 AND s_nationkey NOT IN (3, 4, 5) THEN 6400 ELSE 0 END AS bytes
       FROM supplier""",
)
add(
    "txt8_head_companies",
    lambda t: TX.head_companies(t.universe_built, 25).select("cik", "company_name", "distress_label"),
    "SELECT cik, company_name, distress_label FROM universe_built ORDER BY distress_label DESC, company_name, cik LIMIT 25",
)

# ----------------------------------------------------------------------------------------- text features

add(
    "nlp1_keyword_counts",
    lambda t: N.keyword_counts(t.filing_text).select("doc_id", "distress_keywords", "positive_keywords"),
    f"SELECT doc_id, {O.terms_sql(K.DISTRESS_TERMS)} AS distress_keywords, "
    f"{O.terms_sql(K.POSITIVE_TERMS)} AS positive_keywords FROM filing_text",
)
add(
    "nlp2_distress_flags",
    lambda t: N.distress_flags(t.filing_text).select("doc_id", *K.FLAG_TERMS),
    "SELECT doc_id, " + ", ".join(f"{O.any_sql(terms)} AS {name}" for name, terms in K.FLAG_TERMS.items())
    + " FROM filing_text",
)
ROW_CELLS = [
    "cik", "accession", "section", "ingestion_date", "text_length", "distress_keywords", "positive_keywords",
    *K.FLAG_TERMS,
]
add(
    "nlp3_document_rows",
    lambda t: L.build_text_features(t.filing_text.drop("doc_id")).select(*ROW_CELLS),
    f"SELECT {', '.join(ROW_CELLS)} FROM text_rows",
)
SHORT_TEMPLATES = {name: (f"<{name}>", "</>") for name in [*K.SECTIONS, "other"]}
CHUNK_CHARS = 4000
O.STEPS["prompts"] = f"""
SELECT doc_id, section, CAST(c AS INT) AS chunk,
  concat(CASE WHEN section IN ('mda', 'risk', 'business') THEN concat('<', section, '>') ELSE '<other>' END,
  translate(substr(text, c * {CHUNK_CHARS} + 1, {CHUNK_CHARS}), '"', ''''), '</>') AS prompt
FROM parsed_names CROSS JOIN LATERAL (SELECT unnest(generate_series(0, greatest(length(text) - 1, 0) // {CHUNK_CHARS})) AS c)
"""


def _prompts(t: Inputs) -> DataFrame:
    return N.build_prompt(N.parse_object_name(t.filing_text), SHORT_TEMPLATES, chunk_chars=CHUNK_CHARS)


add(
    "nlp4_build_prompt",
    lambda t: _prompts(t).select("doc_id", "section", "chunk", "prompt"),
    "SELECT doc_id, section, chunk, prompt FROM prompts",
)
add(
    "nlp4_whole_texts",
    lambda t: N.build_prompt(N.parse_object_name(t.filing_text), SHORT_TEMPLATES).select("doc_id", "prompt"),
    """SELECT doc_id, concat(min(regexp_extract(prompt, '^<[a-z]+>')), string_agg(
         regexp_replace(prompt, '^<[a-z]+>|</>$', '', 'g'), '' ORDER BY chunk), '</>') AS prompt FROM prompts GROUP BY doc_id""",
)


def _answers(t: Inputs) -> DataFrame:
    return N.response_fields(t.responses).drop("raw")


def answer_query(name: str, columns: list[str], digits: dict[str, int] | None = None) -> None:
    add(
        name,
        lambda t: _answers(t).select("doc_id", "section", *columns),
        f"SELECT doc_id, section, {', '.join(columns)} FROM answered",
        digits,
    )


def section_names(section: str) -> list[str]:
    derived = ["risk_level"] if section in K.DERIVED_RISK else []
    own = ["key_vulnerability"] if section == "business" else []
    return [*K.RESPONSE_ENUMS[section], *K.RESPONSE_FLAGS[section], *derived, *own]


answer_query("nlp5_recover_json", ["llm_raw", "llm_summary"])
answer_query("nlp6_safe_bool", ["going_concern_explicit", "debt_maturity_risk", "regulatory_dependency"])
answer_query("nlp7_safe_enum", ["liquidity_signal", "business_model_viability", "severity_language"])
answer_query("nlp8_sentiment", ["sentiment_score", "sentiment_label", "key_distress_signal"], {"sentiment_score": 8})
answer_query("nlp9_mda_fields", section_names("mda"))
answer_query("nlp10_risk_fields", section_names("risk"))
answer_query("nlp11_business_fields", section_names("business"))
answer_query("nlp12_other_fields", ["risk_level"])
answer_query("nlp13_neutral_fallback", ["sentiment_score", "sentiment_label", "risk_level", "llm_raw"], {"sentiment_score": 8})


def _scored(t: Inputs) -> DataFrame:
    """A stand-in for a model answers by the length of the prompt and fails on some prompts."""

    def length_scorer(prompt: str) -> str:
        if len(prompt) % 7 == 0:
            raise ValueError("no answer")
        return f'{{"sentiment_score": {len(prompt) % 10 - 5}, "risk_level": "high"}}'

    prompts = _prompts(t).select("doc_id", "chunk", "prompt")
    answered = N.score_documents(prompts, N.one_by_one(length_scorer))
    return answered.select("doc_id", "chunk", "response.raw", "response.error")


add(
    "nlp14_score_documents",
    _scored,
    """SELECT doc_id, chunk, CASE WHEN length(prompt) % 7 <> 0 THEN concat('{"sentiment_score": ', CAST(length(prompt) % 10 - 5 AS VARCHAR),
           ', "risk_level": "high"}') END AS raw,
         CASE WHEN length(prompt) % 7 = 0 THEN 'no answer' END AS error
       FROM prompts""",
)
TODO = """SELECT object_name, cik, accession, section FROM parsed_names p
  WHERE NOT EXISTS (SELECT 1 FROM text_features f
    WHERE f.cik = p.cik AND f.accession = p.accession AND f.section = p.section{})"""


def _todo(t: Inputs, redo_skipped: bool = False, limit: int | None = None) -> DataFrame:
    todo = N.parse_object_name(t.filing_text).select("object_name", *K.TEXT_KEY)
    return N.resume_filter(todo, N.done_keys(t.text_features, redo_skipped), limit)


add("nlp15_resume_filter", lambda t: _todo(t), TODO.format(""))
add("nlp15_resume_redo_skipped", lambda t: _todo(t, True), TODO.format(" AND f.llm_raw <> 'skipped'"))
add("nlp15_resume_first", lambda t: _todo(t, limit=20), TODO.format("") + " ORDER BY object_name LIMIT 20")


def _upserted(t: Inputs) -> DataFrame:
    old = t.text_features.select(*K.TEXT_KEY, "sentiment_score", "risk_level", "text_length")
    new = L.build_text_features(t.filing_text).select(
        *K.TEXT_KEY, "sentiment_score", "distress_keywords", F.col("text_length").cast("bigint").alias("text_length")
    )
    return N.upsert_latest(old, new)


add(
    "nlp16_upsert_latest",
    _upserted,
    """SELECT cik, accession, section, sentiment_score, NULL AS risk_level, CAST(text_length AS BIGINT) AS text_length, distress_keywords
       FROM (SELECT *, 0.0 AS sentiment_score FROM text_rows) n
       UNION ALL
       SELECT cik, accession, section, sentiment_score, risk_level, text_length, NULL AS distress_keywords
       FROM text_features f WHERE NOT EXISTS (SELECT 1 FROM text_rows n
         WHERE n.cik = f.cik AND n.accession = f.accession AND n.section = f.section)""",
)



def _merged(t: Inputs) -> DataFrame:
    """The same merge on storage: only the folders that new rows fall into are rewritten, and reading needs no window."""
    path = f"{scratch_path(t.spark, 'merged')}/{uuid.uuid4().hex}"
    old = t.text_features.select(*K.TEXT_KEY, "sentiment_score", "risk_level", "text_length")
    new = L.build_text_features(t.filing_text).select(
        *K.TEXT_KEY, "sentiment_score", "distress_keywords", F.col("text_length").cast("bigint").alias("text_length")
    )
    for rows in (old, new):
        WR.merge_text_features(rows, path, buckets=8)
    return KY.read_keyed(t.spark, path).drop(KY.BUCKET)


add("nlp16_merge_on_storage", _merged, ORACLES_OF["nlp16_upsert_latest"])

# -------------------------------------------------------------------------------------------- composite

add(
    "cmp1_z_component",
    lambda t: C.with_components(t.gold).select("cik", "period_end", "z_component"),
    f"SELECT {KEYS}, z_component FROM components",
    {"z_component": 8},
)
add(
    "cmp2_normalise_cik",
    lambda t: C.normalise_cik(t.universe).select("cik", "cik_norm"),
    "SELECT cik, CASE WHEN ltrim(cik, '0') = '' THEN '0' ELSE ltrim(cik, '0') END AS cik_norm FROM universe",
)
add(
    "cmp3_doc_signals",
    lambda t: C.doc_signals(t.text_features).select("accession", "sent_distress", "risk_points", "flag_score"),
    """SELECT accession, CASE WHEN sentiment_score IS NOT NULL THEN sent_distress_raw END AS sent_distress, risk_points,
         CAST(flag_score AS DOUBLE) AS flag_score FROM doc_signals""",
    {"sent_distress": 8, "flag_score": 8},
)
SIGNAL_CELLS = [
    "cik", "avg_sentiment_score", "any_going_concern", "any_liquidity_risk", "any_restructuring", "n_docs_analysed",
]


def _signals(t: Inputs) -> DataFrame:
    signals = C.company_signals(t.text_features)
    return signals.withColumns({name: F.col(name).cast("int") for name in C.ANY_FLAGS.values()})


add(
    "cmp4_company_signals",
    lambda t: _signals(t).select(*SIGNAL_CELLS),
    f"SELECT {', '.join(SIGNAL_CELLS)} FROM signals",
    {"avg_sentiment_score": 8},
)
add(
    "cmp5_llm_component",
    lambda t: _signals(t).select("cik", "llm_component"),
    "SELECT cik, llm_component FROM signals",
    {"llm_component": 8},
)
add(
    "cmp6_risk_label",
    lambda t: _signals(t).select("cik", "avg_risk_level"),
    "SELECT cik, avg_risk_level FROM signals",
)
add(
    "cmp7_trend_component",
    lambda t: C.with_components(t.gold).select("cik", "period_end", "trend_component"),
    f"SELECT {KEYS}, trend_component FROM components",
    {"trend_component": 8},
)
JOINED_CELLS = ["cik", "period_end", *C.SIGNAL_DEFAULTS]
add(
    "cmp8_join_signals",
    lambda t: t.composite.select(*JOINED_CELLS),
    f"SELECT {', '.join(JOINED_CELLS)} FROM composite",
    {"llm_component": 8, "avg_sentiment_score": 8},
)
add(
    "cmp9_composite_score",
    lambda t: t.composite.select("cik", "period_end", "composite_score"),
    f"SELECT {KEYS}, composite_score FROM composite",
    {"composite_score": 8},
)
add(
    "cmp10_composite_zone",
    lambda t: t.composite.select("cik", "period_end", "composite_zone"),
    f"SELECT {KEYS}, composite_zone FROM composite",
)
add(
    "cmp11_classify_outcome",
    lambda t: t.universe.select("cik", V.classify_outcome("brd_after_emerging").alias("after_emerging_class")),
    f"SELECT cik, {O.OUTCOME_SQL} AS after_emerging_class FROM universe",
)
add(
    "cmp12_with_defaults",
    lambda t: C.score_composite(
        C.join_signals(
            C.with_components(t.gold.select("cik", "period_end", "altman_z_score")),
            C.company_signals(t.text_features.select("cik", "risk_level")),
        )
    ).select("cik", "period_end", "composite_score", "after_emerging_class"),
    """SELECT c.cik, c.period_end, 0.60 * z_component + 0.20 * coalesce(part, 0.5) AS composite_score, 'unknown' AS after_emerging_class
       FROM components c LEFT JOIN (
         SELECT CAST(cik AS BIGINT) AS cik, 0.40 * 0.5 + 0.30 * (sum(risk_points) / 100.0 / count(*)) AS part
         FROM doc_signals GROUP BY CAST(cik AS BIGINT)) s ON c.cik = s.cik""",
    {"composite_score": 8},
)
add(
    "cmp13_neutral_when_no_text",
    lambda t: L.build_composite(t.gold).select("cik", "period_end", "llm_component", "avg_risk_level", "composite_score"),
    f"""SELECT {KEYS}, 0.5::DOUBLE AS llm_component, 'unknown' AS avg_risk_level,
          0.60 * z_component + 0.20 * 0.5 + 0.20 * trend_component AS composite_score FROM components""",
    {"composite_score": 8},
)
TOP_CELLS = ["company_name", "period_end", "composite_score", "composite_zone"]
add(
    "cmp14_top_distress",
    lambda t: C.top_distress(t.composite).select(*TOP_CELLS),
    """SELECT company_name, period_end, composite_score, composite_zone FROM (
         SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY composite_score DESC, cik, period_end) AS pos
         FROM composite WHERE composite_zone = 'distress') q
       WHERE pos = 1 ORDER BY composite_score DESC, cik, period_end LIMIT 10""",
    {"composite_score": 8},
)

# --------------------------------------------------------------------------------------------- universe

UNIVERSE_CELLS = ", ".join(K.UNIVERSE_COLUMNS)
add(
    "uni1_normalise_constituents",
    lambda t: U.normalise_constituents(t.constituents),
    f"SELECT {UNIVERSE_CELLS} FROM constituent_rows",
)
add(
    "uni2_filter_cases",
    lambda t: U.filter_cases(t.cases).select(*CASE_CELLS),
    f"SELECT {', '.join(CASE_CELLS)} FROM cases_kept",
)


def _parsed_cases(t: Inputs, **columns) -> DataFrame:
    return t.cases.select("NameCorp", *[column.alias(name) for name, column in columns.items()])


add(
    "uni3_map_disposition",
    lambda t: _parsed_cases(t, brd_disposition=V.map_disposition("Disposition")),
    f"SELECT NameCorp, {O.DISPOSITION_SQL} AS brd_disposition FROM cases",
)
add(
    "uni4_yes_no",
    lambda t: _parsed_cases(t, **{
        name: V.yes_no(source, true_values)
        for name, (source, true_values, _) in K.CASE_FLAGS.items() if source in t.cases.columns
    }),
    "SELECT NameCorp, " + ", ".join(
        O._case_cell(name, "int") for name, (source, _, _) in K.CASE_FLAGS.items() if source in O._CASE_GIVEN
    ) + " FROM cases",
)
add(
    "uni5_us_date",
    lambda t: _parsed_cases(t, filed=V.us_date("DateFiled"), emerging=V.us_date("DateEmerging")),
    f"SELECT NameCorp, {O.us_date_sql('DateFiled')} AS filed, {O.us_date_sql('DateEmerging')} AS emerging FROM cases",
)
add(
    "uni6_to_float",
    lambda t: _parsed_cases(t, assets=V.to_float("AssetsBefore"), sales=V.to_float("SalesBefore")),
    f"SELECT NameCorp, {O.number_sql('AssetsBefore')} AS assets, {O.number_sql('SalesBefore')} AS sales FROM cases",
)
add(
    "uni7_blank_if_null",
    lambda t: _parsed_cases(t, sic=V.blank_if_null("SICDescription"), outcome=V.blank_if_null("AfterEmerging")),
    "SELECT NameCorp, coalesce(trim(SICDescription), '') AS sic, coalesce(trim(AfterEmerging), '') AS outcome FROM cases",
)
add(
    "uni8_cik_from_float",
    lambda t: _parsed_cases(t, cik=V.cik_from_float("CikBefore")),
    "SELECT NameCorp, lpad(CAST(CAST(TRY_CAST(CikBefore AS DOUBLE) AS BIGINT) AS VARCHAR), 10, '0') AS cik FROM cases",
)


def _universe_all(t: Inputs) -> DataFrame:
    return U.union_universe(U.normalise_constituents(t.constituents), t.case_rows)


add("uni9_union_universe", _universe_all, f"SELECT {UNIVERSE_CELLS} FROM universe_all")
add("uni10_prefer_distressed", lambda t: U.prefer_distressed(_universe_all(t)), f"SELECT {UNIVERSE_CELLS} FROM universe_built")
add(
    "uni10_overlap_count",
    lambda t: U.overlap_count(_universe_all(t)),
    "SELECT count(*) - count(DISTINCT cik) AS overlaps FROM universe_all",
)
add("uni11_order_universe", lambda t: t.universe_built, f"SELECT {UNIVERSE_CELLS} FROM universe_built")
add(
    "uni12_enrichment_summary",
    lambda t: U.enrichment_summary(t.case_rows),
    "SELECT count(*) AS cases, " + ", ".join(f"CAST(sum({name}) AS BIGINT) AS {name}" for name in U.SUMMED_FLAGS)
    + " FROM case_rows",
)
add(
    "uni12_disposition_counts",
    lambda t: U.disposition_counts(t.case_rows),
    "SELECT brd_disposition, count(*) AS n FROM case_rows GROUP BY brd_disposition",
)
add(
    "uni12_label_counts",
    lambda t: U.label_counts(t.universe_built),
    "SELECT distress_label, count(*) AS n FROM universe_built GROUP BY distress_label",
)

# ------------------------------------------------------------------------------------------ diagnostics

add(
    "qry1_zone_distribution",
    lambda t: A.zone_distribution(t.gold),
    """SELECT distress_label, distress_zone, n_periods,
         round(100.0 * n_periods / sum(n_periods) OVER (PARTITION BY distress_label), 1) AS pct
       FROM (SELECT distress_label, distress_zone, count(*) AS n_periods FROM gold
         WHERE distress_zone IS NOT NULL GROUP BY ALL) c""",
)
add(
    "qry2_score_by_label",
    lambda t: A.score_by_label(t.gold),
    """SELECT distress_label, round(avg(altman_z_score), 2) AS mean_z, round(median(altman_z_score), 2) AS median_z,
         count(altman_z_score) AS n_scores FROM gold GROUP BY distress_label""",
)
add(
    "qry3_recall",
    lambda t: A.recall(t.gold),
    """SELECT flagged, total, round(100.0 * flagged / total, 1) AS pct FROM (
         SELECT count(DISTINCT cik) FILTER (WHERE distress_zone = 'distress') AS flagged, count(DISTINCT cik) AS total
         FROM gold WHERE distress_label = 1) c""",
)
add(
    "qry4_group_table",
    lambda t: A.group_table(t.gold),
    f"""SELECT {O.LONG_GROUP} AS company_group, count(DISTINCT cik) AS companies, count(*) AS periods_total,
          count(altman_z_score) AS periods_scored, round(avg(altman_z_score), 2) AS mean_z,
          round(median(altman_z_score), 2) AS median_z FROM gold GROUP BY distress_label""",
)
add(
    "qry5_zone_shares",
    lambda t: A.zone_shares(t.gold),
    f"SELECT {O.LONG_GROUP} AS company_group, " + ", ".join(
        f"round(100.0 * sum(CASE distress_zone WHEN '{z}' THEN 1 ELSE 0 END) / count(*), 1) AS pct_{z}"
        for z in ("distress", "grey", "safe")
    ) + " FROM gold WHERE altman_z_score IS NOT NULL GROUP BY distress_label",
)
add(
    "qry6_recall_scored",
    lambda t: A.recall_scored(t.gold),
    """SELECT *, round(100.0 * reached_distress / nullif(companies_with_zscore, 0), 1) AS recall_pct FROM (
         SELECT count(DISTINCT cik) AS companies_with_data,
           count(DISTINCT CASE WHEN altman_z_score IS NOT NULL THEN cik END) AS companies_with_zscore,
           count(DISTINCT CASE WHEN distress_zone = 'distress' THEN cik END) AS reached_distress
         FROM gold WHERE distress_label = 1) c""",
)
add(
    "qry7_coverage",
    lambda t: A.coverage(t.gold),
    """SELECT count(*) AS gold_rows_total, count(altman_z_score) AS gold_rows_scored,
         round(100.0 * count(altman_z_score) / count(*), 1) AS pct_scored FROM gold""",
)
add(
    "qry8_duplicate_keys",
    lambda t: A.duplicate_keys(t.facts),
    "SELECT cik, period_end, count(*) AS n FROM facts GROUP BY cik, period_end HAVING count(*) > 1",
)
add(
    "qry9_null_rates",
    lambda t: A.null_rates(t.silver),
    """SELECT count(*) AS total_rows, count(*) - count(ebit) AS missing_ebit, count(*) - count(working_capital) AS missing_wc,
         count(*) - count(assets_total) AS missing_assets FROM silver""",
)
add(
    "qry10_year_coverage",
    lambda t: A.year_coverage(t.silver),
    "SELECT fiscal_year, count(*) AS n_rows, count(DISTINCT cik) AS companies FROM silver GROUP BY fiscal_year",
)
add(
    "qry11_sample_rows",
    lambda t: A.sample_rows(t.silver),
    "SELECT cik, company_name, period_end, assets_total, ebit, working_capital FROM silver ORDER BY cik, period_end LIMIT 5",
)
add(
    "qry12_column_profile",
    lambda t: A.column_profile(t.cases, text_only=True).select("column_name", "non_null"),
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count({name}) AS non_null FROM cases" for name in O._CASE_GIVEN
    ),
)
add(
    "qry12_value_counts",
    lambda t: A.value_counts(t.cases, "CikBefore"),
    "SELECT CikBefore AS value, count(*) AS n FROM cases WHERE CikBefore IS NOT NULL GROUP BY CikBefore",
)


def _fresh_layers(t: Inputs) -> DataFrame:
    """A layer that this query writes, one file for each folder, and one that does not exist."""
    path = scratch_path(t.spark, "suppliers")
    suppliers = t.table("supplier").withColumn("nation", F.col("s_nationkey"))
    suppliers.repartition("nation").write.mode("overwrite").partitionBy("nation").parquet(path)
    report = A.freshness_report(t.spark, {"suppliers": path, "no_such_layer": f"{path}-none"})
    young = F.coalesce(F.col("age_days").between(-0.01, 0.5), F.lit(False)).alias("young")
    return report.select("layer", "n_files", "is_fresh", young)


add(
    "qry13_freshness",
    _fresh_layers,
    """SELECT 'suppliers' AS layer, count(DISTINCT s_nationkey) AS n_files, true AS is_fresh, true AS young FROM supplier
       UNION ALL SELECT 'no_such_layer', 0, false, false""",
)

# -------------------------------------------------------------------------------------------- dashboard

add("dsh1_filing_types", lambda t: D.filing_types(t.gold), "SELECT DISTINCT form_type FROM gold")
add(
    "dsh2_year_bounds",
    lambda t: D.year_bounds(t.gold),
    "SELECT CAST(min(year(period_end)) AS INTEGER) AS year_min, CAST(max(year(period_end)) AS INTEGER) AS year_max FROM gold",
)
SLICE = "form_type IN ('10-K', '10-Q') AND year(period_end) BETWEEN 1994 AND 1997"
add(
    "dsh3_slice_rows",
    lambda t: D.slice_rows(t.gold, ["10-K", "10-Q"], (1994, 1997), 1).select("cik", "period_end", "form_type"),
    f"SELECT cik, period_end, form_type FROM gold WHERE {SLICE} AND distress_label = 1",
)
add(
    "dsh3_slice_composite",
    lambda t: D.slice_rows(t.composite, ["10-K"], (1994, 1997)).select("cik", "period_end", "composite_zone"),
    "SELECT cik, period_end, composite_zone FROM composite WHERE form_type = '10-K' AND year(period_end) BETWEEN 1994 AND 1997",
)
KPI = "100.0 * sum(CASE {0} WHEN 'distress' THEN 1 ELSE 0 END) / greatest(count({0}), 1) AS distress_pct"
add(
    "dsh4_gold_kpis",
    lambda t: D.gold_kpis(t.gold),
    f"""SELECT count(DISTINCT cik) AS companies, count(*) AS periods, count(altman_z_score) AS scored,
          avg(altman_z_score) AS mean_z, {KPI.format('distress_zone')} FROM gold""",
    {"mean_z": 6, "distress_pct": 6},
)
add(
    "dsh5_zone_counts",
    lambda t: G.zone_counts(D.slice_rows(t.gold, ["10-K"])),
    "SELECT distress_zone AS zone, count(*) AS n FROM gold WHERE form_type = '10-K' AND distress_zone IS NOT NULL GROUP BY ALL",
)
add(
    "dsh6_z_histogram",
    lambda t: D.z_histogram(t.gold),
    """SELECT least(80, CAST(floor(80.0 * (altman_z_score + 20.0) / 40.0) AS INTEGER) + 1) AS bin, count(*) AS n
       FROM gold WHERE altman_z_score IS NOT NULL GROUP BY ALL""",
)
add(
    "dsh7_median_z_over_time",
    lambda t: D.median_over_time(t.gold, "altman_z_score"),
    f"""SELECT period_end, {O.LONG_GROUP} AS company_type, median(altman_z_score) AS median_value
        FROM gold WHERE altman_z_score IS NOT NULL GROUP BY period_end, distress_label""",
    {"median_value": 6},
)
add("dsh8_top_companies", lambda t: D.top_companies(t.gold, "altman_z_score"), "SELECT * FROM top_by_z")
add(
    "dsh9_z_timeline",
    lambda t: D.z_timeline(t.gold, D.top_companies(t.gold, "altman_z_score", 3)),
    """SELECT company_name, cik, period_end, altman_z_score FROM gold WHERE altman_z_score IS NOT NULL
       AND company_name IN (SELECT company_name FROM top_by_z ORDER BY n_scored DESC, company_name LIMIT 3)""",
    Z,
)
add(
    "dsh10_trend_flag_totals",
    lambda t: D.trend_flag_totals(t.gold),
    """SELECT 'Revenue declining 3Q+' AS flag, CAST(sum(revenue_declining_3q) AS BIGINT) AS n FROM gold
       UNION ALL SELECT 'Net income declining 3Q+', CAST(sum(net_income_declining_3q) AS BIGINT) FROM gold""",
)


def five_sql(value: str, groups: str, source: str, name: str) -> str:
    return (
        f"SELECT {groups} AS {name}, count(*) AS n, min({value}) AS min_value, quantile_cont({value}, 0.25) AS q1, "
        f"median({value}) AS median_value, quantile_cont({value}, 0.75) AS q3, max({value}) AS max_value "
        f"FROM {source} WHERE {value} IS NOT NULL GROUP BY {groups}"
    )


FIVE = dict.fromkeys(["min_value", "q1", "median_value", "q3", "max_value"], 6)
add(
    "dsh11_revenue_growth_spread",
    lambda t: D.revenue_growth_spread(t.gold),
    five_sql("revenue_growth_qoq", O.SHORT_GROUP, "gold", "company_type"),
    FIVE,
)
add(
    "dsh12_named_texts",
    lambda t: D.named_texts(t.text_features, t.gold).select("cik", "accession", "company_name"),
    "SELECT cik, accession, company_name FROM named",
)
add(
    "dsh13_text_kpis",
    lambda t: D.text_kpis(t.text_features),
    """SELECT count(*) AS documents, count(DISTINCT cik) AS companies, 100.0 * avg(going_concern) AS going_concern_pct,
         100.0 * count(*) FILTER (WHERE sentiment_score < -0.2) / count(*) AS negative_pct FROM text_features""",
    {"going_concern_pct": 6, "negative_pct": 6},
)
add(
    "dsh14_sentiment_spread",
    lambda t: D.sentiment_spread(t.text_features),
    five_sql("sentiment_score", "section", "text_features", "section"),
    FIVE,
)
add(
    "dsh15_risk_level_counts",
    lambda t: D.risk_level_counts(t.text_features),
    """SELECT risk_level, n, CASE risk_level WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 4 END AS position
       FROM (SELECT risk_level, count(*) AS n FROM text_features
         WHERE risk_level IN ('low', 'medium', 'high', 'critical') GROUP BY risk_level) c""",
)
add(
    "dsh16_latest_scored",
    lambda t: L.latest_scored(t.gold),
    "SELECT cik, period_end, altman_z_score, distress_zone FROM latest_z",
    Z,
)
AGAINST = ["cik", "accession", "company_name", "sentiment_score", "risk_level", "going_concern", "altman_z_score", "distress_zone"]
add(
    "dsh17_sentiment_against_z",
    lambda t: D.sentiment_against_z(t.text_features, t.gold).select(*AGAINST),
    """SELECT t.cik, accession, company_name, sentiment_score, risk_level, going_concern, altman_z_score, distress_zone
       FROM named t JOIN latest_z z ON CAST(t.cik AS BIGINT) = z.cik WHERE section = 'mda'""",
    Z,
)
add(
    "dsh18_mda_summaries",
    lambda t: D.mda_summaries(t.text_features, t.gold),
    """SELECT company_name, sentiment_label, risk_level, going_concern, distress_keywords, llm_summary, accession
       FROM named WHERE section = 'mda'""",
)
add(
    "dsh19_composite_kpis",
    lambda t: D.composite_kpis(t.composite),
    f"""SELECT count(DISTINCT cik) AS companies, avg(composite_score) AS mean_composite, {KPI.format('composite_zone')},
          count(*) FILTER (WHERE n_docs_analysed > 0) AS rows_with_text FROM composite""",
    {"mean_composite": 6, "distress_pct": 6},
)
add(
    "dsh20_composite_zone_shares",
    lambda t: D.composite_zone_shares(t.composite),
    """SELECT zone, n, printf('%s  %.1f%%', zone, CAST(n / sum(n) OVER () * 100 AS DOUBLE)) AS label
       FROM (SELECT composite_zone AS zone, count(*) AS n FROM composite WHERE composite_zone IS NOT NULL GROUP BY ALL) c""",
)
add(
    "dsh21_composite_histogram",
    lambda t: D.composite_histogram(t.composite),
    """SELECT least(60, CAST(floor(60.0 * (composite_score - 0.0) / 1.0) AS INTEGER) + 1) AS bin, count(*) AS n
       FROM composite WHERE composite_score IS NOT NULL GROUP BY ALL""",
)
SCATTER = ["company_name", "period_end", "altman_z_score", "composite_score", "composite_zone", *K.COMPOSITE_WEIGHTS]
add(
    "dsh22_composite_scatter",
    lambda t: D.composite_scatter(t.composite),
    f"SELECT {', '.join(SCATTER)} FROM composite WHERE composite_score IS NOT NULL AND altman_z_score IS NOT NULL",
    Z | {"composite_score": 8} | PARTS,
)
add(
    "dsh23_median_composite_over_time",
    lambda t: D.median_over_time(t.composite, "composite_score"),
    f"""SELECT period_end, {O.LONG_GROUP} AS company_type, median(composite_score) AS median_value
        FROM composite WHERE composite_score IS NOT NULL GROUP BY period_end, distress_label""",
    {"median_value": 6},
)
add("dsh24_top_composite_companies", lambda t: D.top_companies(t.composite, "composite_score"), "SELECT * FROM top_by_composite")
add(
    "dsh25_contributions",
    lambda t: D.contributions(t.composite, D.top_companies(t.composite, "composite_score", 5), digits=8),
    """SELECT company_name, cik, period_end, round(0.60 * z_component, 8) AS z_contribution,
         round(0.20 * llm_component, 8) AS llm_contribution, round(0.20 * trend_component, 8) AS trend_contribution
       FROM composite WHERE company_name IN (SELECT company_name FROM top_by_composite
         ORDER BY n_scored DESC, company_name LIMIT 5)""",
)
add(
    "dsh26_outcome_counts",
    lambda t: D.outcome_counts(t.composite),
    "SELECT after_emerging_class AS outcome, count(*) AS companies FROM distressed_names GROUP BY ALL",
)
DETAIL = ["company_name", "after_emerging_class", "composite_score", *K.COMPOSITE_WEIGHTS, "brd_disposition", "brd_after_emerging"]
add(
    "dsh27_outcome_detail",
    lambda t: D.outcome_detail(t.composite).select(*DETAIL),
    f"SELECT {', '.join(DETAIL)} FROM distressed_names",
    {"composite_score": 8} | PARTS,
)
add(
    "dsh28_raw_explorer",
    lambda t: D.raw_explorer(t.gold),
    f"SELECT {', '.join(K.EXPLORER_COLUMNS)} FROM gold",
    Z,
)



def _updated_gold(t: Inputs) -> DataFrame:
    """Silver arrives in three parts, the first with rows that later parts replace; gold follows each."""
    path = f"{scratch_path(t.spark, 'incremental-gold')}/{uuid.uuid4().hex}"
    rows = checkpointed(t.silver).withColumn("_part", F.pmod(F.xxhash64("cik", "period_end"), F.lit(3)))
    early = rows.where("_part = 2").withColumns({"assets_total": F.col("assets_total") * 2, "revenue": F.lit(None).cast("double")})
    for part in (rows.where("_part = 0").unionByName(early), rows.where("_part = 1"), rows.where("_part = 2")):
        IG.apply_silver(part.drop("_part"), t.universe, f"{path}/silver", f"{path}/gold", buckets=8)
    return KY.read_keyed(t.spark, f"{path}/gold")


add(
    "gld7_incremental_gold",
    lambda t: _updated_gold(t).select("cik", "period_end", "altman_z_score", "distress_label", *GROWTHS, "revenue_declining_3q", "net_income_declining_3q"),
    f"SELECT cik, period_end, altman_z_score, distress_label, {', '.join(GROWTHS)}, revenue_declining_3q, net_income_declining_3q FROM gold",
    Z,
)


def _bucketed_gold(t: Inputs) -> DataFrame:
    """Gold from silver that is stored in buckets by company: no exchange between the scan and the windows."""
    table = f"silver_buckets_{uuid.uuid4().hex[:12]}"
    WR.write_bucketed(t.silver, table, ["cik"], ["form_type", "period_end"], 8)
    return L.build_gold(t.spark.table(table), t.universe)


add(
    "gld7_gold_from_buckets",
    lambda t: _bucketed_gold(t).select("cik", "period_end", "altman_z_score", *GROWTHS),
    f"SELECT cik, period_end, altman_z_score, {', '.join(GROWTHS)} FROM gold",
    Z,
)

# ------------------------------------------------------------------------------------------ composite layer

add("cmp14_describe", lambda t: Q.describe(t.composite, "composite_score"), describe_sql("composite_score", "composite"), MOMENTS)
add(
    "cmp14_zone_counts",
    lambda t: G.zone_counts(t.composite, "composite_zone"),
    "SELECT composite_zone AS zone, count(*) AS n FROM composite WHERE composite_zone IS NOT NULL GROUP BY composite_zone",
)

# ---------------------------------------------------------------------------------------------- streaming


def _streamed(t: Inputs) -> DataFrame:
    """Half of the section texts arrive, are processed, the others arrive, are processed."""
    path = f"{scratch_path(t.spark, 'stream')}/{uuid.uuid4().hex}"
    texts = t.filing_text.select("object_name", F.col("text").cast("binary").alias("content"), "doc_id")
    for half in (0, 1):
        texts.where(F.col("doc_id") % 2 == half).drop("doc_id").write.mode("append").parquet(f"{path}/in")
        IN.incremental_features(t.spark, f"{path}/in", f"{path}/out", f"{path}/state", packed=True)
    return IN.current_features(t.spark, f"{path}/out")


add(
    "inc1_incremental_features",
    lambda t: _streamed(t).select(*ROW_CELLS),
    f"SELECT {', '.join(ROW_CELLS)} FROM text_rows",
)
