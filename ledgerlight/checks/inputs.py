"""Inputs of the engine's own shape, derived from whole given tables.

Each entry is SQL that Spark and DuckDB read alike, with table names in braces, so a query and its oracle
start from the same rows. A company is a supplier, a fact a line item, a filing an order or a document, a
filing's HTML a page. The given texts hold no distress vocabulary, so phrases are appended by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.operators import gold as G
from ledgerlight.plans import layers as L

FACTS = """
SELECT cik, company_name, period_end, fiscal_year, fiscal_period, form_type, filed_date, field,
  CASE field WHEN 'assets_total' THEN p * 4.0 WHEN 'assets_current' THEN p * 2.0
    WHEN 'liabilities_total' THEN p * 1.5 WHEN 'equity' THEN p * sgn * 1.5
    WHEN 'revenue' THEN p * 3.0 WHEN 'retained_earnings' THEN p * sgn
    WHEN 'net_income' THEN p * sgn * 0.5 WHEN 'operating_income' THEN p * sgn * 0.5
    WHEN 'interest_expense' THEN p * 0.25 ELSE p END AS value
FROM (SELECT l.l_suppkey AS cik, s.s_name AS company_name,
  last_day(CAST(date_trunc('quarter', l.l_shipdate) + INTERVAL 2 MONTH AS DATE)) AS period_end,
  CAST(year(l.l_shipdate) AS INT) AS fiscal_year,
  CASE WHEN quarter(l.l_shipdate) = 4 AND l.l_linestatus = 'F' THEN 'FY'
       ELSE concat('Q', CAST(quarter(l.l_shipdate) AS STRING)) END AS fiscal_period,
  CASE WHEN quarter(l.l_shipdate) = 4 AND l.l_linestatus = 'F' THEN '10-K' ELSE '10-Q' END AS form_type,
  CAST(l.l_shipdate AS DATE) AS filed_date,
  CASE (l.l_orderkey * 7 + l.l_linenumber) % 12 WHEN 0 THEN 'assets_total' WHEN 1 THEN 'assets_current'
   WHEN 2 THEN 'liabilities_total' WHEN 3 THEN 'liabilities_current' WHEN 4 THEN 'equity'
   WHEN 5 THEN 'retained_earnings' WHEN 6 THEN 'net_income' WHEN 7 THEN 'revenue'
   WHEN 8 THEN 'operating_income' WHEN 9 THEN 'interest_expense' WHEN 10 THEN 'cash'
   ELSE 'long_term_debt' END AS field,
  l.l_extendedprice AS p, CASE WHEN l.l_returnflag = 'R' THEN -1.0 ELSE 1.0 END AS sgn
 FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey) t
"""

# Facts before alias resolution: raw tags, bad dates, irrelevant and amended forms, missing values.
TAGGED = """
SELECT l_suppkey AS cik, concat('CIK', lpad(CAST(l_suppkey AS STRING), 10, '0'), '.json') AS file_key,
  CASE (l_orderkey + l_linenumber) % 5 WHEN 0 THEN 'Assets'
    WHEN 1 THEN CASE WHEN l_suppkey % 3 = 0 THEN 'SalesRevenueGoodsNet' ELSE 'Revenues' END
    WHEN 2 THEN 'SalesRevenueNet'
    WHEN 3 THEN CASE WHEN l_suppkey % 4 = 0 THEN 'MembersEquity' ELSE 'StockholdersEquity' END
    ELSE 'PartnersCapital' END AS tag,
  CASE WHEN l_linenumber = 7 AND l_partkey % 5 = 0 THEN 'bad-date'
    ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS end_str,
  CASE l_orderkey % 6 WHEN 0 THEN '10-K' WHEN 1 THEN '10-K/A' WHEN 2 THEN '8-K' WHEN 3 THEN '10-Q'
    WHEN 4 THEN '20-F' ELSE 'S-1' END AS form,
  CASE WHEN l_partkey % 11 = 0 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS filed_str,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_extendedprice END AS val
FROM {lineitem}
"""

# One facts document per line item, so that no company's rows have to be collected to make a document.
# Some documents are cut off, some hold no facts.
BLOBS = """
SELECT concat('edgar_company_facts/ingestion_date=2024-01-0', CAST(l_linenumber AS STRING), '/CIK',
    lpad(CAST(l_suppkey AS STRING), 10, '0'), '-', CAST(l_orderkey AS STRING), '.json') AS object_name,
  CASE WHEN l_linenumber = 7 AND l_partkey % 5 = 0 THEN concat(head, ifrs)
       WHEN l_partkey % 17 = 0 THEN concat(head, '{{}}}}')
       ELSE concat(head, '{{', ifrs, ', ', gaap, '}}}}') END AS raw
FROM (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
  concat('{{"cik": ', CAST(l_suppkey AS STRING),
    CASE WHEN l_partkey % 19 = 0 THEN '' ELSE concat(', "entityName": "Supplier ', CAST(l_suppkey AS STRING), '"') END,
    ', "facts": ') AS head,
  concat('"ifrs-full": {{"Assets": {{"units": {{"USD": [{{"end": "', day, '", "val": ', price, ', "fy": 1999, "fp": "FY", "form": "20-F", "filed": "', day, '"}}]}}}}, ',
    '"Revenues": {{"units": {{"USD": [{{"end": "', day, '", "val": ', price, ', "form": "', form, '", "filed": "not a date"}}]}}}}}}') AS ifrs,
  concat('"us-gaap": {{',
    CASE WHEN l_linenumber = 1 THEN '' ELSE concat('"Assets": {{"units": {{"USD": [{{"end": "', day, '", "val": ', qty, ', "fp": "Q1", "form": "10-Q", "filed": "', day, '"}}, {{"end": "',
      CASE WHEN l_linenumber = 3 THEN 'bad-date' ELSE day END, '", "val": ', price, ', "fp": "Q2", "form": "10-K/A"}}], "EUR": [{{"end": "', day, '", "val": 1, "form": "10-K"}}]}}}}, ') END,
    '"SalesRevenueNet": {{"label": "Net sales", "units": {{"USD": [{{"end": "', day, '", "val": ', CASE WHEN l_partkey % 13 = 0 THEN 'null'
      WHEN l_partkey % 23 = 0 THEN '"abc"' WHEN l_partkey % 29 = 0 THEN 'true' WHEN l_partkey % 31 = 0 THEN '"1d"'
      WHEN l_partkey % 37 = 0 THEN concat('"', qty, '"') ELSE qty END,
    ', "fp": "FY", "form": "10-K", "filed": "', day, '"}}]}}}}, ',
    '"InterestExpense": {{"units": {{"EUR": [{{"end": "', day, '", "val": 5, "form": "10-K"}}]}}}}}}') AS gaap
 FROM (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
   CAST(CAST(l_shipdate AS DATE) AS STRING) AS day, CAST(l_extendedprice AS STRING) AS price,
   CAST(l_quantity AS STRING) AS qty,
   CASE l_orderkey % 6 WHEN 0 THEN '10-K' WHEN 1 THEN '10-K/A' WHEN 2 THEN '8-K' WHEN 3 THEN '10-Q'
     WHEN 4 THEN '20-F' ELSE 'S-1' END AS form
  FROM {lineitem}) a) b
"""

# Companies with a negative balance are listed under another key, so that labels have misses.
UNIVERSE = """
SELECT lpad(CAST(CASE WHEN s_acctbal < 0 THEN s_suppkey + 7000000 ELSE s_suppkey END AS STRING), 10, '0') AS cik,
  s_name AS company_name,
  CASE WHEN s_acctbal < 2000 THEN '1' ELSE '0' END AS distress_label,
  CASE WHEN s_acctbal < 2000 THEN '2012-03-01' ELSE '' END AS distress_event_date,
  CASE WHEN s_acctbal < 2000 THEN 'chapter_11' ELSE '' END AS distress_event_type,
  CASE WHEN s_acctbal < 2000 THEN '11' ELSE '' END AS brd_chapter,
  CASE WHEN s_acctbal < 2000 THEN 'emerged' ELSE '' END AS brd_disposition,
  CASE WHEN s_suppkey % 5 = 0 THEN 'n/a' ELSE concat(CAST(s_suppkey * 7 AS STRING), '.5') END AS brd_days_in_bk,
  concat(CAST(2010 + s_suppkey % 10 AS STRING), '.0') AS brd_year_emerged,
  CASE s_suppkey % 7 WHEN 0 THEN 'Assets were liquidated after sale' WHEN 1 THEN 'Acquired by a rival'
    WHEN 2 THEN 'second time in bankruptcy' WHEN 3 THEN 'Still operating, independent' WHEN 4 THEN '   '
    WHEN 5 THEN 'no record' ELSE NULL END AS brd_after_emerging
FROM {supplier}
"""

CONSTITUENTS = """
SELECT concat('T', CAST(s_suppkey AS STRING), CASE WHEN s_suppkey % 4 = 0 THEN '.B' ELSE '' END) AS Symbol,
  s_name AS Security, s_suppkey AS CIK FROM {supplier}
"""

# Bankruptcy cases, all text as in the file; company keys overlap the constituents and repeat.
CASES = """
SELECT c_name AS NameCorp,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE concat(CAST(c_custkey % 400 AS STRING), '.0') END AS CikBefore,
  CASE WHEN c_custkey % 5 = 0 THEN '7' ELSE '11' END AS Chapter,
  CASE WHEN c_custkey % 17 = 0 THEN 'unknown'
    WHEN c_custkey % 13 = 0 THEN concat(CAST(c_custkey % 12 + 1 AS STRING), '/', CAST(c_custkey % 28 + 1 AS STRING), '/', CAST(10 + c_custkey % 12 AS STRING))
    WHEN c_custkey % 11 = 0 THEN concat(CAST(2000 + c_custkey % 22 AS STRING), '-0', CAST(c_custkey % 9 + 1 AS STRING), '-1', CAST(c_custkey % 10 AS STRING), ' 00:00:00')
    WHEN c_custkey % 10 = 0 THEN concat('Mar ', CAST(c_custkey % 28 + 1 AS STRING), ', ', CAST(2000 + c_custkey % 22 AS STRING))
    WHEN c_custkey % 7 = 0 THEN concat(CAST(c_custkey % 12 + 1 AS STRING), '-', CAST(c_custkey % 28 + 1 AS STRING), '-', CAST(2000 + c_custkey % 22 AS STRING))
    ELSE concat(CAST(c_custkey % 12 + 1 AS STRING), '/', CAST(c_custkey % 28 + 1 AS STRING), '/', CAST(2000 + c_custkey % 22 AS STRING),
      CASE WHEN c_custkey % 6 = 0 THEN ' 00:00' ELSE '' END) END AS DateFiled,
  CAST(2000 + c_custkey % 22 AS STRING) AS YearFiled,
  CASE WHEN c_custkey % 19 = 0 THEN 'NA' ELSE CAST((c_custkey * 37) % 3000 AS STRING) END AS AssetsBefore,
  concat(CAST((c_custkey * 11) % 900 AS STRING), '.25') AS SalesBefore,
  CASE c_custkey % 8 WHEN 0 THEN 'Plan Confirmed' WHEN 1 THEN 'Converted to Chapter 7' WHEN 2 THEN 'converted'
    WHEN 3 THEN ' Dismissed ' WHEN 4 THEN '363 sale' WHEN 5 THEN 'Pending' WHEN 6 THEN NULL ELSE 'n/a' END AS Disposition,
  CASE c_custkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN ' YES' ELSE 'no' END AS Emerge,
  CAST(c_custkey % 700 AS STRING) AS DaysIn,
  CASE c_custkey % 4 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'no' WHEN 2 THEN NULL ELSE 'refiled' END AS Refile,
  CASE c_custkey % 2 WHEN 0 THEN 'yes' ELSE 'not applicable' END AS DipLoan,
  CASE c_custkey % 5 WHEN 0 THEN '1' ELSE 'no' END AS Sale363,
  CASE c_custkey % 3 WHEN 0 THEN 'prenegotiated' WHEN 1 THEN 'prepackaged' ELSE 'free fall' END AS Prepackaged,
  CASE c_custkey % 6 WHEN 0 THEN 'involuntary' ELSE 'Voluntary' END AS Voluntary,
  CASE c_custkey % 3 WHEN 0 THEN 'replaced' ELSE 'noreplace' END AS CeoReplaced,
  concat(' ', c_mktsegment, ' ') AS SICDescription,
  CASE c_custkey % 4 WHEN 0 THEN 'second time in bankruptcy' WHEN 1 THEN NULL ELSE 'merged' END AS AfterEmerging,
  CASE c_custkey % 4 WHEN 0 THEN '2/30/2015' WHEN 1 THEN NULL ELSE '3/5/2016' END AS DateEmerging
FROM {customer}
"""

# One submissions document per order with five filings; some documents have one document name too few.
SUBMISSIONS = """
SELECT o_orderkey AS doc, concat('{{"cik": "', CAST(o_custkey AS STRING), '", "filings": {{"recent": {{"form": ["', f0, '", "', f1,
    '", "', f2, '", "', f3, '", "', f4, '"], "accessionNumber": ["', acc, '0", "', acc, '1", "', acc, '2", "', acc, '3", "', acc,
    '4"], "filingDate": ["', day, '", "', day, '", "', day, '", "', day, '", "', day, '"], "primaryDocument": ["a.htm", "b.htm", "c.txt", "d.htm"',
    CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE ', "e.htm"' END, ']}}}}}}') AS raw
FROM (SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
  concat(lpad(CAST(o_custkey AS STRING), 10, '0'), '-20-', lpad(CAST(o_orderkey % 100000 AS STRING), 5, '0')) AS acc,
  CASE o_orderkey % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-K/A' ELSE '10-Q' END AS f0,
  CASE o_orderkey % 5 WHEN 0 THEN '20-F' WHEN 1 THEN '8-K' ELSE '10-K' END AS f1,
  CASE o_orderkey % 7 WHEN 0 THEN '40-F' ELSE '10-K' END AS f2,
  '10-K' AS f3, '40-F' AS f4
 FROM {orders}) t
"""

FILINGS = """
SELECT o_custkey AS cik,
  CASE o_orderkey % 6 WHEN 0 THEN '10-K' WHEN 1 THEN '10-K/A' WHEN 2 THEN '10-Q' WHEN 3 THEN '20-F'
    WHEN 4 THEN '8-K' ELSE '40-F' END AS form,
  concat(lpad(CAST(o_custkey AS STRING), 10, '0'), '-20-', lpad(CAST(o_orderkey % 1000000 AS STRING), 6, '0')) AS accession,
  CAST(o_orderdate AS DATE) AS filing_date,
  concat('doc', CAST(o_orderkey AS STRING), CASE WHEN o_orderkey % 5 = 0 THEN '.txt' ELSE '.htm' END) AS primary_document
FROM {orders}
"""

# Filing pages; the first heading also appears in a contents line.
FILING_HTML = """
SELECT page_id, page_id % 100 AS cik,
  concat('<p>Contents: Item 1. Business</p>', html,
    '<h2>Item 1. Business</h2><p>We sell &amp;lt;things&amp;gt; here  and   there in many of the usual markets.</p>',
    CASE WHEN page_id % 3 <> 0 THEN '<h2>Item&nbsp;1A. Risk Factors</h2><p>Covenant waiver and liquidity risk may affect us in the coming years.</p><b>Item 1B.</b>' ELSE '' END,
    CASE WHEN page_id % 4 <> 0 THEN '<h2>ITEM 7. Management and its Discussion</h2><p>Revenue fell; substantial doubt about going concern remains with us.</p>' ELSE '' END,
    CASE WHEN page_id % 5 <> 0 THEN '<h2>Item 8. Financial Statements</h2>' ELSE '' END) AS html
FROM {pages}
"""

FILING_TEXT = """
SELECT doc_id,
  concat('edgar_filings_text/ingestion_date=2024-01-0', CAST(doc_id % 9 + 1 AS STRING), '/CIK',
    lpad(CAST((doc_id % 50) * 2 AS STRING), 10, '0'), '_', lpad(CAST(doc_id AS STRING), 18, '0'), '_',
    CASE doc_id % 4 WHEN 0 THEN 'mda' WHEN 1 THEN 'risk' WHEN 2 THEN 'business' ELSE 'notes' END, '.txt') AS object_name,
  CASE WHEN doc_id % 23 = 0 THEN '   ' ELSE concat(text, CASE doc_id % 8
    WHEN 0 THEN ' Substantial doubt about our ability to continue as a Going Concern.'
    WHEN 1 THEN ' A covenant violation led to a waiver; liquidity risk is high, with default and default again.'
    WHEN 2 THEN ' Restructuring and layoffs continue after an asset sale.'
    WHEN 3 THEN ' Tariffs were clarified.'
    WHEN 4 THEN ' Record revenue and strong growth; robust demand.'
    WHEN 5 THEN ' Impairment, write-off and write-down; chapter 11 and chapter 7.'
    ELSE '' END) END AS text
FROM {documents}
"""

# Raw answers of a scorer: clean, wrapped in prose, broken, without a score, not an object.
RESPONSES = """
SELECT doc_id, section, CASE doc_id % 11 WHEN 7 THEN 'no json here' WHEN 8 THEN '{{"sentiment_score": null}}'
    WHEN 9 THEN concat('Sure! ', body, ' Hope this helps.') WHEN 10 THEN '[1, 2]' ELSE body END AS raw
FROM (SELECT doc_id,
  CASE doc_id % 4 WHEN 0 THEN 'mda' WHEN 1 THEN 'risk' WHEN 2 THEN 'business' ELSE 'notes' END AS section,
  concat('{{"sentiment_score": ', CASE WHEN doc_id % 31 < 15 THEN '-' ELSE '' END,
    CAST(CAST(floor(abs(doc_id % 31 - 15) / 10) AS INT) AS STRING), '.', CAST(abs(doc_id % 31 - 15) % 10 AS STRING),
    CASE WHEN doc_id % 5 = 0 THEN ', "sentiment_label": "neutral"' ELSE '' END,
    ', "liquidity_signal": "', CASE doc_id % 5 WHEN 0 THEN ' Critical ' WHEN 1 THEN 'STRESSED' WHEN 2 THEN 'strong'
      WHEN 3 THEN 'odd' ELSE 'adequate' END,
    '", "risk_level": "', CASE doc_id % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'low' ELSE 'severe' END,
    '", "business_model_viability": "', CASE doc_id % 3 WHEN 0 THEN 'fragile' WHEN 1 THEN 'strong' ELSE 'unknown' END,
    '", "going_concern_explicit": ', CASE doc_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN '"Yes"' WHEN 2 THEN '0' ELSE '"no"' END,
    ', "debt_maturity_risk": ', CASE doc_id % 3 WHEN 0 THEN '1' WHEN 1 THEN 'false' ELSE 'null' END,
    ', "regulatory_dependency": ', CASE doc_id % 3 WHEN 0 THEN '"YES"' WHEN 1 THEN '2' ELSE '1.5' END,
    ', "summary": "doc ', CAST(doc_id AS STRING), '"}}') AS body
 FROM {documents}) t
"""

TEXT_FEATURES = """
SELECT CAST((d.doc_id % 50) * 2 AS STRING) AS cik, lpad(CAST(d.doc_id AS STRING), 18, '0') AS accession,
  CASE d.doc_id % 3 WHEN 0 THEN 'mda' WHEN 1 THEN 'risk' ELSE 'business' END AS section,
  CASE WHEN d.doc_id % 50 = 25 THEN NULL ELSE CAST((d.doc_id * 37) % 201 - 100 AS DOUBLE) / 100 END AS sentiment_score,
  CASE d.doc_id % 6 WHEN 0 THEN 'low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'high' WHEN 3 THEN 'critical'
    WHEN 4 THEN 'odd' ELSE NULL END AS risk_level,
  coalesce(l.toxic, 0) AS going_concern, CASE WHEN d.doc_id % 7 = 0 THEN 1 ELSE 0 END AS going_concern_explicit,
  CASE WHEN d.doc_id % 2 = 0 THEN 1 ELSE 0 END AS liquidity_risk,
  CASE WHEN d.doc_id % 9 = 0 THEN 1 ELSE 0 END AS covenant_breach_mentioned,
  l.quality AS restructuring, d.n_chars AS text_length,
  CASE d.doc_id % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS sentiment_label,
  CAST(d.doc_id % 12 AS INT) AS distress_keywords, concat('about ', d.source) AS llm_summary,
  CASE WHEN d.doc_id % 4 = 0 THEN 'skipped' ELSE 'answered' END AS llm_raw
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

INPUTS = {
    "facts": (FACTS, ["lineitem", "supplier"]),
    "tagged": (TAGGED, ["lineitem"]),
    "blobs": (BLOBS, ["lineitem"]),
    "universe": (UNIVERSE, ["supplier"]),
    "constituents": (CONSTITUENTS, ["supplier"]),
    "cases": (CASES, ["customer"]),
    "submissions": (SUBMISSIONS, ["orders"]),
    "filings": (FILINGS, ["orders"]),
    "filing_html": (FILING_HTML, ["pages"]),
    "filing_text": (FILING_TEXT, ["documents"]),
    "responses": (RESPONSES, ["documents"]),
    "text_features": (TEXT_FEATURES, ["documents", "labels"]),
}


# A test file of one row group is one task. A session that wants its cores busy anyway (the bench) names a number of
# partitions for these inputs; nothing chooses it by size or cores.
PARTITIONS = "spark.ledgerlight.inputPartitions"
LARGE = ("lineitem", "orders", "documents", "pages")
# Without such a number the rows of these inputs are dealt out by columns before anything is made of them: a document takes many
# times as long to make and parse as its row takes to move, and a scan's tasks follow bytes and row groups.
DEALT = {"blobs": ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")}


def portable_sql(name: str) -> str:
    """An input as SQL over the plain table names."""
    text, tables = INPUTS[name]
    return text.format(**{table: table for table in tables}).strip()


class Inputs:
    """The inputs and the layers built from them, as lazy DataFrames of one session and data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        scan = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        wanted = self.spark.conf.get(PARTITIONS, None)
        return scan.repartition(int(wanted)) if wanted and name in LARGE else scan

    def __getattr__(self, name: str) -> DataFrame:
        if name not in INPUTS:
            raise AttributeError(name)
        text, tables = INPUTS[name]
        rows = {table: self.table(table) for table in tables}
        if name in DEALT and not self.spark.conf.get(PARTITIONS, None):
            tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))  # a number keeps adaptive execution from merging them by size
            rows = {table: df.repartition(tasks, *DEALT[name]) for table, df in rows.items()}
        return self.spark.sql(text, **rows)

    @property
    def silver(self) -> DataFrame:
        return L.build_silver(self.facts)

    @property
    def base(self) -> DataFrame:
        return G.join_labels(self.silver, G.universe_labels(self.universe))

    @property
    def gold(self) -> DataFrame:
        return L.build_gold(self.silver, self.universe)

    @property
    def composite(self) -> DataFrame:
        return L.build_composite(self.gold, self.text_features)

    @property
    def case_rows(self) -> DataFrame:
        from ledgerlight.operators.universe import enrich_cases, filter_cases

        return enrich_cases(filter_cases(self.cases))

    @property
    def universe_built(self) -> DataFrame:
        return L.build_universe(self.constituents, self.cases)
