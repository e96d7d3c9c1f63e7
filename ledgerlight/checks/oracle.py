"""Oracle SQL: each operator restated for DuckDB as a chain of common table expressions.

The steps are written from the operators' definitions, one step at a time and without the shortcuts the
Spark plans take (fused aggregation, sketch-bounded quantiles, array functions).
"""

from __future__ import annotations

import re

from ledgerlight import constants as K
from ledgerlight.checks.inputs import INPUTS, portable_sql

STEPS: dict[str, str] = {name: portable_sql(name) for name in INPUTS}


def oracle(select: str) -> str:
    """``select`` with the steps it names, directly or through other steps, in front of it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                visit(STEPS[name])
                needed.append(name)

    visit(select)
    steps = ",\n".join(f"{name} AS (\n{STEPS[name]}\n)" for name in needed)
    return f"WITH {steps}\n{select}" if steps else select


def rounded(select: str, digits: dict[str, int]) -> str:
    cells = ", ".join(f"round({name}, {n}) AS {name}" for name, n in digits.items())
    return f"SELECT * REPLACE ({cells}) FROM (\n{select}\n) AS unrounded"


def one_of(values: list[str] | tuple[str, ...]) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


# ------------------------------------------------------------------------------------------------ facts

FORM_OK = " OR ".join(f"starts_with(form, '{prefix}')" for prefix in K.FORM_PREFIXES)

STEPS["blob_entries"] = f"""
SELECT * FROM (
  SELECT object_name, cik, name, tag, end_str, val, fp, form, filed_str FROM (
    SELECT concat('edgar_company_facts/ingestion_date=2024-01-0', CAST(l_linenumber AS STRING), '/CIK',
        lpad(CAST(l_suppkey AS STRING), 10, '0'), '-', CAST(l_orderkey AS STRING), '.json') AS object_name,
      l_suppkey AS cik, l_linenumber AS ln, l_partkey AS pk, l_quantity AS qty, l_extendedprice AS price,
      CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE concat('Supplier ', CAST(l_suppkey AS STRING)) END AS name,
      CAST(CAST(l_shipdate AS DATE) AS STRING) AS day,
      CASE l_orderkey % 6 WHEN 0 THEN '10-K' WHEN 1 THEN '10-K/A' WHEN 2 THEN '8-K' WHEN 3 THEN '10-Q'
        WHEN 4 THEN '20-F' ELSE 'S-1' END AS order_form
    FROM lineitem WHERE NOT (l_linenumber = 7 AND l_partkey % 5 = 0) AND l_partkey % 17 <> 0) li
  CROSS JOIN LATERAL (VALUES
    ('Assets', 'gaap', day, qty, 'Q1', '10-Q', day),
    ('Assets', 'gaap', CASE WHEN ln = 3 THEN 'bad-date' ELSE day END, price, 'Q2', '10-K/A', NULL),
    ('Assets', 'ifrs', day, price, 'FY', '20-F', day),
    ('Revenues', 'ifrs', day, price, NULL, order_form, 'not a date'),
    ('SalesRevenueNet', 'gaap', day, CASE WHEN pk % 13 = 0 OR pk % 23 = 0 THEN NULL WHEN pk % 29 = 0 THEN 1.0
      WHEN pk % 31 = 0 THEN NULL ELSE qty END, 'FY', '10-K', day)
  ) e(tag, ns, end_str, val, fp, form, filed_str)
  WHERE tag <> 'Assets' OR (ns = 'gaap') = (ln <> 1)) q
"""

STEPS["aliases"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{field}', '{tag}', {priority})"
    for field, tags in K.TAG_ALIASES.items() for priority, tag in enumerate(tags)
) + ") AS a(field, tag, priority)"

STEPS["blob_usable"] = f"""
SELECT e.*, a.field, a.priority FROM blob_entries e JOIN aliases a ON e.tag = a.tag
WHERE ({FORM_OK}) AND TRY_CAST(end_str AS DATE) IS NOT NULL AND val IS NOT NULL
"""

STEPS["flattened"] = """
SELECT u.cik, coalesce(u.name, 'Unknown') AS company_name, TRY_CAST(u.end_str AS DATE) AS period_end,
  CAST(year(TRY_CAST(u.end_str AS DATE)) AS INTEGER) AS fiscal_year, coalesce(u.fp, '') AS fiscal_period,
  u.form AS form_type, TRY_CAST(u.filed_str AS DATE) AS filed_date, u.field, u.val AS value
FROM blob_usable u
JOIN (SELECT object_name, field, min(priority) AS best FROM blob_usable GROUP BY object_name, field) b
  ON u.object_name = b.object_name AND u.field = b.field AND u.priority = b.best
"""

# ----------------------------------------------------------------------------------------------- silver

LATEST = "filed_date DESC NULLS LAST, form_type, fiscal_period, value DESC, company_name, fiscal_year"
RANK = (
    "CASE fiscal_period "
    + " ".join(f"WHEN '{period}' THEN {rank}" for period, rank in K.PERIOD_RANK.items())
    + f" ELSE {K.UNRANKED_PERIOD} END"
)

STEPS["survivors"] = f"""
SELECT * EXCLUDE (pos) FROM (
  SELECT *, row_number() OVER (PARTITION BY cik, period_end, field ORDER BY {LATEST}) AS pos FROM facts) q
WHERE pos = 1
"""
STEPS["pivoted"] = (
    "SELECT cik, period_end, "
    + ", ".join(f"max(value) FILTER (WHERE field = '{name}') AS {name}" for name in K.FACT_FIELDS)
    + " FROM survivors GROUP BY cik, period_end"
)
STEPS["meta"] = f"""
SELECT * EXCLUDE (pos) FROM (
  SELECT cik, company_name, period_end, fiscal_year, fiscal_period, form_type, filed_date,
    row_number() OVER (PARTITION BY cik, period_end ORDER BY {RANK}, filed_date DESC NULLS LAST, form_type,
      fiscal_period, company_name, fiscal_year) AS pos
  FROM survivors) q
WHERE pos = 1
"""
STEPS["silver"] = """
SELECT p.*, m.* EXCLUDE (cik, period_end),
  CASE WHEN operating_income IS NOT NULL THEN operating_income
       WHEN coalesce(net_income, interest_expense) IS NOT NULL
       THEN coalesce(net_income, 0) + coalesce(interest_expense, 0) END AS ebit,
  assets_current - liabilities_current AS working_capital
FROM pivoted p JOIN meta m ON p.cik = m.cik AND p.period_end = m.period_end
"""

# ------------------------------------------------------------------------------------------------- gold

GIVEN = {"brd_chapter", "brd_disposition", "brd_days_in_bk", "brd_year_emerged", "brd_after_emerging"}


def _typed(name: str, kind: str) -> str:
    sql = {"int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}[kind]
    if name not in GIVEN:
        return f"CAST(NULL AS {sql}) AS {name}"
    if kind == "int":
        return f"CAST(round(TRY_CAST({name} AS DOUBLE)) AS INTEGER) AS {name}"
    return f"TRY_CAST({name} AS {sql}) AS {name}"


STEPS["labels_typed"] = (
    "SELECT lpad(cik, 10, '0') AS cik, TRY_CAST(distress_label AS INTEGER) AS distress_label, "
    "distress_event_date, distress_event_type, "
    + ", ".join(_typed(name, kind) for name, kind in K.ENRICHMENT_TYPES.items())
    + " FROM universe"
)
STEPS["base"] = """
SELECT s.*, coalesce(u.distress_label, 0) AS distress_label, u.* EXCLUDE (cik, distress_label)
FROM silver s LEFT JOIN labels_typed u ON s.cik = CAST(u.cik AS BIGINT)
WHERE s.assets_total > 0
"""
STEPS["ratios"] = """
SELECT *, working_capital / assets_total AS x1_wc_to_assets, retained_earnings / assets_total AS x2_re_to_assets,
  ebit / assets_total AS x3_ebit_to_assets,
  CASE WHEN liabilities_total > 0 THEN equity / liabilities_total END AS x4_equity_to_liab,
  revenue / assets_total AS x5_rev_to_assets
FROM base
"""
STEPS["scored"] = """
SELECT *, CASE WHEN z < 1.23 THEN 'distress' WHEN z <= 2.90 THEN 'grey' WHEN z > 2.90 THEN 'safe' END AS distress_zone,
  z AS altman_z_score
FROM (
  SELECT *, CASE WHEN raw_z > 20 THEN 20.0 WHEN raw_z < -20 THEN -20.0 ELSE raw_z END AS z
  FROM (SELECT *, CASE WHEN fiscal_period = 'FY' THEN
      0.717 * x1_wc_to_assets + 0.847 * x2_re_to_assets + 3.107 * x3_ebit_to_assets
      + 0.420 * x4_equity_to_liab + 0.998 * x5_rev_to_assets END AS raw_z
    FROM ratios) a) b
"""
_LAGS = ", ".join(
    f"lag({name}, {i}) OVER w AS {name}_{i}" for name in ("revenue", "net_income") for i in (1, 2, 3)
)
STEPS["gold"] = f"""
SELECT * EXCLUDE (revenue_1, revenue_2, revenue_3, net_income_1, net_income_2, net_income_3, z, raw_z),
  revenue_1 AS prev_revenue, net_income_1 AS prev_net_income,
  CASE WHEN revenue_1 > 0 THEN (revenue - revenue_1) / revenue_1 END AS revenue_growth_qoq,
  CASE WHEN net_income_1 <> 0 THEN (net_income - net_income_1) / abs(net_income_1) END AS net_income_growth_qoq,
  CASE WHEN prev_assets > 0 THEN (assets_total - prev_assets) / prev_assets END AS asset_growth_qoq,
  CASE WHEN revenue < revenue_1 AND revenue_1 < revenue_2 AND revenue_2 < revenue_3 THEN 1 ELSE 0 END
    AS revenue_declining_3q,
  CASE WHEN net_income < net_income_1 AND net_income_1 < net_income_2 AND net_income_2 < net_income_3
    THEN 1 ELSE 0 END AS net_income_declining_3q
FROM (SELECT *, {_LAGS}, lag(assets_total) OVER w AS prev_assets, lag(equity) OVER w AS prev_equity
  FROM scored WINDOW w AS (PARTITION BY cik, form_type ORDER BY period_end)) t
"""

# ------------------------------------------------------------------------------------------------- text

def strip_sql(text: str) -> str:
    return f"regexp_replace({text}, '^[{K.WS}]+|[{K.WS}]+$', '', 'g')"


_CLEAN = "regexp_replace(html, '<[^>]+>', ' ', 'g')"
for _entity, _plain in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
    _CLEAN = f"replace({_CLEAN}, '{_entity}', '{_plain}')"
_CLEAN = strip_sql(f"regexp_replace({_CLEAN}, '[{K.WS}]{{2,}}', ' ', 'g')")
STEPS["pages_clean"] = f"SELECT page_id, cik, {_CLEAN} AS text FROM filing_html"
STEPS["raw_pages_clean"] = f"SELECT page_id, {_CLEAN} AS text FROM pages"


def section_sql(section: str, source: str = "pages_clean") -> str:
    tails = " ".join(
        f"WHEN regexp_matches(text, '(?i){p}') THEN regexp_extract(text, '(?is){p}.*')"
        for p in K.SECTION_STARTS[section]
    )
    bodies = " ".join(
        f"WHEN regexp_matches(rest, '(?i){p}') THEN regexp_extract(rest, '(?is)^(.*?)(?:{p})', 1)"
        for p in K.SECTION_ENDS[section]
    )
    body = f"concat(heading, CASE {bodies} ELSE rest END)"
    return f"""
SELECT page_id, cik, '{section}' AS section, CASE WHEN tail IS NOT NULL THEN {strip_sql(body)} END AS section_text
FROM (SELECT *, substr(tail, 1, 50) AS heading, substr(tail, 51) AS rest
  FROM (SELECT page_id, cik, CASE {tails} END AS tail FROM {source}) a) b
"""


STEPS["page_sections"] = " UNION ALL ".join(section_sql(section) for section in K.SECTIONS)

STEPS["parsed_names"] = """
SELECT doc_id, object_name, text,
  CASE WHEN ltrim(ltrim(p[1], 'CIK'), '0') = '' THEN '0' ELSE ltrim(ltrim(p[1], 'CIK'), '0') END AS cik,
  coalesce(p[2], '') AS accession, coalesce(p[3], '') AS section,
  regexp_extract(object_name, 'ingestion_date=([0-9]{4}-[0-9]{2}-[0-9]{2})', 1) AS ingestion_date
FROM (SELECT *, string_split(replace(regexp_extract(object_name, '[^/]*$'), '.txt', ''), '_') AS p
  FROM filing_text) t
"""


def terms_sql(terms: list[str]) -> str:
    return " + ".join(f"CAST(contains(lower(text), '{term}') AS INTEGER)" for term in terms)


def any_sql(terms: list[str]) -> str:
    return "CAST(" + " OR ".join(f"contains(lower(text), '{term}')" for term in terms) + " AS INTEGER)"


STEPS["text_rows"] = f"""
SELECT cik, accession, section, ingestion_date, CAST(length(text) AS INTEGER) AS text_length,
  {terms_sql(K.DISTRESS_TERMS)} AS distress_keywords, {terms_sql(K.POSITIVE_TERMS)} AS positive_keywords,
  {", ".join(f"{any_sql(terms)} AS {name}" for name, terms in K.FLAG_TERMS.items())}
FROM parsed_names
WHERE section IN ({one_of(K.SECTIONS)}) AND length({strip_sql("text")}) > 0
"""

STEPS["recovered"] = r"""
SELECT doc_id, section, raw, CASE WHEN json_valid(raw) THEN raw
    WHEN json_valid(nullif(regexp_extract(raw, '(?s)\{.*\}'), '')) THEN regexp_extract(raw, '(?s)\{.*\}')
    ELSE '{}' END AS j
FROM responses
"""


def get(name: str) -> str:
    return f"json_extract_string(j, '$.{name}')"


def bool_sql(name: str) -> str:
    kind = f"coalesce(json_type(j, '$.{name}'), 'NONE')"
    return (
        f"CASE WHEN {kind} = 'BOOLEAN' THEN CAST({get(name)} = 'true' AS INTEGER) "
        f"WHEN {kind} IN ('UBIGINT', 'BIGINT') THEN CAST({get(name)} <> '0' AS INTEGER) "
        f"WHEN {kind} = 'VARCHAR' THEN CAST(lower({get(name)}) IN ('true', 'yes', '1') AS INTEGER) ELSE 0 END"
    )


def enum_sql(name: str, choices: list[str], default: str) -> str:
    text = f"trim(lower({get(name)}))"
    return f"CASE WHEN {text} IN ({one_of(choices)}) THEN {text} ELSE '{default}' END"


def spoken_sql(name: str, default: str) -> str:
    return (
        f"CASE coalesce(json_type(j, '$.{name}'), 'NONE') WHEN 'NONE' THEN '{default}' "
        f"WHEN 'NULL' THEN 'None' ELSE {get(name)} END"
    )


def derived_sql(section: str) -> str:
    name, levels = K.DERIVED_RISK[section]
    cases = " ".join(f"WHEN '{word}' THEN '{level}'" for word, level in levels.items())
    return f"CASE lower({get(name)}) {cases} ELSE 'medium' END"


def section_columns_sql(section: str) -> dict[str, str]:
    if section not in K.SECTIONS:
        return {"risk_level": enum_sql("risk_level", K.RISK_LEVELS, "medium")}
    found = {n: enum_sql(n, choices, default) for n, (choices, default) in K.RESPONSE_ENUMS[section].items()}
    found |= {n: bool_sql(n) for n in K.RESPONSE_FLAGS[section]}
    if section in K.DERIVED_RISK:
        found["risk_level"] = derived_sql(section)
    if section == "business":
        found["key_vulnerability"] = spoken_sql("key_vulnerability", "none identified")
    return found


STEPS["judged"] = """
SELECT *, CASE WHEN json_type(j) <> 'OBJECT' THEN 'response is not a JSON object'
    WHEN score IS NULL THEN 'sentiment_score is not a number' END AS problem
FROM (SELECT *, CASE WHEN json_type(j) <> 'OBJECT' THEN NULL
    WHEN json_type(j, '$.sentiment_score') IS NULL THEN 0.0
    ELSE TRY_CAST(json_extract_string(j, '$.sentiment_score') AS DOUBLE) END AS score FROM recovered) t
"""


def response_columns_sql() -> str:
    cells = [
        "CASE WHEN problem IS NULL THEN greatest(-1.0, least(1.0, score)) ELSE 0.0 END AS sentiment_score",
        f"""CASE WHEN problem IS NOT NULL THEN 'neutral'
          WHEN {get('sentiment_label')} IN ({one_of(K.SENTIMENT_LABELS)}) THEN {get('sentiment_label')}
          WHEN score <= -0.2 THEN 'negative' WHEN score >= 0.2 THEN 'positive' ELSE 'neutral' END AS sentiment_label""",
        "CASE WHEN problem IS NULL THEN "
        f"{spoken_sql('key_distress_signal', 'none detected')} ELSE '' END AS key_distress_signal",
        f"CASE WHEN problem IS NULL THEN {spoken_sql('summary', '')} ELSE '' END AS llm_summary",
        "CASE WHEN problem IS NULL THEN raw ELSE problem END AS llm_raw",
    ]
    per_section = {s: section_columns_sql(s) for s in [*K.SECTIONS, "other"]}
    names = dict.fromkeys(name for columns in per_section.values() for name in columns)
    for name in names:
        whens = " ".join(
            f"WHEN section = '{s}' THEN {columns[name]}"
            for s, columns in per_section.items() if s != "other" and name in columns
        )
        if name == "risk_level":
            cells.append(
                f"CASE WHEN problem IS NOT NULL THEN 'medium' {whens} ELSE {per_section['other'][name]} END AS risk_level"
            )
        else:
            cells.append(f"CASE WHEN problem IS NOT NULL THEN NULL {whens} END AS {name}")
    return ", ".join(cells)


STEPS["answered"] = f"SELECT doc_id, section, {response_columns_sql()} FROM judged"

# -------------------------------------------------------------------------------------------- composite

# Weights are written as doubles (0.40e0): the scores are defined in double arithmetic and zones compare them
# unrounded, while a plain 0.40 is an exact decimal in DuckDB.
STEPS["doc_signals"] = """
SELECT *, (1 - greatest(-1.0, least(1.0, sentiment_score))) / 2 AS sent_distress_raw,
  CASE lower(risk_level) WHEN 'low' THEN 0 WHEN 'medium' THEN 33 WHEN 'high' THEN 67 WHEN 'critical' THEN 100
    ELSE 33 END AS risk_points,
  least(1e0, 0.35e0 * least(coalesce(going_concern, 0), 1) + 0.25e0 * least(coalesce(going_concern_explicit, 0), 1)
    + 0.20e0 * least(coalesce(liquidity_risk, 0), 1) + 0.10e0 * least(coalesce(covenant_breach_mentioned, 0), 1)
    + 0.10e0 * least(coalesce(restructuring, 0), 1)) AS flag_score
FROM text_features
"""
STEPS["signals"] = """
SELECT *, CASE WHEN part < 0 THEN 0.0 WHEN part > 1 THEN 1.0 ELSE part END AS llm_component,
  CASE WHEN mean_risk < 0.2 THEN 'low' WHEN mean_risk < 0.5 THEN 'medium' WHEN mean_risk < 0.85 THEN 'high'
    ELSE 'critical' END AS avg_risk_level
FROM (
  SELECT *, 0.40 * mean_distress + 0.30 * mean_risk + 0.30 * max_flag AS part
  FROM (
    SELECT CAST(cik AS BIGINT) AS cik,
      avg(CASE WHEN sentiment_score IS NOT NULL THEN sent_distress_raw END) AS mean_distress,
      CAST(sum(risk_points) AS DOUBLE) / 100 / count(*) AS mean_risk, CAST(max(flag_score) AS DOUBLE) AS max_flag,
      avg(sentiment_score) AS avg_sentiment_score, max(coalesce(going_concern, 0)) AS any_going_concern,
      max(coalesce(liquidity_risk, 0)) AS any_liquidity_risk, max(coalesce(restructuring, 0)) AS any_restructuring,
      count(*) AS n_docs_analysed
    FROM doc_signals GROUP BY CAST(cik AS BIGINT)) a) b
"""
STEPS["components"] = """
SELECT *, CASE WHEN altman_z_score IS NULL THEN 0.5 WHEN altman_z_score <= 0 THEN 1.0
    WHEN altman_z_score >= 5 THEN 0.0 ELSE 1 - altman_z_score / 5 END AS z_component,
  0.40e0 * revenue_declining_3q + 0.30e0 * net_income_declining_3q
    + 0.20e0 * CASE WHEN revenue_growth_qoq < -0.10 THEN 1 ELSE 0 END
    + 0.10e0 * CASE WHEN net_income_growth_qoq < -0.15 THEN 1 ELSE 0 END AS trend_component
FROM gold
"""
OUTCOME_SQL = (
    "CASE " + " ".join(
        f"WHEN regexp_matches(lower(brd_after_emerging), '{pattern}') THEN '{label}'"
        for label, pattern in K.OUTCOME_PATTERNS
    ) + " ELSE 'unknown' END"
)
STEPS["composite"] = f"""
SELECT *, CASE WHEN composite_score > 0.60 THEN 'distress' WHEN composite_score < 0.35 THEN 'safe' ELSE 'grey' END
    AS composite_zone, {OUTCOME_SQL} AS after_emerging_class
FROM (
  SELECT *, least(1.0, 0.60 * z_component + 0.20 * llm_component + 0.20 * trend_component) AS composite_score
  FROM (
    SELECT g.*, coalesce(s.llm_component, 0.5) AS llm_component, coalesce(s.avg_sentiment_score, 0.0) AS avg_sentiment_score,
      coalesce(s.avg_risk_level, 'unknown') AS avg_risk_level,
      CAST(coalesce(s.any_going_concern, 0) AS INTEGER) AS any_going_concern,
      CAST(coalesce(s.any_liquidity_risk, 0) AS INTEGER) AS any_liquidity_risk,
      CAST(coalesce(s.any_restructuring, 0) AS INTEGER) AS any_restructuring,
      CAST(coalesce(s.n_docs_analysed, 0) AS INTEGER) AS n_docs_analysed
    FROM components g LEFT JOIN signals s ON g.cik = s.cik) a) b
"""

# --------------------------------------------------------------------------------------------- universe


def number_sql(name: str) -> str:
    return f'TRY_CAST("{name}" AS DOUBLE)'


def us_date_sql(name: str) -> str:
    formats = ["%m/%d/%y", "%m/%d/%Y", "%m/%d/%Y %H:%M", "%Y-%m-%d %H:%M:%S", "%b %d, %Y", "%m-%d-%Y"]
    return f"coalesce(strftime(try_strptime(\"{name}\", [{one_of(formats)}]), '%Y-%m-%d'), '')"


STEPS["cases_kept"] = """
SELECT * FROM cases WHERE TRY_CAST(Chapter AS DOUBLE) = 11 AND CikBefore IS NOT NULL
  AND TRY_CAST(YearFiled AS DOUBLE) >= 2010 AND TRY_CAST(AssetsBefore AS DOUBLE) >= 500
"""
DISPOSITION_SQL = (
    "CASE " + " ".join(
        "WHEN " + " OR ".join(f"contains(lower(Disposition), '{word}')" for word in words) + f" THEN '{label}'"
        for label, words in K.DISPOSITIONS
    ) + " ELSE 'other' END"
)


_CASE_GIVEN = re.findall(r"AS (\w+)(?:,|\nFROM)", STEPS["cases"])


def _case_cell(name: str, kind: str) -> str:
    if name == "brd_chapter":
        return f"CAST(TRY_CAST(Chapter AS DOUBLE) AS INTEGER) AS {name}"
    if name == "brd_disposition":
        return f"{DISPOSITION_SQL} AS {name}"
    if name == "brd_date_emerging":
        return f"{us_date_sql('DateEmerging')} AS {name}"
    if name in K.CASE_FLAGS:
        source, true_values, absent = K.CASE_FLAGS[name]
        if source not in _CASE_GIVEN:
            return f"{int(absent in true_values)} AS {name}"
        return f"CASE WHEN trim(lower({source})) IN ({one_of(true_values)}) THEN 1 ELSE 0 END AS {name}"
    if name in K.CASE_MEASURES:
        source = K.CASE_MEASURES[name]
        return f"{number_sql(source) if source in _CASE_GIVEN else 'CAST(NULL AS DOUBLE)'} AS {name}"
    source = K.CASE_TEXTS[name]
    return f"coalesce(trim({source}), '') AS {name}" if source in _CASE_GIVEN else f"'' AS {name}"


STEPS["case_rows"] = (
    "SELECT '' AS ticker, NameCorp AS company_name, "
    "lpad(CAST(CAST(TRY_CAST(CikBefore AS DOUBLE) AS BIGINT) AS VARCHAR), 10, '0') AS cik, "
    "'lopucki_brd' AS source, 1 AS distress_label, "
    f"{us_date_sql('DateFiled')} AS distress_event_date, "
    "concat('chapter_', CAST(TRY_CAST(Chapter AS DOUBLE) AS INTEGER)) AS distress_event_type, "
    + ", ".join(_case_cell(name, kind) for name, kind in K.ENRICHMENT_TYPES.items())
    + " FROM cases_kept"
)


def _blank_cell(name: str) -> str:
    if name in K.CASE_MEASURES:
        return f"CAST(NULL AS DOUBLE) AS {name}"
    if name == "brd_chapter" or name in K.CASE_FLAGS:
        return f"CAST(NULL AS INTEGER) AS {name}"
    return f"'' AS {name}"


STEPS["constituent_rows"] = (
    "SELECT replace(Symbol, '.', '-') AS ticker, Security AS company_name, "
    "lpad(CAST(CIK AS VARCHAR), 10, '0') AS cik, 'sp500' AS source, 0 AS distress_label, "
    "'' AS distress_event_date, '' AS distress_event_type, "
    + ", ".join(_blank_cell(name) for name in K.ENRICHMENT_TYPES)
    + " FROM constituents"
)
STEPS["universe_all"] = "SELECT * FROM constituent_rows UNION ALL BY NAME SELECT * FROM case_rows"
STEPS["universe_built"] = """
SELECT * EXCLUDE (pos) FROM (
  SELECT *, row_number() OVER (PARTITION BY cik
    ORDER BY distress_label DESC, distress_event_date DESC, company_name) AS pos FROM universe_all) q
WHERE pos = 1
"""

# ---------------------------------------------------------------------------------------------- reports

LONG_GROUP = "CASE distress_label WHEN 1 THEN 'Distressed (LoPucki)' ELSE 'Healthy (S&P 500)' END"
SHORT_GROUP = "CASE distress_label WHEN 1 THEN 'Distressed' ELSE 'Healthy' END"
STEPS["names"] = "SELECT cik, arg_max(company_name, period_end) AS company_name FROM gold GROUP BY cik"
STEPS["named"] = """
SELECT t.*, coalesce(n.company_name, 'Unknown') AS company_name
FROM text_features t LEFT JOIN names n ON CAST(t.cik AS BIGINT) = n.cik
"""
STEPS["latest_z"] = """
SELECT cik, max(period_end) AS period_end, arg_max(altman_z_score, period_end) AS altman_z_score,
  arg_max(distress_zone, period_end) AS distress_zone
FROM gold WHERE altman_z_score IS NOT NULL GROUP BY cik
"""
STEPS["top_by_z"] = """
SELECT company_name, count(*) AS n_scored FROM gold WHERE altman_z_score IS NOT NULL
GROUP BY company_name ORDER BY n_scored DESC, company_name LIMIT 100
"""
STEPS["top_by_composite"] = """
SELECT company_name, count(*) AS n_scored FROM composite WHERE composite_score IS NOT NULL
GROUP BY company_name ORDER BY n_scored DESC, company_name LIMIT 100
"""
STEPS["distressed_names"] = """
SELECT * EXCLUDE (pos) FROM (
  SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY cik, period_end) AS pos
  FROM composite WHERE distress_label = 1) q
WHERE pos = 1
"""
