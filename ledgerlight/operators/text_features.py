"""Section texts to feature rows: vocabulary, prompts, scorer responses, resume and upsert."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions import responses as R
from ledgerlight.functions.text import any_term, count_terms, object_name_parts
from ledgerlight.functions.values import first_match, strip

RESPONSE_TYPE = "raw STRING, error STRING"


def parse_object_name(df: DataFrame, col: str = "object_name") -> DataFrame:
    return df.withColumns(object_name_parts(col))


def keyword_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Number of distinct vocabulary terms present, over the whole text."""
    return df.withColumns({
        "distress_keywords": count_terms(text, K.DISTRESS_TERMS),
        "positive_keywords": count_terms(text, K.POSITIVE_TERMS),
    })


def distress_flags(df: DataFrame, text: str = "text") -> DataFrame:
    """0/1 per topic. Terms match inside words too, so ``rif`` also finds "tariff"."""
    return df.withColumns({name: any_term(text, terms) for name, terms in K.FLAG_TERMS.items()})


def keyword_features(df: DataFrame, text: str = "text") -> DataFrame:
    return distress_flags(keyword_counts(df, text), text)


def document_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """Non-blank documents of the known sections with their length in characters."""
    known = df.filter(F.col("section").isin(K.SECTIONS) & (F.length(strip(text)) > 0))
    return known.withColumn("text_length", F.length(text))


# --------------------------------------------------------------------------------------------------------
# Prompts
# --------------------------------------------------------------------------------------------------------

INTRO = "Read this part of an annual report ({section}) as a credit analyst and answer with one JSON object only."
SCALE = "sentiment_score runs from -1 (distress is certain) over 0 (nothing unusual) to 1 (no risk visible)."


def default_template(section: str) -> tuple[str, str]:
    """Text before and after the excerpt; asks for exactly the fields `response_fields` reads."""
    asked = ["sentiment_score: number", f"sentiment_label: {' | '.join(K.SENTIMENT_LABELS)}"]
    if section in K.SECTIONS:
        asked += [f"{name}: {' | '.join(choices)}" for name, (choices, _) in K.RESPONSE_ENUMS[section].items()]
        asked += [f"{name}: true | false" for name in K.RESPONSE_FLAGS[section]]
    else:
        asked.append(f"risk_level: {' | '.join(K.RISK_LEVELS)}")
    if section == "business":
        asked.append("key_vulnerability: one sentence")
    asked += ["key_distress_signal: one sentence", "summary: one sentence"]
    before = "\n".join([INTRO.format(section=section), SCALE, "TEXT:", '"""'])
    after = "\n".join(['"""', "FIELDS:", *asked])
    return before, after


def build_prompt(
    df: DataFrame,
    templates: dict[str, tuple[str, str]] | None = None,
    text: str = "text",
    chunk_chars: int | None = None,
) -> DataFrame:
    """Adds ``prompt``: the text inside its section's template.

    ``templates`` maps a section, or ``other``, to the text before and after. Double quotes of the text become
    single ones so that they cannot close it. With ``chunk_chars`` a text gives one row for each consecutive
    piece of so many characters, numbered in ``chunk``; no character is lost, and an empty text gives one row.
    """
    if chunk_chars:
        pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{chunk_chars}}}"), F.lit(0))
        df = df.select("*", F.posexplode_outer(pieces).alias("chunk", "_piece"))
        df = df.withColumns({"chunk": F.coalesce("chunk", F.lit(0)), "_piece": F.coalesce("_piece", F.lit(""))})
    chosen = {name: default_template(name) for name in [*K.SECTIONS, "other"]} | (templates or {})

    def wrapped(section: str) -> Column:
        before, after = chosen[section]
        piece = F.col("_piece" if chunk_chars else text)
        return F.concat(F.lit(before), F.translate(piece, '"', "'"), F.lit(after))

    rules = [(F.col("section") == name, wrapped(name)) for name in K.SECTIONS]
    return df.withColumn("prompt", first_match(wrapped("other"), rules)).drop("_piece")


# --------------------------------------------------------------------------------------------------------
# Responses
# --------------------------------------------------------------------------------------------------------


def _section_columns() -> list[str]:
    names: list[str] = []
    for section in K.SECTIONS:
        names += [*K.RESPONSE_ENUMS[section], *K.RESPONSE_FLAGS[section]]
    return list(dict.fromkeys([*names, "risk_level", "key_vulnerability"]))


SECTION_COLUMNS = _section_columns()


def response_fields(df: DataFrame, raw: str = "raw", error: str | None = None) -> DataFrame:
    """Typed features out of the raw responses of a scorer.

    A response counts as failed when the call failed, the text is JSON but not an object, or the sentiment
    score is not a number. A failed row gets neutral values, no section fields, and the reason as
    ``llm_raw``. A text without any JSON object is not a failure: every field takes its default.
    """
    parsed = df.withColumn("_v", R.recover_json(raw))
    value = F.col("_v")
    call_error = F.col(error) if error else F.lit(None).cast("string")
    problem = first_match(
        F.lit(None).cast("string"),
        [
            (call_error.isNotNull(), call_error),
            (F.col(raw).isNull(), F.lit("no response")),
            (~R.is_object(value), F.lit("response is not a JSON object")),
            (R.raw_score(value).isNull(), F.lit("sentiment_score is not a number")),
        ],
    )
    judged = parsed.withColumn("_problem", problem)
    good = F.col("_problem").isNull()

    neutral = {
        "sentiment_score": F.lit(0.0), "sentiment_label": F.lit("neutral"),
        "key_distress_signal": F.lit(""), "llm_summary": F.lit(""),
    }
    columns = {
        name: F.when(good, column).otherwise(neutral[name]) for name, column in R.shared_fields(value).items()
    }
    per_section = {section: R.section_fields(value, section) for section in [*K.SECTIONS, "other"]}
    known = F.col("section").isin(K.SECTIONS)
    for name in SECTION_COLUMNS:
        rules = [
            (F.col("section") == section, fields[name])
            for section, fields in per_section.items() if section != "other" and name in fields
        ]
        if name in per_section["other"]:
            rules.append((~known, per_section["other"][name]))
        typed_null = F.lit(None).cast("int" if any(name in f for f in K.RESPONSE_FLAGS.values()) else "string")
        found = F.when(good, first_match(typed_null, rules))
        columns[name] = found.otherwise("medium") if name == "risk_level" else found
    columns["llm_raw"] = F.when(good, F.col(raw)).otherwise(F.col("_problem"))
    return judged.withColumns(columns).drop("_v", "_problem")


def skipped_fields(df: DataFrame) -> DataFrame:
    """Neutral features for a run without a scorer."""
    flags = {name for names in K.RESPONSE_FLAGS.values() for name in names}
    columns = {name: F.lit(None).cast("int" if name in flags else "string") for name in SECTION_COLUMNS}
    columns |= {
        "sentiment_score": F.lit(0.0),
        "sentiment_label": F.lit("neutral"),
        "risk_level": F.lit("medium"),
        "key_distress_signal": F.lit(None).cast("string"),
        "llm_summary": F.lit(""),
        "llm_raw": F.lit(K.SKIPPED),
    }
    return df.withColumns(columns)


Scorer = Callable[[list[str]], list[str]]


def one_by_one(answer: Callable[[str], str]) -> Callable[[], Scorer]:
    """A factory for a scorer that answers one prompt at a time."""
    return lambda: lambda prompts: [answer(prompt) for prompt in prompts]


def score_documents(
    df: DataFrame, make_scorer: Callable[[], Scorer], prompt: str = "prompt", batch_size: int = 32
) -> DataFrame:
    """Adds ``response`` (raw, error): answers to the prompts, asked for in batches on the executors.

    ``make_scorer`` is called once per task, so a model is loaded, or a client opened, once and never shipped;
    what it returns takes a list of prompts (and holds its system message, if it has one). When a batch fails,
    its prompts are asked one by one, so that a failing prompt marks its own row and nothing else. Only the
    prompt crosses to Python, and rows stay in their partitions.
    """

    @F.pandas_udf(RESPONSE_TYPE)
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()

        def ask(prompts: list[str]) -> list[tuple[str | None, str | None]]:
            try:
                answers = list(scorer(prompts))
                if len(answers) != len(prompts):
                    raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
                return [(answer, None) for answer in answers]
            except Exception as problem:  # noqa: BLE001 - any scorer failure belongs to its rows
                if len(prompts) == 1:
                    return [(None, str(problem))]
                return [ask([one])[0] for one in prompts]

        for batch in batches:
            prompts = batch.tolist()
            pieces = [ask(prompts[i:i + batch_size]) for i in range(0, len(prompts), batch_size)]
            yield pd.DataFrame([row for piece in pieces for row in piece], columns=["raw", "error"], dtype=object)

    # marked nondeterministic so that the optimizer never duplicates the call
    return df.withColumn("response", call.asNondeterministic()(F.col(prompt)))


def scored_features(df: DataFrame, make_scorer: Callable[[], Scorer]) -> DataFrame:
    answered = score_documents(build_prompt(df), make_scorer)
    split = answered.select("*", "response.*").drop("response", "prompt")
    return response_fields(split, "raw", "error").drop("raw", "error")


# --------------------------------------------------------------------------------------------------------
# Resume and upsert
# --------------------------------------------------------------------------------------------------------


def done_keys(features: DataFrame, redo_skipped: bool = False) -> DataFrame:
    """Keys of processed documents; with ``redo_skipped`` documents that met no scorer count as open."""
    finished = features.filter(~F.col("llm_raw").eqNullSafe(K.SKIPPED)) if redo_skipped else features
    return finished.select(*K.TEXT_KEY).distinct()


def resume_filter(todo: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Keys of documents not processed yet, optionally the first ``limit`` in object order.

    ``todo`` is a listing (object_name and its parts). A text column in it is left out: contents are read after
    the choice, with `open_documents`.
    """
    names = todo.drop("text", "content")
    left = names.join(done.select(*K.TEXT_KEY), K.TEXT_KEY, "left_anti")
    return left.orderBy("object_name").limit(limit) if limit else left


def open_documents(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """The documents of chosen names, each side's rows matched by object name."""
    return documents.join(chosen.select("object_name"), "object_name", "left_semi")


def upsert_latest(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name in which the new row of a key replaces the old one."""
    batches = [df.withColumn("_batch", F.lit(i)) for i, df in enumerate((old, new))]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
    return latest_batch(both, "_batch").drop("_batch")


def latest_batch(features: DataFrame, batch: str) -> DataFrame:
    """The row of the newest batch per document; within a batch the one processed last."""
    order = [F.desc(batch)]
    if "processed_at" in features.columns:
        order.append(F.desc_nulls_last("processed_at"))
    order += [F.asc(c) for c, kind in features.dtypes if c not in (*K.TEXT_KEY, batch) and kind != "variant"]
    newest = Window.partitionBy(*K.TEXT_KEY).orderBy(*order)
    return features.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def processed_now() -> Column:
    """ISO text of the processing time in UTC."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
