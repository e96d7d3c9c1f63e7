"""The layers end to end. Each is one lazy plan from its inputs; writing it is the only action."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators import composite as C
from ledgerlight.operators import gold as G
from ledgerlight.operators import text_features as N
from ledgerlight.operators import universe as U
from ledgerlight.operators.facts import flatten_facts
from ledgerlight.operators.silver import silver


def build_universe(constituents: DataFrame, cases: DataFrame) -> DataFrame:
    healthy = U.normalise_constituents(constituents)
    distressed = U.enrich_cases(U.filter_cases(cases))
    return U.order_universe(U.prefer_distressed(U.union_universe(healthy, distressed)))


def build_silver(facts: DataFrame) -> DataFrame:
    """Long fact rows to one row per company and period."""
    return silver(facts)


def build_silver_from_documents(blobs: DataFrame) -> DataFrame:
    return build_silver(flatten_facts(blobs))


def build_gold(silver_df: DataFrame, universe: DataFrame) -> DataFrame:
    return G.score_and_trend(G.join_labels(silver_df, G.universe_labels(universe)))


def build_text_features(
    documents: DataFrame,
    done: DataFrame | None = None,
    make_scorer: Callable[[], N.Scorer] | None = None,
    limit: int | None = None,
    redo_skipped: bool = False,
) -> DataFrame:
    """Features of the documents (object_name, text) that are not done yet; merge with `merge_text_features`.

    What is open is decided on names alone. A caller that reads files passes only the open ones
    (`readers.list_objects`, `text_features.resume_filter`, `readers.read_objects`), so that finished texts are
    not even read; here ``done`` and ``limit`` reduce names first and fetch their texts last.
    """
    if done is not None or limit:
        names = N.parse_object_name(documents.select("object_name"))
        if done is not None:
            names = N.resume_filter(names, N.done_keys(done, redo_skipped), limit)
        else:
            names = names.orderBy("object_name").limit(limit)
        documents = N.open_documents(documents, names)
    rows = N.keyword_features(N.document_rows(N.parse_object_name(documents)))
    scored = N.skipped_fields(rows) if make_scorer is None else N.scored_features(rows, make_scorer)
    return scored.withColumn("processed_at", N.processed_now()).drop("text", "object_name")


def build_composite(gold: DataFrame, text_features: DataFrame | None = None) -> DataFrame:
    features = C.empty_text_features(gold) if text_features is None else text_features
    return C.score_composite(C.join_signals(C.with_components(gold), C.company_signals(features)))


def latest_scored(gold: DataFrame) -> DataFrame:
    """Per company its latest row with a Z' score."""
    scored = gold.filter(F.col("altman_z_score").isNotNull())
    row = F.struct("altman_z_score", "distress_zone")
    latest = scored.groupBy("cik").agg(F.max(F.struct(F.col("period_end"), row.alias("row"))).alias("last"))
    return latest.select("cik", "last.period_end", "last.row.altman_z_score", "last.row.distress_zone")
