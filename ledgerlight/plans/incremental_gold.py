"""Silver and gold kept up to date: changed silver rows are merged, and gold is computed anew for the companies they belong to.

A row of gold depends on its own silver row, on up to three rows before it of the same company and form, and on its company's labels. So
what changes with a silver row lies within its company, whose rows are bounded by its period ends. Both layers are stored by company
(`sources.keyed`): a run reads and rewrites the folders that the changed companies fall into, no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlight.operators.silver import KEY
from ledgerlight.plans.layers import build_gold
from ledgerlight.session import checkpointed
from ledgerlight.sources.keyed import BUCKET, BUCKETS, merge_keyed, read_for

BY = ["cik"]


def apply_silver(changed: DataFrame, universe: DataFrame, silver_path: str, gold_path: str, buckets: int = BUCKETS) -> tuple[int, int]:
    """Merge changed silver rows and bring gold up to date. Returns how many folders of each layer were rewritten.

    A row replaces the stored one of its company and period. Gold rows of the companies go and come anew, so one that a change takes
    out (no assets any more) leaves gold, too. A run that died between the layers is repeated with the same rows.
    """
    spark = changed.sparkSession
    changed = checkpointed(changed)
    silver_folders = merge_keyed(changed, silver_path, KEY, buckets=buckets, by=BY, stored=True)
    return silver_folders, refresh_gold(spark, changed.select(*BY), universe, silver_path, gold_path, buckets)


def refresh_gold(spark, companies: DataFrame, universe: DataFrame, silver_path: str, gold_path: str, buckets: int = BUCKETS) -> int:
    """Compute gold anew for the given companies, after a change of their silver rows or labels. Returns how many folders were rewritten."""
    stored = read_for(spark, silver_path, companies)
    if stored is None:
        return 0
    gold = build_gold(stored.drop(BUCKET), universe)
    return merge_keyed(gold, gold_path, KEY, buckets=buckets, by=BY, replaced=companies)
