"""A stored table with one row for each key: folders by key hash, and merges that rewrite only the folders of the new rows.

The number of buckets is fixed when the table is made. A merge reads the stored rows of the buckets that its rows fall into, keeps for each
key the row with the greatest version (the new one among equals), writes these buckets anew and commits an entry that names the
folder of every bucket. Readers take the folders of the newest entry: no window, no half-done merge. A merge that another one overtook starts
again from the newer entry, so no update is lost. Merges with a number (the batches of a stream) are applied once and in order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight.session import checkpointed
from ledgerlight.sources import typed
from ledgerlight.sources.commits import CommitLog, Conflict

#: Buckets of a new table. A bucket of more rows than `TASK_ROWS` is written by several tasks, each a file of its own.
BUCKETS = 64
TASK_ROWS = 250_000
BUCKET = "_bucket"


def _bucket(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*(F.col(key).cast("string") for key in keys)), F.lit(buckets)).cast("int")


def _newest(rows: DataFrame, keys: list[str], version: str | None) -> DataFrame:
    """One row for each key: greatest version (none is smallest), then the later source; equal rows of one source in one order."""
    others = [F.asc(name) for name, kind in rows.dtypes if name not in (*keys, version, "_side") and kind != "variant" and "map<" not in kind]
    order = [F.desc_nulls_last(version)] if version else []
    newest = Window.partitionBy(*keys).orderBy(*order, F.desc("_side"), *others)
    return rows.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn", "_side")


def _stored(spark: SparkSession, path: str, folders: list[str]) -> DataFrame | None:
    if not folders:
        return None
    return spark.read.option("mergeSchema", True).parquet(*(f"{path}/{folder}" for folder in folders))


def merge_keyed(
    new: DataFrame, path: str, keys: list[str], version: str | None = None, buckets: int = BUCKETS, number: int | None = None, by: list[str] | None = None,
    replaced: DataFrame | None = None, stored: bool = False,
) -> int:
    """Merge rows into the table at ``path``, made by the first merge. Returns how many buckets were written.

    ``number`` is that of a batch: one that is not above the last applied one is skipped, since it has been merged before. Buckets are cut by
    the columns ``by``, all keys where none are named. ``replaced`` holds values of ``by`` whose stored rows all go. Rows that the caller has
    checkpointed (``stored``) are not written a second time.
    """
    by = by or keys
    spark, log = new.sparkSession, CommitLog(new.sparkSession, path)
    if number is not None and number <= log.latest()[1].get("applied", -1):
        return 0
    replaced = None if replaced is None else checkpointed(replaced.select(*by).distinct())
    new = new if stored else checkpointed(new)  # rows may come from a scorer: they are computed once, however often the merge starts again
    while True:
        at, entry = log.latest()
        if number is not None and number <= entry.get("applied", -1):
            return 0
        many, folders = entry.get("buckets", buckets), entry.get("folders", {})
        rows = new.withColumn("_side", F.lit(1))
        concerned = new.select(*by) if replaced is None else new.select(*by).unionByName(replaced)
        counts = _touched(concerned, by, many)
        touched = sorted(counts)
        old = _stored(spark, path, [folders[str(b)] for b in touched if str(b) in folders])
        slices = 1 + (sum(counts.values()) + (0 if old is None else old.count())) // (TASK_ROWS * max(1, len(touched)))
        if old is not None and replaced is not None:
            gone = replaced.withColumnsRenamed({name: f"_{name}" for name in by})
            old = old.join(gone, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in by], "left_anti")
        both = rows if old is None else typed.union_by_name([old.withColumn("_side", F.lit(0)), rows])
        name = f"merge-{uuid.uuid4().hex}"
        if touched:
            merged = _newest(both, keys, version).withColumn(BUCKET, _bucket(by, many))
            # each task has one slice of one bucket: a hash of the bucket would give some tasks several and others none
            place = (F.array_position(F.lit(touched), F.col(BUCKET)) - 1) * slices + F.pmod(F.hash(*(F.col(key).cast("string") for key in keys)), F.lit(slices))
            placed = merged.repartitionById(len(touched) * slices, place.cast("int"))
            placed.sortWithinPartitions(BUCKET, *keys).write.partitionBy(BUCKET).parquet(f"{path}/{name}")
        # a bucket that lost all of its rows has no folder
        full = log.folders(name, f"{BUCKET}=") if replaced is not None and touched else set(map(str, touched))
        kept = {b: folder for b, folder in folders.items() if int(b) not in touched}
        changed = {**entry, "buckets": many, "by": by, "folders": {**kept, **{b: f"{name}/{BUCKET}={b}" for b in sorted(full)}}}
        if number is not None:
            changed["applied"] = number
        try:
            log.commit(at + 1, changed)
        except Conflict:
            continue
        return len(touched)


def _touched(rows: DataFrame, by: list[str], buckets: int) -> dict[int, int]:
    """The buckets that the rows fall into, with the number of rows of each; ``buckets`` numbers at most."""
    return dict(rows.groupBy(_bucket(by, buckets)).agg(F.count("*")).collect())


def read_for(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame | None:
    """The stored rows of the values of ``rows``; only the folders that these fall into are read. None where there are none."""
    _, entry = CommitLog(spark, path).latest()
    by, folders = entry["by"], entry["folders"]
    wanted = rows.select(*by).distinct()
    stored = _stored(spark, path, [folders[str(b)] for b in sorted(_touched(wanted, by, entry["buckets"])) if str(b) in folders])
    return stored if stored is None else stored.join(wanted, by, "left_semi")


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the newest entry, as stored."""
    _, entry = CommitLog(spark, path).latest()
    rows = _stored(spark, path.rstrip("/"), sorted(entry.get("folders", {}).values()))
    if rows is None:
        raise ValueError(f"no table at {path}")
    return rows


def clear_replaced(spark: SparkSession, path: str, older_than_s: float = 7 * 86_400) -> list[str]:
    """Remove folders that no bucket of the newest entry lies in, of merges that died or were replaced, once no reader uses them."""
    log = CommitLog(spark, path)
    _, entry = log.latest()
    return log.clear_abandoned({folder.split("/")[0] for folder in entry.get("folders", {}).values()}, older_than_s)
