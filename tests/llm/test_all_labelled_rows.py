import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlight.llm import labelled, quality_rank, quality_rules


@pytest.fixture(scope="module")
def many(spark):
    """12,000 labelled documents; the bad ones are among those with the largest hashes of their keys."""
    ranked = spark.range(12_000).withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.xxhash64("id"))))
    bad = (F.col("rank") > 10_500) & (F.col("id") % 5 == 0)
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("w"), (i * (F.col("id") % 97 + 1)) % 211)), " ")
    rows = ranked.select(F.col("id").alias("doc_id"), F.when(bad, F.concat(words, F.lit(" ### $$$ !!! 123 ###"))).otherwise(words).alias("text"), (~bad).cast("int").alias("quality"))
    path = spark.conf.get("spark.checkpoint.dir") + "/many"
    rows.repartition(4).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_models_learn_from_all_labelled_rows(spark, many):
    docs, labels = many.select("doc_id", "text"), many.select("doc_id", "quality")
    ranker = quality_rank.fit_ranker(docs, labels)
    assert ranker is not None
    scored = quality_rank.score(docs, ranker).join(labels, "doc_id")
    assert scored.where("predicted = quality").count() >= 11_900
    again = quality_rank.fit_ranker(docs.repartition(7), labels.repartition(3))
    assert np.allclose(again.weights, ranker.weights, rtol=1e-6, atol=1e-9) and abs(again.cut - ranker.cut) < 1e-6

    forest = quality_rules.fit_forest(docs, labels)
    ratios, good, counts = labelled.labelled_ratios(docs, labels, "quality")
    assert len(good) == 12_000
    lengths = forest.path_lengths(ratios)
    assert forest.cut == quality_rules.calibrated_cut(lengths, good == 1) > 0
    again = quality_rules.fit_forest(docs.repartition(7), labels)
    assert all(np.array_equal(getattr(again, name), getattr(forest, name)) for name in ("feature", "value", "left", "right", "length", "cut"))


def test_sums_and_ranks_of_all_rows(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=(500, 2)) * [1, 1e9], np.zeros((40, 2)), -np.zeros((40, 2)), np.full((7, 2), 1e-320)])
    rows = spark.createDataFrame([(row,) for row in values.tolist()], "values array<double>").repartition(5)
    matrix = lambda batch: labelled.matrix_of(batch.column("values"), 2)
    for rank in (0, 1, 250, 290, 300, 585, 586):
        assert labelled.order_statistics(rows, matrix, [rank, 586 - rank]).tolist() == [np.sort(values[:, 0])[rank], np.sort(values[:, 1])[586 - rank]]
    assert np.allclose(labelled.added(rows, lambda batch: matrix(batch).sum(axis=0), 2), values.sum(axis=0))


@pytest.mark.parametrize("bad", [1, 3, 700])
def test_blocks_hold_every_row_and_both_labels(spark, monkeypatch, bad):
    monkeypatch.setattr(quality_rank, "BLOCK", 256)
    monkeypatch.setattr(quality_rank, "FEW", 16)
    width = len(labelled.NAMES)
    rows = spark.range(2000).select(F.col("id").alias("key"), F.when(F.col("id") < bad, 0).otherwise(1).alias("label"), F.array_repeat(F.col("id").cast("double"), width).alias("values"))
    found = quality_rank._blocks(rows, {1: 2000 - bad, 0: bad}).collect()
    of = {name: [np.frombuffer(row[name]).reshape(-1, len(labelled.RATIOS))[:, 0] for row in found] for name in ("good", "bad")}
    assert sorted(np.concatenate(of["good"]).tolist()) == list(range(bad, 2000))
    assert set(np.concatenate(of["bad"]).tolist()) == set(range(bad))
    assert sum(len(part) for part in of["bad"]) <= max(bad, 2 * 16 * len(found))
    if bad > 1:
        assert sum(len(part) > 0 for part in of["bad"]) == len(found) == 7
    pairs = quality_rank._pairs(np.arange(5.0)[:, None] + 100, np.arange(3.0)[:, None], 0)
    assert len(pairs) == 5 * quality_rank.PARTNERS and (pairs > 90).all()
