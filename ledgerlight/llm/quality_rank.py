"""Quality classifier: Bradley-Terry scores learned from preference pairs, cut at a score quantile.

Every pair of a good and a bad labelled document says that the first is preferred. The score is linear in features of the text;
its weights minimise the logistic loss of the feature differences of pairs. All labelled rows are dealt to blocks by key hash and paired
within them, blocks send sums, so the model depends on the rows alone. The cut lies at the quantile of the training
scores that equals the share of bad training rows; a logistic curve through (cut, CUT_SCORE) turns scores into 0 ... 1.

Defined cases: a null or empty text is scored as a text without words; without both labels among the training rows every score is
0.5; repeated rows are scored alike; an empty table gives an empty result; other columns, labels among them, are never read when scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import labelled, textstats
from ledgerlight.llm.common import buffers, checkpointed, replaced, slices, tidy

#: A document is predicted to be good from this score on.
CUT_SCORE = 0.3
#: Partners of a row, most Newton steps, weight of the squared weights, fall of the loss that ends the steps.
PARTNERS, ROUNDS, DECAY, ENOUGH, SEED = 8, 15, 1e-4, 1e-7, 11
#: Rows of a block, and rows of each label that a block has at least on average.
BLOCK, FEW = 4096, 64
#: How far a feature reaches, in standard deviations of the good rows.
REACH = 6.0
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class Ranker:
    """Centre and scale of the features, the weights, the cut and the spread of the scores."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float

    def features(self, ratios: np.ndarray) -> np.ndarray:
        """Each ratio in units of the good rows' spread, and how far off it is in either direction."""
        units = np.clip((ratios - self.centre) / self.scale, -REACH, REACH)
        return np.concatenate([units, np.abs(units), np.maximum(0, np.abs(units) - 3)], axis=1)

    def raw(self, ratios: np.ndarray) -> np.ndarray:
        return self.features(ratios) @ self.weights

    def score(self, ratios: np.ndarray) -> np.ndarray:
        logit = (self.raw(ratios) - self.cut) / self.spread + np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def _pairs(good: np.ndarray, bad: np.ndarray, place: int) -> np.ndarray:
    """Feature differences of good and bad rows: PARTNERS times each row of the larger side with one of the smaller, all in turn."""
    rng = np.random.default_rng([SEED, place])
    many, few = (good, bad) if len(good) >= len(bad) else (bad, good)
    if not len(few):
        return np.zeros((0, good.shape[1]))
    turns = np.concatenate([rng.permutation(len(few)) for _ in range(-(-PARTNERS * len(many) // len(few)))])[:PARTNERS * len(many)]
    difference = np.tile(many, (PARTNERS, 1)) - few[turns]
    return difference if many is good else -difference


def _blocks(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """All rows dealt by key hash to blocks of about BLOCK rows, packed by label. A label so rare that blocks would get less than FEW of
    its rows on average is dealt several times."""
    blocks = max(1, sum(counts.values()) // BLOCK)
    copies = {label: min(blocks, max(1, -(-FEW * blocks // n))) for label, n in counts.items()}
    times = F.when(F.col("label") == 1, copies[1]).otherwise(copies[0])
    dealt = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), times - 1)))
    dealt = dealt.withColumn("hash", F.xxhash64("key")).withColumn("place", F.pmod(F.xxhash64("key", "copy"), F.lit(blocks)))

    def pack(table: pa.Table) -> pa.Table:
        table = table.select(["hash", "values", "place", "label"]).combine_chunks()
        label, place = table["label"].to_numpy(), table["place"][0].as_py()
        matrix = labelled.matrix_of(table["values"].combine_chunks())[:, labelled.COUNTED:]
        order = np.lexsort([*matrix.T, table["hash"].to_numpy()])
        parts = [matrix[order][label[order] == kind].tobytes() for kind in (1, 0)]
        return pa.table({"place": pa.array([place], pa.int64()), "good": pa.array(parts[:1], pa.binary()), "bad": pa.array(parts[1:], pa.binary())})

    return checkpointed(dealt.select("place", "hash", "label", "values").groupBy("place").applyInArrow(pack, "place long, good binary, bad binary"))


def _fit(rows: DataFrame) -> Ranker | None:
    """Weights from pairs of a good and a bad row, every row in some, cut and spread from all rows; None without both.

    Newton steps on the mean logistic loss of the pairs, halved when the loss did not fall.
    """
    width = len(labelled.RATIOS)

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        matrix, good = labelled.matrix_of(batch.column("values"))[:, labelled.COUNTED:], batch.column("label").to_numpy() == 1
        return np.concatenate([[good.sum(), (~good).sum()], matrix[good].sum(axis=0), (matrix[good] ** 2).sum(axis=0)])

    total = labelled.added(rows, sums, 2 + 2 * width)
    good, bad = (int(n) for n in total[:2])
    if not good or not bad:
        return None
    mean, square = total[2:2 + width] / good, total[2 + width:] / good
    halves = [(good - 1) // 2, good // 2]
    middle = labelled.order_statistics(
        rows.where("label = 1"), lambda batch: np.repeat(labelled.matrix_of(batch.column("values"))[:, labelled.COUNTED:], 2, axis=1), halves * width
    )
    centre = middle.reshape(-1, 2).mean(axis=1)
    scale = _rounded(np.maximum(np.sqrt(np.maximum(square - mean ** 2, 0)), 1e-3))
    blank = Ranker(centre, scale, np.zeros(3 * width), 0.0, 1.0)
    blocks = _blocks(rows, {1: good, 0: bad})
    n = len(blank.weights)

    def slopes(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean loss of the pairs, its gradient and its second derivatives."""
        def of_block(batch: pa.RecordBatch) -> np.ndarray:
            sides = [np.frombuffer(batch.column(name)[0].as_buffer(), np.float64).reshape(-1, width) for name in ("good", "bad")]
            difference = _pairs(*(blank.features(side) for side in sides), batch.column("place")[0].as_py())
            margin = np.clip(difference @ weights, -60, 60)
            miss = 1 / (1 + np.exp(margin))
            bend = (difference * (miss * (1 - miss))[:, None]).T @ difference
            return np.concatenate([[len(margin), np.logaddexp(0, -margin).sum()], miss @ difference, bend.ravel()])

        found = labelled.added(blocks, of_block, 2 + n + n * n, place="place")
        found = found / max(found[0], 1)
        loss = found[1] + DECAY / 2 * weights @ weights
        return loss, DECAY * weights - found[2:2 + n], found[2 + n:].reshape(n, n) + DECAY * np.eye(n)

    weights, step, best = np.zeros(n), np.zeros(n), np.inf
    for _ in range(ROUNDS):
        loss, gradient, bend = slopes(weights + step)
        if loss < best:
            weights, best, step = weights + step, loss, -np.linalg.solve(bend, gradient)
            if gradient @ -step < 2 * ENOUGH:
                break
        else:
            step = step / 2
    ranker = Ranker(centre, scale, _rounded(weights), 0.0, 1.0)

    def raw(batch: pa.RecordBatch) -> np.ndarray:
        return ranker.raw(labelled.matrix_of(batch.column("values"))[:, labelled.COUNTED:])

    cut = labelled.order_statistics(rows, lambda batch: np.repeat(raw(batch)[:, None], 2, axis=1), [bad - 1, bad]).mean()
    moments = labelled.added(rows, lambda batch: np.array([(raw(batch) - cut).sum(), ((raw(batch) - cut) ** 2).sum()]), 2) / (good + bad)
    spread = np.sqrt(max(moments[1] - moments[0] ** 2, 0))
    return replace(ranker, cut=float(cut), spread=float(_rounded(max(spread, 1e-9))))


def _rounded(values: np.ndarray) -> np.ndarray:
    """Twelve digits, so that the order of adding up doesn't show."""
    return np.vectorize(lambda value: float(f"{value:.12g}"))(values)


def training_rows(key: Column) -> Column:
    """Rows that labels may be learned from: the others are held out. A null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 != 0


def fit_ranker(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", where: Column | None = None) -> Ranker | None:
    """Fit on all labelled documents; ``where`` is a condition on the label rows' ``key``."""
    return _fit(labelled.labelled_rows(docs, labels, label, key, text, where))


def score(
    docs: DataFrame, ranker: Ranker | None, key: str = "doc_id", text: str = "text", keep: bool = False, names: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """key, score, predicted of every document, or with ``keep`` all its columns and these two; no shuffle.

    A column that has the name of a result is replaced by it; ``names`` are the names of the results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranker)
    source = docs if keep else docs.select(key, text)
    added = [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())]
    schema = replaced(docs if keep else docs.select(key), added)
    kept = schema.fieldNames()[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, texts in slices(batch, text, SLICE_BYTES):
                ratios = labelled.ratio_matrix(textstats.statistics(*buffers(texts)))
                scores = model.score(ratios) if model else np.full(len(ratios), 0.5)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(name) for name in kept), pa.array(scores), pa.array((scores >= CUT_SCORE).astype(np.int32))], schema.fieldNames()
                )

    return source.mapInArrow(tidy(run), schema)
