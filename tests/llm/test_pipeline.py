import re
import sys

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import test_byte_bpe as bpe  # noqa: E402
import test_decontaminate as leaks  # noqa: E402
import test_jaccard_join as jaccard  # noqa: E402
import test_suffix_dedup as suffix  # noqa: E402

import corpus_pipeline  # noqa: E402
from ledgerlight.llm import queries as Q  # noqa: E402

reference = bpe.reference
FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_equal_direct_versions(spark, reference):
    docs = Q.table(spark, FOLDER, "documents")
    labels = {r.doc_id: r.quality for r in Q.table(spark, FOLDER, "labels").collect()}
    items = [(r.item_id, r.text) for r in Q.table(spark, FOLDER, "benchmark").collect()]
    good = corpus_pipeline.keep_good(spark, docs, FOLDER).cache()
    assert good.columns == COLUMNS
    ids = {r.doc_id for r in good.collect()}
    agree = [labels[r.doc_id] == (r.doc_id in ids) for r in docs.collect() if r.doc_id in labels]
    assert np.mean(agree) > 0.95

    single = corpus_pipeline.keep_one_of_each(spark, good, FOLDER).cache()
    wanted = {key for key, size, component in jaccard.brute([(r.doc_id, r.text) for r in good.collect()]) if not size or key == component}
    assert rows(single) == [r for r in rows(good) if r[0] in wanted] and single.count() < good.count()

    cut = corpus_pipeline.remove_repeated_passages(spark, single, FOLDER).cache()
    before = single.collect()
    gone = suffix.covered([(r.doc_id, (r.text or "").encode()) for r in before], 100)
    texts = {}
    for r, g in zip(before, gone):
        texts[r.doc_id] = bytes(b for b, x in zip((r.text or "").encode(), g) if not x).decode("utf-8", "ignore")
    assert {r.doc_id: r.text for r in cut.collect()} == texts
    assert cut.columns == COLUMNS and all(r.n_chars == len(r.text) for r in cut.collect())

    clean = corpus_pipeline.remove_leaks(spark, cut, FOLDER).cache()
    leaked = {key for key, _, _ in leaks.expected([(r.doc_id, r.text) for r in cut.collect()], items)}
    assert rows(clean) == [r for r in rows(cut) if r[0] not in leaked]

    tokens = {r.doc_id: r for r in corpus_pipeline.tokenize(spark, clean, FOLDER).collect()}
    final = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    for r in clean.collect():
        assert np.frombuffer(tokens[r.doc_id].ids, "<u4").tolist() == reference.encode_ordinary(r.text)
        assert tokens[r.doc_id].decodes and final[r.doc_id] == tokens[r.doc_id]
    assert len(final) == clean.count()


def test_rows_without_repeats_stay_as_they_are(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"word{i}" for i in range(100))
    odd = [(1, None, None, None, None), (None, None, "en", "x", 4), (2, "", "en", "x", 0), (3, "é b", "en", None, 77), (4, long, "en", "x", None), (5, long + "é", "en", "x", 1)]
    out = corpus_pipeline.remove_repeated_passages(spark, spark.createDataFrame(odd, schema), FOLDER)
    assert rows(out) == sorted([*odd[:-1], (5, "é", "en", "x", 1)], key=str)
    last = corpus_pipeline.remove_repeated_passages(spark, spark.createDataFrame([odd[4], (5, long + "éa", "en", "x", 9)], schema), FOLDER)
    assert rows(last) == sorted([odd[4], (5, "éa", "en", "x", 2)], key=str)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_each_stage_on_odd_rows(spark, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"word{i % 977}" for i in range(40000))
    odd = [(1, None, None, None, None), (None, None, None, None, None), (2, "", "en", "x", 0), (3, long, "en", "x", len(long)), (3, long, "en", "x", len(long)), (5, "a b", "en", None, 3)]
    out = stage(spark, spark.createDataFrame(odd, schema), FOLDER)
    assert name == "byte_bpe" or out.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    assert 1 <= out.count() <= len(odd)
    assert stage(spark, spark.createDataFrame([], schema), FOLDER).count() == 0
    more = spark.createDataFrame([(*row, "own", 7, "k", True) for row in odd], f"{schema}, score string, predicted int, kept string, n_removed boolean")
    wider = stage(spark, more, FOLDER)
    assert wider.count() == out.count()
    if name != "byte_bpe":
        assert wider.columns == more.columns and {(r.score, r.predicted, r.kept, r.n_removed) for r in wider.collect()} == {("own", 7, "k", True)}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_no_task_needs_two_python_workers(spark, name, stage):
    plan = stage(spark, Q.table(spark, FOLDER, "documents"), FOLDER)._jdf.queryExecution().executedPlan().toString()
    parts = [re.findall(r"MapInArrow|FlatMap(?:Co)?GroupsInArrow|ArrowEvalPython|BatchEvalPython|MapInPandas", part) for part in plan.split("Exchange")]
    assert any(parts) and max(map(len, parts)) == 1, plan
