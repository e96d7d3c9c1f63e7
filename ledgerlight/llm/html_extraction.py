"""The main text of pages: boosted trees judge the nodes of a page, and a decoding over the tree keeps their choices free of contradictions.

Each page is parsed into nodes (``html_dom``), each node gets its features (tag, words of its attributes and of those above it, density and
links of its subtree, depth, siblings), and boosted trees give the odds that main text lies in it. The decoding keeps the most likely set of
nodes in which a kept node's ancestors are all kept, so nothing is kept inside a part that is left out. The kept nodes' text is put together
block by block. A page is one unit of work; nothing is shuffled, and only the trees (some KB) are sent to the tasks.

The model is fitted on ``page_layouts.PAGES`` made-up pages with known main texts, since the given pages have no labels; ``fit_model`` takes
other pages whose main blocks carry the mark.

Defined cases: a null, empty or blank page has an empty text; without tags a page is one run of text, judged like any other; unclosed
elements end where HTML lets them end, an unclosed comment, script or style at the page's end; repeated rows and ties give a row each;
null keys and urls stay; an empty table gives an empty result. Only the three named columns are read, so further columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import boosted_trees, html_dom, page_layouts
from ledgerlight.llm.common import tidy


def node_labels(page: html_dom.Page) -> np.ndarray:
    """1 for nodes in which main text lies: those under a mark 1 (a mark 0 below it ends that), and all above them."""
    n = len(page.parents)
    inside, labels = np.zeros(n, bool), np.zeros(n)
    for node in range(n):
        mark = page.marks[node]
        inside[node] = mark == "1" if mark is not None else node > 0 and inside[page.parents[node]]
    own = inside & (np.array(page.chars) > 0)
    for node in range(n - 1, -1, -1):
        labels[node] = max(labels[node], own[node])
        if node:
            labels[page.parents[node]] = max(labels[page.parents[node]], labels[node])
    return labels


def fit_model(pages: Iterable[str]) -> boosted_trees.Forest:
    """Trees fitted on pages whose main blocks carry the attribute ``page_layouts.MARK``. Nodes without text are left out."""
    rows, labels = [], []
    for markup in pages:
        page = html_dom.parse(markup, page_layouts.MARK)
        matrix, wanted = html_dom.features(page), node_labels(page)
        text = matrix[:, html_dom.CHARS] > 0
        rows.append(matrix[text])
        labels.append(wanted[text])
    return boosted_trees.fit(np.concatenate(rows), np.concatenate(labels))


@lru_cache(maxsize=1)
def default_model() -> boosted_trees.Forest:
    return fit_model(page_layouts.layout(seed) for seed in range(page_layouts.PAGES))


def extract(pages: list[str], model: boosted_trees.Forest) -> list[str]:
    """The main text of each page."""
    parsed = [html_dom.parse(markup) for markup in pages]
    matrices = [html_dom.features(page) for page in parsed]
    logits = model.logits(np.concatenate(matrices)) if matrices else np.zeros(0)
    ends = np.cumsum([0, *(len(matrix) for matrix in matrices)])
    return [html_dom.kept_text(page, html_dom.choose(page, logits[a:b])) for page, a, b in zip(parsed, ends, ends[1:])]


#: Pages are judged together up to so many characters.
TOGETHER = 1 << 20


def _groups(pages: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for page in pages:
        held.append(page)
        size += len(page)
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def extract_text(pages: DataFrame, model: boosted_trees.Forest | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text and n_chars (code points) of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())
    source = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for group in _groups(batch.column("html").to_pylist()):
                texts = extract(group, shared.value)
                rows = batch.slice(begin, len(group))
                begin += len(group)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("key"), rows.column("url"), pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())],
                    ["key", "url", "text", "n_chars"],
                )

    kinds = {name: source.schema[name].dataType.simpleString() for name in ("key", "url")}
    out = source.mapInArrow(tidy(run), f"key {kinds['key']}, url {kinds['url']}, text string, n_chars long")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
