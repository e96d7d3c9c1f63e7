import html as entities
import itertools
import re

import numpy as np
import pytest

from ledgerlight.llm import boosted_trees, html_dom, html_extraction, page_layouts
from ledgerlight.llm.html_extraction import default_model, extract, extract_text, node_labels

GIVEN = "/root/testdata/sf0.001/pages.parquet"
LONG = "The committee met on Monday to discuss the plan for the new bridge, which will cost more than expected. "


def direct(markup):
    """The given pages have one article of headings and paragraphs."""
    article = re.search("<article>(.*?)</article>", markup or "", re.S)
    lines = []
    for block in re.split("</?(?:p|h1)>", article.group(1) if article else ""):
        line = " ".join(entities.unescape(re.sub("<br>", " ", re.sub("</?b>", "", block))).split())
        lines += [line] if line else []
    return "\n".join(lines)


def one(markup):
    return extract([markup], default_model())[0]


def test_given_pages_equal_a_direct_version(spark):
    pages = spark.read.parquet(GIVEN)
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract_text(pages).collect()}
    want = {(r.page_id, r.url): (direct(r.html), len(direct(r.html))) for r in pages.collect()}
    assert got == want


@pytest.mark.parametrize("markup, text", [
    (f"<body><nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav><div class='cookie-notice'>We use cookies.</div><main><h1>Title &amp; more</h1><p>{LONG * 3}</p>"
     f"<p>{LONG}</p></main><aside class=sidebar><h3>Related</h3><ul><li><a href=/x>Other</a></ul></aside><section id=comments><p>Nice post!</p></section><footer>&copy; 2024 X</footer>",
     f"Title & more\n{(LONG * 3).strip()}\n{LONG.strip()}"),
    (f"<div id=header><a href=/>Site</a></div><div id=content><h1>T</h1><p>{LONG}<p>{LONG}<form class=newsletter><p>Sign up</p><input><button>Go</button></form></div>"
     "<div id=footer>Copyright 2020 Site</div>", f"T\n{LONG.strip()}\n{LONG.strip()}"),
    (f"<article><h1>T</h1><p>{LONG * 2}</p><div class='ad'>Buy now!</div><ul><li>first thing, said the first man.<li>second thing, said the second man.</ul><div class=share>Share on social</div>"
     f"<p>{LONG * 2}</p></article><div class=comments><div class=comment>{LONG}</div><div class=comment>I agree.</div></div>",
     f"T\n{(LONG * 2).strip()}\nfirst thing, said the first man.\nsecond thing, said the second man.\n{(LONG * 2).strip()}"),
    (f"<html><head><title>x</title><script>if (a < b) document.write('<p>no</p>')</script><style>p > a {{}}</style><body><nav>A | B</nav><article><p>{LONG}a&nbsp;b&#8230;\n\t c<br>d</p></article>",
     f"{LONG}a b… c d"),
])
def test_common_pages(markup, text):
    assert one(markup) == text


def test_made_pages_that_were_not_fitted_on():
    exact, right, extra, lost = 0, 0, 0, 0
    for seed in range(10_000, 10_300):
        markup = page_layouts.layout(seed)
        page = html_dom.parse(markup, page_layouts.MARK)
        want, chars = node_labels(page) > 0, np.array(page.chars)
        bare = html_dom.parse(re.sub(f' {page_layouts.MARK}="."', "", markup))
        kept = html_dom.choose(bare, default_model().logits(html_dom.features(bare)))
        exact += html_dom.kept_text(bare, kept) == html_dom.kept_text(page, want)
        right += chars[kept & want[:len(kept)]].sum() if len(kept) == len(want) else 0
        if len(kept) == len(want):
            extra, lost = extra + chars[kept & ~want].sum(), lost + chars[~kept & want].sum()
    assert exact >= 0.8 * 300 and right / (right + extra) > 0.97 and right / (right + lost) > 0.97


def tree_text(markup):
    page = html_dom.parse(markup)
    return html_dom.kept_text(page, np.ones(len(page.parents), bool))


@pytest.mark.parametrize("markup, text", [
    ("", ""), ("plain &lt;text&gt;\n  here", "plain <text> here"), ("a < b and <3 & c", "a < b and <3 & c"), ("<p>a<p>b</b>c<div>d</div>e", "a\nbc\nd\ne"),
    ("<p><b>x<br><p>y</p>", "x\ny"), ("a<!-- b --> c<!-- d", "a c"), ("<p>a</p><script>x</script ><style>y", "a"), ("<head><title>t</title><p>a", "a"),
    ("<p title='a>b' class=\"c>d\">e</p><p title=it's>f</p>", "e\nf"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"), ("<dl><dt>a<dd>b<dt>c</dl>", "a\nb\nc"),
    ("<table><tr><td>a<td>b<tr><th>c</table>d", "a\nb\nc\nd"), ("<select><option>a</select>b<noscript>c</noscript>", "b"), ("<h2>a</h3>b", "a\nb"),
    ("x<svg><path/><text>no</text></svg>y", "xy"), ("</p></div>a", "a"), ("<p>a<a href=x>b<span class=c>d</span></a>e</p>", "abde"), ("<p", ""), ("a<!doctype x>b<?php c ?>d", "abd"),
    ("<textarea>a<p>b</textarea>c<iframe>d</iframe>", "c"), ("&#0;&#x41;&bogus;&amp", "�A&bogus;&"), ("<P CLASS=A>a</P><BR>b", "a\nb"),
])
def test_parser(markup, text):
    assert tree_text(markup) == text


def test_deep_and_long_pages():
    assert tree_text("<div>" * 20_000 + "deep" + "</div>" * 5) == "deep"
    body = f"<article>{'<p>' + LONG + '</p>'}" * 1 + "".join(f"<p>{LONG}{i}</p>" for i in range(20_000)) + "</article>"
    got = one(f"<nav><a href=/>x</a></nav>{body}")
    assert got.count("\n") == 20_000 and got.endswith("19999")
    assert tree_text("<script>" + "<script>" * 1000) == "" and tree_text("<title>" * 2000 + "a") == "a"


def test_decoding_is_the_best_without_contradictions():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(1, 10))
        page = html_dom.Page()
        for node in range(n):
            page.add("div", int(rng.integers(0, node)) if node else -1)
        logits = rng.normal(size=n) * 2
        best = max(
            sum(logits[i] for i in range(n) if pick[i]) for pick in itertools.product([0, 1], repeat=n)
            if all(not pick[i] or i == 0 or pick[page.parents[i]] for i in range(n))
        )
        kept = html_dom.choose(page, logits)
        assert all(not kept[i] or i == 0 or kept[page.parents[i]] for i in range(n))
        assert abs(logits[kept].sum() - best) < 1e-9


def test_boosting_lowers_the_loss_and_follows_its_trees():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    losses = [boosted_trees.loss(boosted_trees.fit(x, y, trees).logits(x), y) for trees in (1, 5, 40)]
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.1
    forest = boosted_trees.fit(x, y, 5)
    for row, logit in zip(x[:50], forest.logits(x[:50])):
        total = forest.start
        for features, thresholds, leaves in zip(forest.features, forest.thresholds, forest.leaves):
            at = 0
            while at < len(features):
                at = 2 * at + (2 if row[features[at]] > thresholds[at] else 1)
            total += leaves[at - len(features)]
        assert abs(total - logit) < 1e-9


def test_nulls_repeats_and_clashing_columns(spark):
    schema = "page_id long, url string, html string, key string, text string, n_chars string"
    rows = [(1, "u", "<article><p>" + LONG, "k", "t", "n"), (1, "u", "<article><p>" + LONG, "k", "t", "n"), (None, None, None, None, None, None), (2, "", "", "", "", ""), (3, "x", " \n ", None, "", "")]
    got = sorted(extract_text(spark.createDataFrame(rows, schema)).collect(), key=str)
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in got] == sorted(
        [(1, "u", LONG.strip(), len(LONG.strip()))] * 2 + [(None, None, "", 0), (2, "", "", 0), (3, "x", "", 0)], key=lambda r: str(r).replace("(", "Row(page_id=", 1))
    assert extract_text(spark.createDataFrame([], schema)).count() == 0
    assert extract_text(spark.createDataFrame(rows, schema)).columns == ["page_id", "url", "text", "n_chars"]
