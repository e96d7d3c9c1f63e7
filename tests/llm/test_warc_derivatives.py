import base64
import email.parser
import gzip
import hashlib
import html.parser
import zlib

import pytest

from ledgerlight.llm import queries as Q
from ledgerlight.llm import warc_derivatives as X


def fields(content):
    out = {}
    for line in content.decode().split("\r\n"):
        if line:
            name, value = line.split(": ", 1)
            out.setdefault(name, []).append(value)
    return out


def test_whole_table_links_and_digests(spark):
    pages = Q.table(spark, "/root/testdata/sf0.001", "pages")
    responses = {r.page_id: bytes(r.response) for r in X.response_records(pages, Q.CAPTURED).collect()}
    rows = X.build_derivatives(X.response_records(pages, Q.CAPTURED)).collect()
    source = {r.page_id: r for r in pages.collect()}
    assert len(rows) == 2 * len(source) and len(responses) == len(source)
    by = {(r.page_id, r.type): r for r in rows}
    for key, page in source.items():
        headers, block = X.parse(responses[key])
        status, http, payload = X.http_parts(block)
        assert payload.decode() == page.html and status == "HTTP/1.1 200 OK"
        assert headers["warc-block-digest"] == X.digest(block) and headers["warc-target-uri"] == X.header_value(page.url)
        meta, text = by[key, "metadata"], by[key, "conversion"]
        about = fields(bytes(meta.content))
        assert meta.refers_to == text.refers_to == headers["warc-record-id"]
        assert about["conversion-record-id"] == [text.record_id] and about["source-payload-digest"] == [X.digest(payload)]
        assert about["source-header-content-type"] == [http["content-type"]]
        for row in (meta, text):
            parsed, content = X.parse(bytes(row.record))
            assert content == bytes(row.content) and parsed["warc-block-digest"] == X.digest(content) == row.block_digest
            assert parsed["warc-refers-to-target-uri"] == headers["warc-target-uri"] and parsed["warc-refers-to-date"] == Q.CAPTURED
        assert b"track(" not in text.content and b"<p>" not in text.content
    found = {(r.page_id, r.type): r for r in Q.QUERIES["op3_warc_derivatives"](spark, "/root/testdata/sf0.001").collect()}
    assert found.keys() == by.keys()
    for name, row in found.items():
        assert row.content_sha256 == hashlib.sha256(bytes(by[name].content)).hexdigest()


@pytest.mark.parametrize("markup, text", [
    ("", ""), ("plain", "plain"), ("<p>a<b>b</b> c</p>d<br>e", "ab c\nd\ne"), ("a<!-- x > y -->b<script>var t='</p>';</script>c", "ab\nc"),
    ("<style>p{}</style>x &amp; y&nbsp;z &lt;b&gt;", "x & y z <b>"), ("<div title=\"a>b\">t</div>", "t"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<script>never closed", ""), ("<!-- never closed", ""), ("<head><title>T</title></head><body>x", "x"), ("<SCRIPT>a</SCRIPT >b", "b"),
])
def test_visible_text(markup, text):
    assert X.visible_text(markup) == text


@pytest.mark.parametrize("markup, text", [
    ("<head><title>T</title><body>text", "text"), ("<html><head><meta a=b><link c><p>one<p>two", "one\ntwo"), ("<head><title>T</title>text<p>more", "text\nmore"),
    ("<head><!-- c --><style>s{}</style><script>var x='</head>';</script> <title>T</title></head>x", "x"), ("<head><noscript>n</noscript><div>d</div>", "d"),
    ("a<noscript>b", "a\nb"), ("a<template>b<p>c", "a\nb\nc"), ("<head><title>never closed<p>x", "never closed\nx"), ("<head></title></html>x", "x"),
    ("<head><script>never closed<body>x", ""), ("<head>", ""), ("<noscript>" * 20000 + "x", "x"),
])
def test_pages_with_elements_that_are_not_closed(markup, text):
    assert X.visible_text(markup) == text


def test_long_markup_is_linear():
    assert X.visible_text("<" * 20000) == "<" * 20000
    assert X.visible_text("<p " + "a=\"b\" " * 20000) == X.visible_text("<p " + "a=\"b\" " * 20000)
    assert len(X.visible_text("<p>word</p>" * 30000).split("\n")) == 30000


def test_nulls_repeated_rows_other_columns_and_broken_records(spark):
    schema = "page_id long, url string, html string, response string, type int"
    pages = spark.createDataFrame([(1, None, None, "x", 1), (None, "u\r\nWARC-Type: x", "<p>é", None, None), (1, None, None, "y", 2)], schema)
    rows = X.build_derivatives(X.response_records(pages, Q.CAPTURED)).collect()
    assert len(rows) == 6 and len({r.record_id for r in rows}) == 4
    assert {bytes(r.content).decode() for r in rows if r.type == "conversion"} == {"", "é"}
    assert X.build_derivatives(X.response_records(pages.limit(0), Q.CAPTURED)).collect() == []
    good = X.response_record("1", "u", "<p>x", Q.CAPTURED)
    for broken in (b"", b"nothing", good[:-1], good + b"x", good.replace(b"response\r\n", b"request\r\n", 1)):
        with pytest.raises(ValueError):
            X.derivatives(broken)


class PlainText(html.parser.HTMLParser):
    """Text by the standard library's parser: another way to the visible text of well-formed pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.lines = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in X.HIDDEN
        if tag in X.BLOCKS:
            self.lines.append("")

    def handle_endtag(self, tag):
        self.hidden -= tag in X.HIDDEN
        if tag in X.BLOCKS:
            self.lines.append("")

    def handle_data(self, data):
        if not self.hidden:
            self.lines[-1] += data


def test_whole_table_against_other_parsers(spark):
    """Records read by the mail parser, digests by base64 and sha1, texts by the standard library, for every page of the given table."""
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in Q.table(spark, folder, "pages").collect()}
    rows = X.build_derivatives(X.response_records(Q.table(spark, folder, "pages"), Q.CAPTURED)).collect()
    assert len(rows) == 2 * len(pages)
    for row in rows:
        page = pages[row.page_id].html
        head, _, rest = bytes(row.record).partition(b"\r\n\r\n")
        first, _, lines = head.partition(b"\r\n")
        headers = email.parser.BytesHeaderParser().parsebytes(lines + b"\r\n\r\n")
        block = rest[:int(headers["Content-Length"])]
        sha1 = lambda content: "sha1:" + base64.b32encode(hashlib.sha1(content).digest()).decode()
        assert first == b"WARC/1.1" and rest[len(block):] == b"\r\n\r\n" and block == bytes(row.content)
        assert headers["WARC-Block-Digest"] == sha1(block) == row.block_digest and row.source_payload_digest == sha1(page.encode())
        assert headers["WARC-Target-URI"] == headers["WARC-Refers-To-Target-URI"] == pages[row.page_id].url
        if row.type == "conversion":
            parser = PlainText()
            parser.feed(page)
            parser.close()
            lines = (" ".join(line.split()) for line in parser.lines)
            assert block.decode() == "\n".join(line for line in lines if line)


def response(headers, body):
    block = b"HTTP/1.1 200 OK\r\n" + b"".join(f"{name}: {value}\r\n".encode() for name, value in headers) + b"\r\n" + body
    return X.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Date", Q.CAPTURED), ("WARC-Target-URI", "u")], block)


def text_and_fields(headers, body):
    metadata, conversion = X.derivatives(response(headers, body))
    return X.parse(conversion)[1].decode(), fields(X.parse(metadata)[1])


def chunked(body, size=7):
    return b"".join(b"%x;ext=1\r\n%s\r\n" % (len(body[i:i + size]), body[i:i + size]) for i in range(0, len(body), size)) + b"0\r\nTrailer: x\r\n\r\n"


def test_repeated_and_folded_headers_are_kept():
    text, about = text_and_fields([("Set-Cookie", "a=1"), ("X-Long", "one\r\n two"), ("set-cookie", "b=2"), ("Empty", "")], b"<p>x")
    assert (text, about["source-header-set-cookie"], about["source-header-x-long"]) == ("x", ["a=1", "b=2"], ["one two"])


PAGE = "<p>Grüße &amp; more</p>".encode() * 500
BARE = zlib.compressobj(wbits=-15)
BARE_PAGE = BARE.compress(PAGE) + BARE.flush()


@pytest.mark.parametrize("headers, body", [
    ([("Content-Encoding", "gzip")], gzip.compress(PAGE)), ([("Content-Encoding", "x-gzip")], gzip.compress(PAGE[:46]) + gzip.compress(PAGE[46:])),
    ([("Content-Encoding", "deflate")], zlib.compress(PAGE)), ([("Content-Encoding", "deflate")], BARE_PAGE), ([("Transfer-Encoding", "chunked")], chunked(PAGE)),
    ([("Transfer-Encoding", "chunked"), ("Content-Encoding", "gzip")], chunked(gzip.compress(PAGE))), ([("Transfer-Encoding", "gzip, chunked")], chunked(gzip.compress(PAGE), 1000)),
    ([("Content-Encoding", "deflate"), ("Content-Encoding", "gzip")], gzip.compress(zlib.compress(PAGE))), ([("Content-Encoding", "identity")], PAGE),
])
def test_codings_are_undone(headers, body):
    text, about = text_and_fields([("Content-Type", "text/html; charset=utf-8"), *headers], body)
    assert text == "\n".join(["Grüße & more"] * 500) and "source-body-fault" not in about
    assert about["source-payload-digest"] == [X.digest(body)]


def test_faults_are_named():
    whole = gzip.compress(bytes(range(97, 123)) * 4000)
    text, about = text_and_fields([("Content-Encoding", "gzip")], whole[:-30])
    assert about["source-body-fault"] == ["broken gzip"] and len(text) > 1000
    text, about = text_and_fields([("Transfer-Encoding", "chunked")], b"5\r\nhello\r\nzz\r\n")
    assert (text, about["source-body-fault"]) == ("hello", ["broken chunked"])
    assert text_and_fields([("Content-Encoding", "br")], b"xyz")[1]["source-body-fault"] == ["unknown br"]
    assert text_and_fields([("Content-Encoding", "gzip")], b"not compressed")[0] == ""


def test_missing_responses_are_told(spark):
    rows = X.build_derivatives(spark.createDataFrame([(1, None), (2, response([], b"<p>x"))], "page_id long, response binary")).collect()
    assert sorted((r.page_id, r.type) for r in rows) == [(1, "missing"), (2, "conversion"), (2, "metadata")]
    assert next(r for r in rows if r.type == "missing").record is None
