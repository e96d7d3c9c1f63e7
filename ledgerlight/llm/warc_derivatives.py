"""WARC derivatives: response records, and the metadata and plain-text conversion records made from them.

A response record keeps a page with its HTTP headers. Its metadata record tells about the source (type, status, sizes, digests, title,
links); its conversion record holds the page's visible text. Both refer to the response by identifier, target and date, repeat its
digests, and carry digests of their own. Identifiers are derived from the content, so equal input gives equal records.

Defined cases: a null url leaves the target out, a null html is an empty payload, a null key is empty in the identifier; repeated rows give
repeated records with equal identifiers; an empty table gives none; other columns are ignored. A null response gives one row of type
``missing`` whose other columns are null. Records that can't be read (no version line, wrong length) raise an error that names them.
Source headers are kept as they come, repeated ones too, in order, folded lines joined. Digests are those of the stored bytes; for the
text chunks are joined and gzip and deflate undone, and what can't be undone is named in the metadata: of a broken body the part
before the fault is used, of an unknown coding nothing. A page of any length is converted whole, in one pass over its markup.
A head without end tag ends before the first text or tag that can't stand in it; other hidden elements without end tag hide nothing,
but scripts, styles and comments hide the rest of the page.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - makes pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the formats.
VERSION = "WARC/1.1"
RESPONSE_TYPE = "application/http; msgtype=response"
METADATA_TYPE = "application/warc-fields"
TEXT_TYPE = "text/plain; charset=utf-8"
#: Elements whose content isn't shown, and elements that begin a new line.
HIDDEN = ("script", "style", "head", "noscript", "template")
BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main "
    "nav ol p pre section table tbody td tfoot th thead title tr ul".split()
)

#: Elements that can stand in a head: without content, and with content that isn't shown.
HEAD_EMPTY = frozenset("base basefont bgsound link meta".split())
HEAD_FULL = ("title", "script", "style", "noscript", "noframes", "template")
#: Elements that take up the rest of the page where they aren't closed.
UNBOUNDED = ("script", "style")

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9]*)(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|<[!?][^>]*+>", re.S)
_TITLE = re.compile(r"<title\b[^>]*+>(.*?)</title\s*>", re.S | re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.S | re.I)
_END = {name: re.compile(rf"</{name}\b[^>]*+>", re.I) for name in {*HIDDEN, *HEAD_FULL}}


def digest(content: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(content).digest()).decode()


def identifier(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def header_value(text: str) -> str:
    """A text as one header line: control characters become spaces."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", text).strip()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {header_value(value)}" for name, value in headers if value), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, found, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {content[:40]!r}")
    headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    length = int(headers.get("content-length", -1))
    if length < 0 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"wrong length of {headers.get('warc-record-id', 'a record')}")
    return headers, rest[:length]


class _Skipper:
    """Ends of elements that aren't shown; no end tag is looked for again once a page has no more of them."""

    def __init__(self, markup: str):
        self.markup, self.missing = markup, set()

    def element(self, name: str, at: int) -> int:
        """Where the element whose tag ends at ``at`` ends; without an end tag only scripts and styles go on to the page's end."""
        end = None if name in self.missing else _END[name].search(self.markup, at)
        if end:
            return end.end()
        self.missing.add(name)
        return len(self.markup) if name in UNBOUNDED else at

    def head(self, at: int) -> int:
        """Where a head ends: after its end tag, or before the first text or tag that can't stand in a head."""
        while found := _MARKUP.search(self.markup, at):
            name, closing = (found.group(2) or "").lower(), found.group(1)
            if self.markup[at:found.start()].strip():
                return at
            if closing and name in ("head", "body", "html", "br"):
                return found.end() if name == "head" else found.start()
            if not closing and name in HEAD_FULL:
                at = self.element(name, found.end())
            elif closing or not name or name in HEAD_EMPTY or name == "head":
                at = found.end()
            else:
                return found.start()
        return at


def visible_text(markup: str) -> str:
    """The text of a page: one line for each block, runs of white space as one space, empty lines left out."""
    pieces, at, skip = [], 0, _Skipper(markup)
    while found := _MARKUP.search(markup, at):
        pieces.append(markup[at:found.start()])
        at = found.end()
        name = (found.group(2) or "").lower()
        if name in BLOCKS:
            pieces.append("\0")
        elif name in HIDDEN and not found.group(1):
            at = skip.head(at) if name == "head" else skip.element(name, at)
            pieces.append("\0")
    pieces.append(markup[at:])
    lines = (" ".join(entities.unescape(line).split()) for line in "".join(pieces).split("\0"))
    return "\n".join(line for line in lines if line)


def response_record(key: str, url: str, page: str, date: str) -> bytes:
    payload = page.encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    return record([
        ("WARC-Type", "response"), ("WARC-Record-ID", identifier("response", key, url, digest(payload))), ("WARC-Date", date),
        ("WARC-Target-URI", url), ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(http + payload)), ("Content-Type", RESPONSE_TYPE),
    ], http + payload)


class Headers(dict):
    """The first value of each header, names in lower case; ``pairs`` has all of them in order."""

    def __init__(self, lines: list[str]):
        self.pairs: list[tuple[str, str]] = []
        for line in lines:
            if line[:1] in (" ", "\t") and self.pairs:  # a folded line goes on with the one before
                name, value = self.pairs[-1]
                self.pairs[-1] = (name, f"{value} {line.strip()}".strip())
            elif ":" in line:
                name, _, value = line.partition(":")
                self.pairs.append((name.strip().lower(), value.strip()))
        super().__init__(reversed(self.pairs))

    def codings(self, name: str) -> list[str]:
        """The codings that headers of this name list, in the order in which they were applied."""
        values = ",".join(value for key, value in self.pairs if key == name)
        return [part.strip().lower() for part in values.split(",") if part.strip() and part.strip().lower() != "identity"]


def http_parts(block: bytes) -> tuple[str, Headers, bytes]:
    """Status line, headers and payload of a response block."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("latin-1").split("\r\n")
    return status, Headers(lines), payload


def unchunk(body: bytes) -> tuple[bytes, bool]:
    """The joined chunks, and whether the body was whole."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return b"".join(out), False
        length = int(size, 16)
        if length == 0:
            return b"".join(out), True
        out.append(body[end + 2:end + 2 + length])
        at = end + 2 + length
        if body[at:at + 2] != b"\r\n":
            return b"".join(out), False
        at += 2


def inflate(body: bytes, coding: str) -> tuple[bytes, bool]:
    """The body without gzip (all of its members) or deflate (with or without a zlib header), and whether it was whole."""
    out = []
    raw = coding == "deflate" and not (len(body) > 1 and body[0] & 15 == 8 and (body[0] << 8 | body[1]) % 31 == 0)
    while body:
        stream = zlib.decompressobj(31 if coding == "gzip" else -15 if raw else 15)
        try:
            # by pieces, so that a fault loses only what lies behind it
            for at in range(0, len(body), 4096):
                out.append(stream.decompress(body[at:at + 4096]))
                if stream.eof:
                    body = stream.unused_data + body[at + 4096:]
                    break
            else:
                return b"".join(out), False
        except zlib.error:
            return b"".join(out), False
        if coding != "gzip" or body[:2] != b"\x1f\x8b":
            return b"".join(out), True
    return b"".join(out), True


def decoded(http: Headers, payload: bytes) -> tuple[bytes, list[str]]:
    """The payload without transfer and content codings, and what could not be undone."""
    faults = []
    for name in ("transfer-encoding", "content-encoding"):
        for coding in reversed(http.codings(name)):
            coding = coding.removeprefix("x-")
            if coding == "chunked":
                payload, whole = unchunk(payload)
            elif coding in ("gzip", "deflate"):
                payload, whole = inflate(payload, coding)
            else:
                return b"", [*faults, f"unknown {coding}"]
            faults += [] if whole else [f"broken {coding}"]
    return payload, faults


def derivatives(response: bytes) -> tuple[bytes, bytes]:
    """The metadata and the conversion record of a response record."""
    source, block = parse(response)
    if source.get("warc-type") != "response":
        raise ValueError(f"{source.get('warc-record-id')} is no response")
    status, http, payload = http_parts(block)
    charset = re.search(r"charset=\"?([\w-]+)", http.get("content-type", ""))
    body, faults = decoded(http, payload)
    try:
        page = body.decode(charset.group(1) if charset else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    text = visible_text(page).encode()
    name, target = source["warc-record-id"], source.get("warc-target-uri", "")
    linked = [
        ("WARC-Date", source.get("warc-date", "")), ("WARC-Target-URI", target), ("WARC-Refers-To", name),
        ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", source.get("warc-date", "")),
    ]
    conversion_id, metadata_id = identifier("conversion", name, digest(text)), identifier("metadata", name)
    title = _TITLE.search(page)
    fields = [
        ("source-record-id", name), ("source-payload-digest", source.get("warc-payload-digest") or digest(payload)),
        ("source-block-digest", source.get("warc-block-digest") or digest(block)), ("source-status", status),
        *((f"source-header-{key}", value) for key, value in http.pairs), *(("source-body-fault", fault) for fault in faults),
        ("conversion-record-id", conversion_id), ("conversion-digest", digest(text)), ("text-bytes", str(len(text))),
        ("title", " ".join(entities.unescape(title.group(1)).split()) if title else ""),
        *(("outlink", entities.unescape(next(x for x in link if x))) for link in _LINK.findall(page) if any(link)),
    ]
    about = "".join(f"{key}: {header_value(value)}\r\n" for key, value in fields if value).encode()
    metadata = record([
        ("WARC-Type", "metadata"), ("WARC-Record-ID", metadata_id), *linked, ("WARC-Concurrent-To", conversion_id),
        ("WARC-Block-Digest", digest(about)), ("Content-Type", METADATA_TYPE),
    ], about)
    conversion = record([
        ("WARC-Type", "conversion"), ("WARC-Record-ID", conversion_id), *linked, ("WARC-Source-Payload-Digest", fields[1][1]),
        ("WARC-Block-Digest", digest(text)), ("WARC-Payload-Digest", digest(text)), ("Content-Type", TEXT_TYPE),
    ], text)
    return metadata, conversion


def response_records(pages: DataFrame, date: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, response: each page as a response record."""
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    source = pages.select(F.col(key).alias("key"), empty(url).alias("url"), empty(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = ["" if k is None else str(k) for k in batch.column("key").to_pylist()]
            out = [response_record(k, u.as_py(), h.as_py(), date) for k, u, h in zip(keys, batch.column("url"), batch.column("html"))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary())], ["key", "response"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, response binary").withColumnRenamed("key", key)


def build_derivatives(responses: DataFrame, key: str = "page_id", response: str = "response") -> DataFrame:
    """key, type, record_id, refers_to, payload_digest, block_digest, content (the block) and record of the two derived records."""
    source = responses.select(F.col(key).alias("key"), F.col(response).alias("response"))
    names = ["record_id", "refers_to", "source_payload_digest", "block_digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                missing = pa.compute.indices_nonzero(some.column("response").is_null())
                if len(missing):
                    nothing = [pa.nulls(len(missing), kind) for kind in (*[pa.string()] * len(names), pa.binary(), pa.binary())]
                    yield pa.RecordBatch.from_arrays(
                        [some.column("key").take(missing), pa.array(["missing"] * len(missing)), *nothing], ["key", "type", *names, "content", "record"],
                    )
                made = [(k, x) for k, r in zip(range(some.num_rows), some.column("response").to_pylist()) if r is not None for x in derivatives(r)]
                parsed = [parse(x) for _, x in made]
                fields = [dict(line.split(": ", 1) for line in b.decode().split("\r\n") if ": " in line) if h["warc-type"] == "metadata" else {} for h, b in parsed]
                columns = [
                    [h["warc-record-id"] for h, _ in parsed], [h["warc-refers-to"] for h, _ in parsed],
                    [f.get("source-payload-digest") or h.get("warc-source-payload-digest") for (h, _), f in zip(parsed, fields)],
                    [h["warc-block-digest"] for h, _ in parsed],
                ]
                yield pa.RecordBatch.from_arrays([
                    some.column("key").take(pa.array([k for k, _ in made], pa.int64())), pa.array([h["warc-type"] for h, _ in parsed], pa.string()),
                    *(pa.array(column, pa.string()) for column in columns), pa.array([b for _, b in parsed], pa.binary()), pa.array([x for _, x in made], pa.binary()),
                ], ["key", "type", *names, "content", "record"])

    kind = source.schema["key"].dataType.simpleString()
    schema = f"key {kind}, type string, {', '.join(f'{name} string' for name in names)}, content binary, record binary"
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)
