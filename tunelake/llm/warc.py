"""Derived WARC records: a metadata and a plain-text conversion record for every response.

Both records name their response in ``WARC-Refers-To`` and keep its target URI and date. The conversion's block is
the page's text; the metadata's block (``application/warc-fields``) holds the source's HTTP headers, its digests
and length, the title, and the links. Digests are SHA-1 in base 32, as archives write them. Record ids are name-based
(version 5) UUIDs of the response's id and the record type, so a run can be repeated.

Text: comments, scripts, styles and the like go, block elements end lines, other tags vanish, character references
are resolved, white space is folded and empty lines are left out. An unclosed comment, script or style reaches to the end of the element it
stands in (head, svg, template) or of the page; any other hidden element without end tag hides nothing but its tag.
A head holds only hidden elements, of which each is left out by itself: what else stands there is text, as a browser
takes it, so the end tag of the head is not needed. A title without end tag ends at the next tag.

Rules: a null or empty payload gives both records, the conversion with an empty block. A null URI or header is left
out of the records, not written as a word. A response without id gets one from its URI and payload. Repeated responses
give repeated records. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tunelake:derived-warc-records")

#: Where something may be hidden: comments and declarations, and the tags of the elements below.
_MARK = re.compile(
    r"<!--|<!\[CDATA\[|\]\]>|<[!?][^>]*>|<(/?)(script|style|noscript|title|svg|template|head)(?=[\s/>])([^>]*)>", re.I
)
#: What ends those whose content is not markup.
_ENDS = {"<!--": re.compile("-->")} | {
    name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in ("script", "style", "noscript")
}
#: A title without end tag does not go on into the body.
_ENDS["title"] = re.compile(r"</title(?=[\s/>])[^>]*>|(?=</head[\s>]|<body[\s/>])", re.I)
#: ``<svg a="b"/>`` is empty, ``<svg a=b/>`` is not: its attribute is ``b/``.
_UNQUOTED = re.compile(r"=\s*[^\s\"'][^\s]*/$")
_BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr"
    r"|html|li|main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>",
    re.I,
)
_TAG = re.compile(r"</?[a-z][^>]*>", re.I)
_TITLE = re.compile(r"<title(?=[\s/>])[^>]*>", re.I)
_LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def _folded(text: str) -> str:
    return " ".join(text.split())


class _Ends:
    """Finds ends from places that only go forward; looks no stretch of the page over twice."""

    def __init__(self, page: str):
        self.page, self.found = page, {}

    def after(self, kind: str, at: int) -> re.Match | None:
        if kind not in self.found or (self.found[kind] and self.found[kind].start() < at):
            self.found[kind] = _ENDS[kind].search(self.page, at)
        return self.found[kind]


def _title_end(ends: _Ends, at: int) -> tuple[int, int]:
    """Where the text of a title that begins here ends, and where its end tag does."""
    found = ends.after("title", at)
    if found and found.group():
        return found.span()
    # No end tag: its text ends at the next tag.
    tag = _TAG.search(ends.page, at)
    end = tag.start() if tag else len(ends.page)
    return end, end


def _hidden(page: str) -> Iterator[tuple[int, int]]:
    """The stretches that are not shown, in the order of their ends; one may lie in a later one."""
    ends, at = _Ends(page), 0
    opened: list[tuple[str, int]] = []
    numbers: Counter[str] = Counter()
    while mark := _MARK.search(page, at):
        begin, at = mark.span()
        closing, name, rest = mark.group(1), (mark.group(2) or "").lower(), mark.group(3)
        if closing:
            if numbers[name]:
                while True:
                    inner, start = opened.pop()
                    numbers[inner] -= 1
                    if inner == name:
                        break
                if name != "head":
                    yield start, at
        elif name in ("svg", "template", "head"):
            if name == "svg" and rest.endswith("/") and not _UNQUOTED.search(rest):
                yield begin, at
            else:
                opened.append((name, begin))
                numbers[name] += 1
        elif name == "title":
            at = _title_end(ends, at)[1]
            yield begin, at
        elif name or mark.group() == "<!--":
            kind = name or "<!--"
            if found := ends.after(kind, at if name else begin + 2):
                at = found.end()
            elif name != "noscript":
                # Unclosed: to the end of the element it stands in, or of the page.
                at = _outer_end(page, at, {outer for outer, count in numbers.items() if count})
            yield begin, at
        else:
            yield begin, at


def _outer_end(page: str, at: int, names: set[str]) -> int:
    found = re.compile(rf"</(?:{'|'.join(sorted(names))})[\s/>]", re.I).search(page, at) if names else None
    return found.start() if found else len(page)


def _shown(page: str) -> str:
    """The page with a space for everything hidden."""
    kept, at = [], 0
    for begin, end in sorted(_hidden(page)):
        if begin >= at:
            kept += [page[at:begin], " "]
        at = max(at, end)
    return "".join([*kept, page[at:]])


def plain_text(page: str | None) -> str:
    """The visible text, one line per block."""
    if not page:
        return ""
    body = _TAG.sub("", _BLOCK.sub("\n", _shown(page).replace("\r", "\n")))
    lines = (_folded(line) for line in html.unescape(body).split("\n"))
    return "\n".join(line for line in lines if line)


def title(page: str | None) -> str:
    found = _TITLE.search(page or "")
    if not found:
        return ""
    return _folded(html.unescape(_TAG.sub("", page[found.end():_title_end(_Ends(page), found.end())[0]])))


def links(page: str | None) -> list[str]:
    """Link targets in order, each once."""
    found = (_folded(html.unescape(a or b or c)) for a, b, c in _LINK.findall(_shown(page or "")))
    return list(dict.fromkeys(link for link in found if link))


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(value: str) -> str:
    return " ".join(value.splitlines())


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as it stands in a file."""
    lines = "".join(f"{name}: {_one_line(value)}\r\n" for name, value in headers)
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record in a file's (uncompressed) bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if first != VERSION:
            raise ValueError(f"not a record: {first[:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers["Content-Length"])
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def compressed(records: list[bytes]) -> bytes:
    """A ``.warc.gz`` body: each record is a gzip member of its own, so that any can be read alone."""
    return b"".join(gzip.compress(record, mtime=0) for record in records)


_COLUMNS = {
    "source_key": "string", "record_type": "string", "record_id": "string", "refers_to": "string",
    "target_uri": "string", "warc_date": "string", "content_type": "string", "content_length": "long",
    "block_digest": "string", "source_block_digest": "string", "source_payload_digest": "string",
    "source_headers": "string", "block": "string", "record": "binary",
}
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _COLUMNS.items())


def _derived(row) -> Iterator[tuple]:
    payload = (row.payload or "").encode("utf-8", "replace")
    headers = row.http_headers or ""
    source_block = headers.encode("utf-8", "replace") + payload
    refers_to = row.record_id or f"<urn:uuid:{uuid.uuid5(_NAMES, f'{row.target_uri}|{digest(payload)}')}>"
    fields = [f"source-http-header: {line}" for line in headers.splitlines() if line]
    fields += [
        f"source-block-digest: {digest(source_block)}", f"source-payload-digest: {digest(payload)}",
        f"source-content-length: {len(source_block)}",
    ]
    name = title(row.payload)
    fields += [f"title: {name}"] if name else []
    fields += [f"outlink: {link}" for link in links(row.payload)]
    blocks = (
        ("metadata", "application/warc-fields", "".join(f"{line}\r\n" for line in fields)),
        ("conversion", "text/plain; charset=utf-8", plain_text(row.payload)),
    )
    for kind, content_type, block in blocks:
        data = block.encode("utf-8", "replace")
        record_id = f"<urn:uuid:{uuid.uuid5(_NAMES, f'{refers_to}|{kind}')}>"
        given = [
            ("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Refers-To", refers_to),
            ("WARC-Target-URI", row.target_uri), ("WARC-Date", row.warc_date), ("WARC-Block-Digest", digest(data)),
            ("Content-Type", content_type), ("Content-Length", str(len(data))),
        ]
        yield (
            row.source_key, kind, record_id, refers_to, row.target_uri, row.warc_date, content_type, len(data),
            digest(data), digest(source_block), digest(payload), row.http_headers, block,
            record_bytes([(name, value) for name, value in given if value is not None], data),
        )


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows per response, ``SCHEMA``, the whole record among them.

    ``responses`` has ``source_key, record_id, target_uri, warc_date, http_headers, payload``, all strings;
    ``source_key`` is handed through.
    """
    def built(batches):
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            rows = [derived for row in batch.itertuples(index=False) for derived in _derived(row)]
            yield pd.DataFrame(rows, columns=list(_COLUMNS))

    wanted = ("source_key", "record_id", "target_uri", "warc_date", "http_headers", "payload")
    return responses.select(*(F.col(name).cast("string").alias(name) for name in wanted)).mapInPandas(built, SCHEMA)


def page_responses(pages: DataFrame, captured: str) -> DataFrame:
    """``pages (page_id, url, html)`` as responses captured at one time; ids follow from page id and URL."""
    code = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "url"))
    parts = [F.substring(code, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(
        F.col("page_id").cast("string").alias("source_key"),
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(captured).alias("warc_date"),
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n").alias("http_headers"),
        F.col("html").alias("payload"),
    )
