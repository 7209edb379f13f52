"""Derived WARC records: metadata and plain-text conversions linked to their responses.

Method. A response record gives two records. The metadata record (application/warc-fields) holds status, source
HTTP headers, language, title and outlinks; the conversion record holds the plain text. Both name the response in
WARC-Refers-To, with its target URI, date and payload digest, carry over its WARC headers that describe the
capture, and the conversion names the metadata record in WARC-Concurrent-To. Identifiers are name-based, so a
task that is run again writes the same records. Digests are SHA-1 in base 32.

Scale. A map over the rows: nothing is shuffled or gathered. ``write_warc`` writes one file per partition.

Cases. Null page: an empty payload, with an empty conversion. Null URL: no target URI header. Null id: an
identifier made from the rest. Bytes that are not UTF-8 are replaced. Repeated rows give repeated records.
Columns other than those named are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"

RECORD_SQL = (
    "page_id long, record_type string, record_id string, refers_to string, concurrent_to string, target_uri string, "
    "headers string, block string, block_digest string, payload_digest string, content_length long"
)
RECORD = pa.schema(
    [("page_id", pa.int64())]
    + [(n, pa.string()) for n in ("record_type", "record_id", "refers_to", "concurrent_to", "target_uri", "headers")]
    + [("block", pa.string()), ("block_digest", pa.string()), ("payload_digest", pa.string()), ("content_length", pa.int64())]
)

#: Headers of a response that describe its capture and go over to what is derived from it.
CARRIED = ("WARC-Date", "WARC-IP-Address", "WARC-Warcinfo-ID", "WARC-Identified-Payload-Type")

_UNSEEN = re.compile(r"<(script|style|noscript|template|head)\b", re.I)
_CLOSING = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "head", "title")}
_BREAK = re.compile(
    r"<(?:br|/?(?:p|div|li|ul|ol|h[1-6]|tr|table|section|article|nav|footer|header|blockquote|pre|title))\b[^>]*>", re.I
)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*>")
_SPACES = re.compile(r"[ \t\f\v ]+")
_LINES = re.compile(r" ?(?:\r\n|\r|\n) ?(?:\s*\n)?")
_TITLE = re.compile(r"<title", re.I)
_HTML = re.compile(r"<html", re.I)
_LANG = re.compile(r"\blang\s*=", re.I)
_LANGUAGE = re.compile(r"\s*[\"']?([\w-]+)")
_ANCHOR = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_TARGET = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")


# Pages may hold any number of tags that never close. Everything below goes forward: what was looked for in vain is not
# looked for again, and what was found is jumped over, so time follows the length of the page.


def without_spans(page: str, spans: Iterable[tuple[int, int]]) -> str:
    """The page without some spans, in order."""
    out, at = [], 0
    for begin, end in spans:
        out.append(page[at:begin])
        at = end
    return "".join([*out, page[at:]])


def comments(page: str) -> Iterator[tuple[int, int]]:
    at = page.find("<!--")
    while at >= 0 and (end := page.find("-->", at + 4)) >= 0:
        yield at, end + 3
        at = page.find("<!--", end + 3)


def unseen(page: str) -> Iterator[tuple[int, int]]:
    """Elements whose content is not shown, up to the first closing tag of their name."""
    never, at = set(), 0
    while opening := _UNSEEN.search(page, at):
        name, at = opening[1].lower(), opening.end()
        if name not in never:
            if closing := _CLOSING[name].search(page, at):
                at = closing.end()
                yield opening.start(), at
            else:
                never.add(name)


def without_tags(page: str, tag: re.Pattern, instead: str = "") -> str:
    """The page with its tags replaced; behind the last ``>`` no tag ends, and before it every one does."""
    end = page.rfind(">") + 1
    return tag.sub(instead, page[:end]) + page[end:]


def title_of(page: str) -> str | None:
    if (begin := _TITLE.search(page)) and (end := page.find(">", begin.end())) >= 0:
        if closing := _CLOSING["title"].search(page, end + 1):
            return page[end + 1 : closing.start()]
    return None


def language_of(page: str) -> str | None:
    """The last language named in the first ``html`` tag that names one."""
    at = 0
    while begin := _HTML.search(page, at):
        end = page.find(">", begin.end())
        inner = page[begin.end() : end if end >= 0 else len(page)]
        for named in reversed(list(_LANG.finditer(inner))):
            if told := _LANGUAGE.match(inner, named.end()):
                return told[1]
        if end < 0:
            return None
        at = end
    return None


def targets(page: str) -> Iterator[str]:
    """What the anchors of the page refer to, each by its first ``href``."""
    refers = [(m.start(), m.end()) for m in _HREF.finditer(page)]
    starts = [begin for begin, _ in refers]
    at = 0
    while begin := _ANCHOR.search(page, at):
        end = page.find(">", begin.end())
        end = len(page) if end < 0 else end
        at = end
        for place in range(bisect_left(starts, begin.end()), bisect_left(starts, end)):
            if told := _TARGET.match(page, refers[place][1]):
                yield next(t for t in told.groups() if t is not None)
                at = told.end()
                break


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*names: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(map(str, names)))}>"


def one_line(text: str) -> str:
    return " ".join(entities.unescape(without_tags(text, _TAG)).split())


def plain_text(page: str) -> str:
    """Visible text; block elements and breaks end a line."""
    page = without_spans(page, comments(page))
    page = without_spans(page, unseen(page))
    page = page.replace("\r\n", " ").replace("\r", " ").replace("\n", " ")
    page = without_tags(without_tags(page, _BREAK, "\n"), _TAG)
    return _LINES.sub("\n", _SPACES.sub(" ", entities.unescape(page))).strip()


def parse_http(block: str) -> tuple[str, list[tuple[str, str]], str]:
    """Status, headers and payload of an HTTP response."""
    head, _, payload = block.partition(CRLF * 2)
    first, *lines = head.split(CRLF)
    pairs = [tuple(x.strip() for x in line.split(":", 1)) for line in lines if ":" in line]
    return (first.split(" ") + ["", ""])[1], pairs, payload


def parse_headers(headers: str) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in headers.split(CRLF)[1:] if ":" in line)
    return {k.strip(): v.strip() for k, v in pairs}


def header_block(fields: Iterable[tuple[str, str | None]]) -> str:
    return CRLF.join([VERSION, *(f"{k}: {one_line_header(v)}" for k, v in fields if v is not None)])


def one_line_header(value: str) -> str:
    return value.replace("\r", " ").replace("\n", " ")


def _record(page_id, kind: str, ident: str, block: str, fields: list, target, payload: str, refers=None, beside=None) -> tuple:
    data = block.encode()
    whole = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", ident),
        ("WARC-Target-URI", target),
        ("WARC-Refers-To", refers),
        ("WARC-Concurrent-To", beside),
        *fields,
        ("WARC-Block-Digest", digest(data)),
        ("WARC-Payload-Digest", payload),
        ("Content-Length", str(len(data))),
    ]
    return page_id, kind, ident, refers, beside, target, header_block(whole), block, digest(data), payload, len(data)


def response(page_id: int | None, url: str | None, page: str | None, date: str = DATE) -> tuple:
    """A response record around a stored page."""
    body = page or ""
    size = len(body.encode())
    block = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {size}{CRLF * 2}{body}"
    fields = [
        ("WARC-Date", date),
        ("WARC-Identified-Payload-Type", "text/html"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    return _record(page_id, "response", record_id("response", page_id, url, body), block, fields, url, digest(body.encode()))


def derived(source: tuple) -> list[tuple]:
    """The metadata and the conversion record of a response record."""
    page_id, _, ident, _, _, target, headers, block, _, payload, _ = source
    status, http, page = parse_http(block)
    carried = parse_headers(headers)
    common = [(k, carried[k]) for k in CARRIED if k in carried]
    common += [("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", carried.get("WARC-Date"))]
    found = [("http-status", status), *((f"http-header-{k.lower()}", v) for k, v in http)]
    if (told := language_of(page)) is not None:
        found.append(("language", told.lower()))
    if (title := title_of(page)) is not None:
        found.append(("title", one_line(title)))
    found.append(("source-payload-digest", payload))
    links = map(entities.unescape, targets(page))
    found += [("outlink", f"{one_line_header(link)} L a/@href") for link in links if link]
    about = record_id("metadata", ident)
    fields = CRLF.join(f"{k}: {one_line_header(v)}" for k, v in found) + CRLF
    first = _record(
        page_id, "metadata", about, fields, [*common, ("Content-Type", "application/warc-fields")], target, payload, ident
    )
    text = plain_text(page)
    kept = [*common, ("Content-Type", "text/plain; charset=utf-8")]
    second = _record(page_id, "conversion", record_id("conversion", ident), text, kept, target, payload, ident, about)
    return [first, second]


def _batched(batches: Iterable[pa.RecordBatch], make) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [r for row in zip(*[c.to_pylist() for c in batch.columns], strict=True) for r in make(row)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORD, strict=True)], schema=RECORD
            )


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of ``pages(page_id, url, html)``."""
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(lambda b: _batched(b, lambda r: [response(*r, date)]), RECORD_SQL)


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the response records; others give nothing."""
    rows = records.filter("record_type = 'response'").select(*RECORD.names)
    return rows.mapInArrow(lambda b: _batched(b, derived), RECORD_SQL)


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Records as WARC files, one per partition."""
    text = F.concat("headers", F.lit(CRLF * 2), "block")
    writer = records.select(text.alias("value")).write.option("lineSep", CRLF * 2).option("compression", compression)
    writer.mode("overwrite").text(path)
