"""WARC derivatives: metadata and plain-text conversion records of responses.

Each response gives two records that refer to it: ``metadata``
(application/warc-fields: the source's HTTP status and headers, its digests,
title, language and links) and ``conversion`` (text/plain).  Record ids are
derived from the response's id, so a rerun gives the same records.  The records'
bytes can be written as WARC files with Spark's text writer, whose line
separator is the blank line that ends a record.

Null payloads are empty; a null or empty URI leaves its header out; a response
without an id has no derivative, as nothing could refer to it.  Unclosed tags,
comments and scripts end with the text.  Repeated responses give repeated
records.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"<!--|<[!?][^<>]*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)([^<>]*)>")
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)
_BLANKS = re.compile(r"[ \t\r\f\v ]+")
_LINES = re.compile(r" ?\n[ \n]*")

# Elements whose content is no text, and elements that end a line.
HIDDEN = {"script", "style", "noscript", "template", "svg", "iframe", "object"}
LINES = {"address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
         "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "option", "p", "pre", "section",
         "table", "td", "th", "tr", "ul", "title", "body", "head", "html"}

COLUMNS = ["warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "content_length", "block_digest",
           "source_block_digest", "source_payload_digest", "n_links", "block"]
SCHEMA = ("warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
          "content_length long, block_digest string, source_block_digest string, source_payload_digest string, n_links long, block string")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(record_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}#{kind}')}>"


def read_html(html: str) -> tuple[str, str, str, list[str]]:
    """Plain text, title, language and link targets; one pass over the page."""
    out: list[str] = []
    links: list[str] = []
    title, lang, at, hidden_to = "", "", 0, None
    low = None
    while m := _TAG.search(html, at):
        out.append(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0] == "<!--":
                end = html.find("-->", at)
                at = len(html) if end < 0 else end + 3
            continue
        name = m[2].lower()
        if not m[1]:
            if name in HIDDEN or name == "title":
                if low is None:
                    low = html.lower() if len(html.lower()) == len(html) else html
                end = low.find(f"</{name}", at)
                end = len(html) if end < 0 else end
                if name == "title" and not title:
                    title = _BLANKS.sub(" ", unescape(html[at:end]).replace("\n", " ")).strip()
                at = end
            elif name == "a" and (h := _HREF.search(m[3])):
                links.append(unescape(h[1] or h[2] or h[3] or "").strip())
            elif name == "html" and (h := _LANG.search(m[3])):
                lang = h[1]
        if name in LINES:
            out.append("\n")
    out.append(html[at:])
    text = _LINES.sub("\n", _BLANKS.sub(" ", unescape("".join(out)))).strip()
    return text, title, lang, [x for x in links if x]


def derive(record_id: str, uri: str | None, date: str, http: str, payload: str) -> list[tuple]:
    """The two derivative records of one response."""
    body = payload.encode("utf-8", "surrogatepass")
    head = http.encode("utf-8", "surrogatepass")
    source_block, source_payload = digest(head + body), digest(body)
    text, title, lang, links = read_html(payload)
    status, *headers = http.split("\r\n") if http else [""]
    fields = [("source-status", status)] if status else []
    fields += [(f"source-header-{k.strip().lower()}", v.strip()) for k, _, v in (h.partition(":") for h in headers if h)]
    fields += [("source-block-digest", source_block), ("source-payload-digest", source_payload), ("source-payload-length", str(len(body)))]
    fields += [(k, v) for k, v in (("title", title), ("language", lang)) if v]
    fields += [("outlink", re.sub(r"\s+", "%20", x)) for x in links]
    rows = []
    for kind, media, block in (("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields)),
                               ("conversion", "text/plain; charset=UTF-8", text)):
        data = block.encode("utf-8", "replace")
        rows.append((kind, derived_id(record_id, kind), record_id, uri or None, date, media, len(data), digest(data), source_block,
                     source_payload, len(links), data.decode()))
    return rows


def derivatives(responses: DataFrame) -> DataFrame:
    """Derivative records of ``responses`` (key, record_id, target_uri, warc_date,
    http, payload); ``http`` is the status line and headers, with CRLFs.  No shuffle."""
    rows = responses.select("key", "record_id", "target_uri", "warc_date", "http", "payload").filter("record_id is not null")
    key = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, out = [], []
            for k, rid, uri, date, http, payload in zip(*(c.to_pylist() for c in b.columns)):
                out += derive(rid, uri, date or "", http or "", payload or "")
                keys += [k, k]
            cols = list(zip(*out)) if out else [[]] * len(COLUMNS)
            yield pa.record_batch([pa.array(keys, b.column(0).type), *[
                pa.array(c, pa.int64() if n in ("content_length", "n_links") else pa.string()) for n, c in zip(COLUMNS, cols)]],
                names=["key", *COLUMNS])

    return rows.mapInArrow(run, f"key {key}, {SCHEMA}")


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages as responses: an id from page id and URL, and the headers of a plain answer."""
    h = F.sha1(F.concat_ws("|", F.col(id_col).cast("string"), F.col(url_col)).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    rid = F.concat(F.lit("<urn:uuid:"), parts[0], F.lit("-"), parts[1], F.lit("-5"), parts[2], F.lit("-8"), parts[3], F.lit("-"), parts[4], F.lit(">"))
    html = F.coalesce(F.col(html_col), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(F.col(id_col).alias("key"), F.when(F.col(id_col).isNotNull(), rid).alias("record_id"), F.col(url_col).alias("target_uri"),
                        F.lit(date).alias("warc_date"), http.alias("http"), html.alias("payload"))


def serialised(records: DataFrame) -> DataFrame:
    """One column ``record``: header lines, blank line and block, without the final blank lines."""
    line = lambda name, c: F.concat(F.lit(f"{name}: "), F.col(c).cast("string"), F.lit("\r\n"))
    return records.select(F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", "warc_type"), line("WARC-Record-ID", "record_id"), line("WARC-Refers-To", "refers_to"),
        F.coalesce(line("WARC-Target-URI", "target_uri"), F.lit("")), line("WARC-Date", "warc_date"),
        line("WARC-Block-Digest", "block_digest"), line("Content-Type", "content_type"), line("Content-Length", "content_length"),
        F.lit("\r\n"), F.col("block")).alias("record"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files under ``path``, one per partition."""
    serialised(records).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)
