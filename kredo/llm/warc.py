"""WARC derivatives: metadata and plain-text conversion records of response records.

A response record is read as it stands in a WARC file (headers, HTTP head, payload).  Two records
come of it, each naming it in ``WARC-Refers-To`` and keeping its target and date:

* ``metadata`` (``application/warc-fields``): the HTTP status line and every source header in order,
  the source's block and payload digests as stated and as recomputed, title, language, links, and
  the identifier of the conversion;
* ``conversion`` (``text/plain``): the visible text, one block element a line.

Identifiers are name-based (SHA-1 of the source's identifier and the record's type), so a task that
runs again writes the same records.  Rows are independent: nothing is shuffled.

Defined results: a null or empty page is an empty payload with an empty text; a null address leaves
the target header out; bytes that are no UTF-8 become U+FFFD in text and fields (digests are of the bytes); repeated rows give
repeated records; a record that cannot be parsed gives one ``metadata`` row with ``error`` set and
no record; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kredo.llm.common import arrow_rows

VERSION = "WARC/1.1"
#: The table names no time of capture.
DATE = "1970-01-01T00:00:00Z"

RESPONSE_SCHEMA = "page_id long, record_id string, record binary"
SCHEMA = ("page_id long, warc_type string, record_id string, refers_to string, target_uri string, "
          "source_payload_digest string, block_digest string, content_length long, n_links long, "
          "digest_ok boolean, error string, record binary")
_ARROW = pa.schema([("page_id", pa.int64()), ("warc_type", pa.string()), ("record_id", pa.string()),
                    ("refers_to", pa.string()), ("target_uri", pa.string()), ("source_payload_digest", pa.string()),
                    ("block_digest", pa.string()), ("content_length", pa.int64()), ("n_links", pa.int64()),
                    ("digest_ok", pa.bool_()), ("error", pa.string()), ("record", pa.binary())])


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def build(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A whole record; fields without a value are left out, line breaks in values become blanks."""
    lines = [VERSION, *(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}" for k, v in fields if v is not None),
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def head(data: bytes) -> tuple[str, list[tuple[str, str]]]:
    """First line and headers; a folded line continues the one before."""
    lines = data.decode("utf-8", "replace").split("\r\n")
    out: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, v = line.split(":", 1)
            out.append((k.strip(), v.strip()))
    return lines[0], out


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names, the first of each) and block."""
    top, mark, rest = record.partition(b"\r\n\r\n")
    line, fields = head(top)
    if not mark or not line.startswith("WARC/"):
        raise ValueError("no WARC header")
    named: dict[str, str] = {}
    for k, v in fields:
        named.setdefault(k.lower(), v)
    length = int(named.get("content-length", "-1"))
    if not 0 <= length <= len(rest):
        raise ValueError("the record is shorter than its Content-Length")
    return named, rest[:length]


def response_record(page_id, url: str | None, page: str | None) -> tuple[str, bytes]:
    """The response record of a stored page: its identifier and bytes."""
    payload = (page or "").encode("utf-8", "replace")
    name = record_name("response", str(page_id), url or "", hashlib.sha1(payload).hexdigest())
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
            "\r\n\r\n").encode()
    block = http + payload
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", url),
              ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)),
              ("Content-Type", "application/http; msgtype=response")]
    return name, build(fields, block)


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every stored page as a response record."""
    schema = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record", pa.binary())])

    def run(batches):
        yield from arrow_rows(((i, *response_record(i, u, h.as_py())) for b in batches for i, u, h in zip(
            b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2))), schema, weigh=lambda r: len(r[2]))

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return rows.mapInArrow(run, RESPONSE_SCHEMA)


# ---- text of a page --------------------------------------------------------------------------

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|title)\b(?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)", re.S | re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
#: Elements that start a new line.
BLOCKS = frozenset("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())


def visible(page: str) -> tuple[str, list[str]]:
    """Visible text and link targets, in order."""
    links: list[str] = []

    def swap(m: re.Match) -> str:
        name = m.group(3)
        if name is None:
            return ""
        if name in ("a", "A") and not m.group(2):
            href = _HREF.search(m.group(4))
            if href:
                links.append(html.unescape(next(g for g in href.groups() if g is not None)).strip())
        return "\n" if name.lower() in BLOCKS else ""

    text = html.unescape(_MARKUP.sub(swap, page))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line), links


def derive(record: bytes) -> list[tuple]:
    """The metadata and the conversion record of a response, in schema order without page_id."""
    fields, block = parse(record)
    if fields.get("warc-type") != "response" or "warc-record-id" not in fields:
        raise ValueError("no response record")
    source, uri, date = fields["warc-record-id"], fields.get("warc-target-uri"), fields.get("warc-date")
    top, _, payload = block.partition(b"\r\n\r\n")
    status, http = head(top)
    page = payload.decode("utf-8", "replace")
    text, links = visible(page)
    title, lang = _TITLE.search(page), _LANG.search(page)
    body = text.encode("utf-8", "replace") + (b"\n" if text else b"")
    now = digest(payload)
    stated = fields.get("warc-payload-digest")
    ok = (stated or now) == now and fields.get("warc-block-digest", digest(block)) == digest(block)
    conversion, metadata = record_name("conversion", source), record_name("metadata", source)
    shared = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", source),
              ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date)]

    pairs = [("source-status", status), *((f"source-header-{k}", v) for k, v in http),
             ("source-content-type", fields.get("content-type")), ("source-block-digest", fields.get("warc-block-digest")),
             ("source-payload-digest", stated), ("payload-digest", now), ("digests-match", str(ok).lower()),
             ("title", " ".join(html.unescape(title.group(1)).split()) if title else None),
             ("language", lang.group(1) if lang else None), ("conversion", conversion),
             ("conversion-digest", digest(body)), *(("outlink", link) for link in links)]
    lines = [f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in pairs if v is not None]
    warc_fields = "".join(lines).encode("utf-8", "replace")

    out = []
    for kind, name, content, data in (("metadata", metadata, "application/warc-fields", warc_fields),
                                      ("conversion", conversion, "text/plain; charset=utf-8", body)):
        whole = build([("WARC-Type", kind), ("WARC-Record-ID", name), *shared, ("WARC-Block-Digest", digest(data)),
                       ("Content-Type", content)], data)
        out.append((kind, name, source, uri, stated, digest(data), len(data), len(links), ok, None, whole))
    return out


def derivatives(records: DataFrame, id_col: str = "page_id", record_col: str = "record") -> DataFrame:
    """Metadata and conversion rows of every response record."""
    def run(batches):
        def rows():
            for batch in batches:
                for page_id, record in zip(batch.column(0).to_pylist(), batch.column(1)):
                    try:
                        for row in derive(record.as_py() or b""):
                            yield (page_id, *row)
                    except ValueError as e:
                        yield (page_id, "metadata", None, None, None, None, None, None, None, None, str(e), None)
        yield from arrow_rows(rows(), _ARROW, weigh=lambda r: len(r[-1] or b""))

    return records.select(F.col(id_col).cast("long"), F.col(record_col).cast("binary")).mapInArrow(run, SCHEMA)
