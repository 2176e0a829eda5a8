"""Web archive records: responses, and the metadata and plain-text records derived from them."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = (
    "record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "block_digest string, payload_digest string, header string, block binary"
)
_FIELDS = [f.split()[0] for f in RECORD.split(", ")]
_KINDS = [pa.binary() if f.endswith("binary") else pa.string() for f in RECORD.split(", ")]
_HIDES = ("script", "style", "noscript", "template", "svg")
_BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|"
    r"pre|section|table|td|th|title|tr|ul)\b",
    re.I,
)
_TAG = re.compile(r"<[a-zA-Z/!?]")
_NAME = re.compile(r"<([a-zA-Z]+)\b")
_HIDDEN_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _HIDES}
_SPACES = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_TITLE, _TITLE_END = re.compile("<title", re.I), re.compile("</title", re.I)
_HTML, _LANG = re.compile(r"<html\b", re.I), re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
_ANCHOR, _HREF = re.compile(r"<a\b", re.I), re.compile(r"\bhref\s*=\s*", re.I)
_VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
_CHUNK = re.compile(rb"[ \t]*([0-9a-fA-F]{1,16})[ \t]*(?:;[^\r\n]*)?\r\n")
_PIECE = 1 << 16
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def digest(data: bytes) -> str:
    """The labelled SHA-1 that archives use."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def named_id(*parts: str) -> str:
    """A record id that depends on its source alone, so that a task that runs again writes the same."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, chr(0).join(parts))}>"


def one_line(text: str) -> str:
    """A header value without line breaks, which would end the header."""
    return " ".join(text.split())


def header_of(fields: list[tuple[str, str | None]]) -> str:
    lines = [f"{name}: {one_line(value)}\r\n" for name, value in fields if value]
    return "WARC/1.1\r\n" + "".join(lines) + "\r\n"


def shown(page: str) -> str:
    """The page with a space for every comment and every script, style or the like; one that does not end goes to the end.

    Like all that reads a page here, it goes from one ``<`` to the next and never back, so that broken or hostile pages
    take time in proportion to their length too.
    """
    out, at, tags_end = [], 0, True
    while (start := page.find("<", at)) >= 0:
        out.append(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            out.append(" ")
            at = len(page) if end < 0 else end + 3
            continue
        name = _NAME.match(page, start)
        kind = name[1].lower() if name else ""
        close = page.find(">", name.end()) if kind in _HIDES and tags_end else -1
        if close < 0:
            tags_end = tags_end and kind not in _HIDES  # no tag ends behind here
            out.append("<")
            at = start + 1
            continue
        end = _HIDDEN_END[kind].search(page, close + 1)
        out.append(" ")
        at = end.end() if end else len(page)
    out.append(page[at:])
    return "".join(out)


def _without_tags(page: str, opening: re.Pattern, into: str) -> str:
    """``into`` in place of every tag that begins like ``opening`` and has an end."""
    out, at = [], 0
    while start := opening.search(page, at):
        end = page.find(">", start.end())
        if end < 0:
            break
        out += page[at : start.start()], into
        at = end + 1
    return "".join([*out, page[at:]])


def _tags(page: str, opening: re.Pattern) -> Iterator[tuple[int, int]]:
    """(begin, end) of what stands in the tags that begin like ``opening``; the last one may have no end. Tags within a tag are part of it."""
    at = 0
    while start := opening.search(page, at):
        end = page.find(">", start.end())
        at = len(page) if end < 0 else end
        yield start.end(), at


def page_title(page: str) -> str | None:
    for _, end in _tags(page, _TITLE):
        close = _TITLE_END.search(page, end + 1)
        return page[end + 1 : close.start()] if close else None
    return None


def page_language(page: str) -> str | None:
    return next((found[1] for begin, end in _tags(page, _HTML) if (found := _LANG.search(page, begin, end))), None)


def page_links(page: str) -> Iterator[str]:
    """The targets of anchors, in order; a quoted one may hold what ends a tag."""
    at = 0
    while start := _ANCHOR.search(page, at):
        end = page.find(">", start.end())
        at = end = len(page) if end < 0 else end
        name = _HREF.search(page, start.end(), end)
        while name and not (value := _VALUE.match(page, name.end())):
            name = _HREF.search(page, name.end(), end)
        if name:
            yield next(filter(None, value.groups()), "")
            at = max(value.end(), start.end())


def visible_text(page: str) -> str:
    """What a reader sees: no comments, scripts or styles; one line for each block of the page, entities resolved."""
    text = _without_tags(_without_tags(shown(page), _BREAK, "\n"), _TAG, "")
    return _LINES.sub("\n", _SPACES.sub(" ", html.unescape(text))).strip()


def header_pairs(lines: list[str]) -> list[tuple[str, str]]:
    """(lower-case name, value) of every header line, in order, repeated ones too; a line that begins with space goes on with the last."""
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t"):
            if out:
                out[-1] = out[-1][0], f"{out[-1][1]} {line.strip()}".strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip().lower(), value.strip()))
    return out


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers with lower-case names, payload) of a response; without a header all of it is payload."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("latin-1").split("\r\n")
    return status, header_pairs(lines), payload


def joined_chunks(payload: bytes) -> bytes:
    """The content of a chunked payload, as far as it goes; one that is not in chunks is returned as it is."""
    out, at = [], 0
    while match := _CHUNK.match(payload, at):
        size = int(match[1], 16)
        if not size:
            break
        out.append(payload[match.end() : match.end() + size])
        at = match.end() + size + 2
    return b"".join(out) if at or _CHUNK.match(payload) else payload


def inflated(payload: bytes, bits: int) -> bytes:
    """The content of all zlib members, a last one that is cut short or broken as far as it goes."""
    out, at, view = [], 0, memoryview(payload)
    while at < len(view):
        member = zlib.decompressobj(bits)
        while at < len(view) and not member.eof:
            piece = view[at : at + _PIECE]
            try:
                out.append(member.decompress(piece))
            except zlib.error:
                if not any(out):
                    raise
                return b"".join(out)
            at += len(piece)
        at -= len(member.unused_data)
    return b"".join(out)


def uncoded(payload: bytes, headers: list[tuple[str, str]]) -> bytes | None:
    """The payload without its transfer and content codings; None if one of them is not chunked, gzip or deflate.

    Archives often hold a payload decoded beside its old headers, so one that is not in the form a header names stays.
    """
    for header in ("transfer-encoding", "content-encoding"):
        named = [c.strip().lower() for name, value in headers if name == header for c in value.split(",")]
        for coding in reversed(named):
            if coding == "chunked":
                payload = joined_chunks(payload)
            elif coding in ("gzip", "x-gzip"):
                payload = inflated(payload, 31) if payload[:3] == b"\x1f\x8b\x08" else payload
            elif coding == "deflate":
                for bits in (15, -15):
                    try:
                        payload = inflated(payload, bits)
                        break
                    except zlib.error:
                        continue
            elif coding not in ("", "identity"):
                return None
    return payload


def decoded(payload: bytes, content_type: str) -> str:
    """The payload in the character set that its type names, else UTF-8; what does not fit is replaced."""
    named = _CHARSET.search(content_type)
    try:
        return payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def response_record(key: str, uri: str | None, page: str | None, date: str) -> tuple:
    """A response as a crawler would have stored it. A null page is an empty payload; a null address is left out."""
    payload = (page or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + payload
    record_id, kind = named_id("response", key, uri or ""), "application/http; msgtype=response"
    header = header_of(
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", record_id),
            ("WARC-Target-URI", uri),
            ("WARC-Date", date),
            ("WARC-Payload-Digest", digest(payload)),
            ("WARC-Block-Digest", digest(block)),
            ("Content-Type", kind),
            ("Content-Length", str(len(block))),
        ]
    )
    return "response", record_id, None, uri, date, kind, digest(block), digest(payload), header, block


def derived_records(
    record_id: str,
    uri: str | None,
    date: str | None,
    payload_digest: str | None,
    block: bytes,
    block_digest: str | None = None,
    header: str | None = None,
) -> Iterator[tuple]:
    """The metadata record of a response, and the conversion of its text if it is text.

    Both refer to the response by its id and repeat its address, date and payload digest. The metadata keeps the status
    line, every HTTP and WARC header of the source, and its block digest. Text in a coding that :func:`uncoded` does not know
    has no conversion.
    """
    status, headers, payload = split_http(block)
    kind = dict(headers).get("content-type", "text/html")
    payload_digest = payload_digest or digest(payload)
    content = uncoded(payload, headers)
    textual = content is not None and (kind.lower().startswith("text/") or "html" in kind.lower())
    page = decoded(content, kind) if textual else ""
    bare = shown(page)
    facts = [("http-status", status), *((f"http-header-{name}", value) for name, value in headers)]
    facts += [(f"warc-header-{name}", value) for name, value in header_pairs((header or "").split("\r\n")[1:])]
    facts.append(("source-block-digest", block_digest or digest(block)))
    for name, found in (("title", page_title(bare)), ("languages", page_language(bare))):
        facts.append((name, html.unescape(found) if found else None))
    facts += [("outlink", html.unescape(link)) for link in page_links(bare)]
    facts.append(("source-payload-length", str(len(payload))))
    fields = "".join(f"{name}: {one_line(value)}\r\n" for name, value in facts if value).encode()
    made = [("metadata", "application/warc-fields", fields)]
    if textual:
        text = visible_text(page) if "html" in kind.lower() else page
        made.append(("conversion", "text/plain; charset=utf-8", text.encode()))
    for record_type, content_type, data in made:
        own_id, own = named_id(record_type, record_id), digest(data)
        header = header_of(
            [
                ("WARC-Type", record_type),
                ("WARC-Record-ID", own_id),
                ("WARC-Refers-To", record_id),
                ("WARC-Target-URI", uri),
                ("WARC-Date", date),
                ("WARC-Source-Payload-Digest", payload_digest),
                ("WARC-Block-Digest", own),
                ("Content-Type", content_type),
                ("Content-Length", str(len(data))),
            ]
        )
        yield record_type, own_id, record_id, uri, date, content_type, own, payload_digest, header, data


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=_FIELDS)


def _mapped(batches: Iterator[pa.RecordBatch], make, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            columns = [c.to_pylist() for c in batch.slice(at, rows).columns]
            out = [record for row in zip(*columns, strict=True) for record in make(*row)]
            if out:
                yield _batch(out)


def response_records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """A response record for every page. Rows that repeat id and address give records of one id."""
    given = pages.select(*(F.col(c).cast("string") for c in (id_col, url_col, html_col)))

    def make(key: str | None, uri: str | None, page: str | None) -> Iterator[tuple]:
        yield response_record(key or "", uri, page, date)

    return given.mapInArrow(lambda batches: _mapped(batches, make), RECORD)


def derive_records(records: DataFrame) -> DataFrame:
    """The metadata and conversion records of all responses among the records, in the columns of :data:`RECORD`.

    Every response gives a metadata record, and a conversion if its content type is text. Records of other types are
    passed over. Each is derived where it lies; nothing is shuffled. A null block counts as empty, ``header`` and
    ``block_digest`` may be missing, other columns are not read, and no records give none.
    """
    more = [F.col(c) if c in records.columns else F.lit(None).cast("string").alias(c) for c in ("block_digest", "header")]
    given = records.filter("record_type = 'response'").select(
        F.coalesce("record_id", F.lit("")), "target_uri", "date", "payload_digest", F.coalesce("block", F.lit(b"")), *more
    )
    return given.mapInArrow(lambda batches: _mapped(batches, derived_records), RECORD)


def write_warc(records: DataFrame, path: str, compress: bool = True) -> None:
    """Writes records as archive files, one a task, through Spark's own writer, so that they appear whole or not at all."""
    whole = F.concat(F.col("header").cast("binary"), F.col("block")).cast("string")
    rows = records.select(whole.alias("value"))
    rows.write.mode("errorifexists").option("lineSep", "\r\n\r\n").option("compression", "gzip" if compress else "none").text(path)


def parse_warc(data: bytes) -> Iterator[tuple]:
    """The records of an archive file, found by their lengths.

    A record that is cut short or has no valid length ends the file, and so does a compressed member that is cut short or broken.
    """
    if data[:2] == b"\x1f\x8b":
        try:
            data = inflated(data, 31)
        except zlib.error:
            return
    at = data.find(b"WARC/")
    while at >= 0:
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0:
            return
        header = data[at : stop + 4].decode("utf-8", "replace")
        fields = dict(header_pairs(header.split("\r\n")[1:]))
        length = fields.get("content-length") or "0"
        if not length.isascii() or not length.isdigit():
            return
        size = int(length)
        block = data[stop + 4 : stop + 4 + size]
        if len(block) < size:
            return
        payload_digest = fields.get("warc-payload-digest") or fields.get("warc-source-payload-digest")
        names = ("warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-date", "content-type", "warc-block-digest")
        yield *(fields.get(n) for n in names), payload_digest, header, block
        at = data.find(b"WARC/", stop + 4 + size)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archive files under a path. A file is read by one task, as its compression asks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(lambda batches: _mapped(batches, parse_warc, 1), RECORD)
