"""WARC derivatives: metadata and plain-text conversion records of responses.

Input is one row per response record: its WARC header fields (a map, names as
in the file) and its block (the HTTP message). Every response gives

* a ``metadata`` record (application/warc-fields): status, content type,
  charset, title, language and outlinks of the page, whether the source's
  digests hold, and all WARC and HTTP header fields of the source;
* a ``conversion`` record (text/plain), if the body is text: the page's visible
  text, a line per block of the page.

Both carry WARC-Refers-To with the source's record id, its target URI and its
date, name each other in WARC-Concurrent-To, and repeat the source's other
header fields with the prefix ``X-Source-``, digests included; their own block
digests (SHA-1, base 32) are computed. Record ids are version-5 UUIDs of the
source id and the record type, so reruns give the same ids.

Work is per response inside Arrow batches; nothing is shuffled.

Chunked transfer and gzip and deflate codings are undone first. A body in a
coding not known here gives a metadata record that names it; of a damaged or
cut body what can be read is used, and the metadata says so.

Defined results: a null or empty block gives a metadata record only; a block
without an HTTP head is taken as the body; a source without a record id has no
WARC-Refers-To and gets ids from its URI, date and block; header names are
matched in any case; a page of any length takes time linear in it, also where
tags or quotes never end; a chunk that claims more bytes than there are is cut at
the end of the block; repeated rows give repeated records with equal ids; other
input columns pass through, those named like the outputs are replaced.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import nullable, slices, without
from starloom.llm.markup import CLOSED, RAW, closed_elements, scan, unescape

# Elements whose content isn't text, and elements that end a line.
_SILENT = "|".join([RAW, *sorted(CLOSED)])
_LINES = (
    "address|article|aside|blockquote|body|br|caption|dd|details|dialog|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "h1|h2|h3|h4|h5|h6|header|hr|html|legend|li|main|nav|ol|option|p|pre|section|select|summary|table|tbody|td|textarea|tfoot|th|thead|title|tr|ul"
)
LINES = frozenset(_LINES.split("|"))
END_OF_TITLE = re.compile(r"</title\s*+>", re.I)
LANG = re.compile(r"\blang\s*+=\s*+[\"']?([\w-]+)", re.I)
LINK = re.compile(r"\bhref\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]+))", re.I)
CHUNK = re.compile(rb"[ \t]*([0-9a-fA-F]{1,16})[ \t]*(?:;[^\r\n]*)?\r?\n")
META = re.compile(rb"<meta\b[^>]*+>", re.I)
BODY = re.compile(rb"</head[\s>]|<body[\s>]", re.I)
META_CHARSET = re.compile(rb"charset\s*+=\s*+[\"']?([\w.:-]+)", re.I)
CHARSET = re.compile(r"charset\s*+=\s*+[\"']?([\w.:-]+)", re.I)
# Byte order marks; the text encodings of the web.
MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xfe\xff", "utf-16-be"), (b"\xff\xfe", "utf-16-le"))
ENCODINGS = frozenset(
    codecs.lookup(name).name
    for name in (
        "ascii utf-8 utf-16 utf-16-be utf-16-le latin-1 iso8859-2 iso8859-3 iso8859-4 iso8859-5 iso8859-6 iso8859-7 iso8859-8 iso8859-9 "
        "iso8859-10 iso8859-13 iso8859-14 iso8859-15 iso8859-16 cp866 koi8-r koi8-u mac-roman mac-cyrillic cp874 tis-620 cp1250 cp1251 "
        "cp1252 cp1253 cp1254 cp1255 cp1256 cp1257 cp1258 gb2312 gbk gb18030 big5 big5hkscs euc-jp iso2022-jp shift-jis cp932 euc-kr cp949"
    ).split()
)

RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("concurrent_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("content", T.BinaryType()),
        T.StructField("block_digest", T.StringType()),
        T.StructField("digest_ok", T.BooleanType()),
    ]
)


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_holds(stated: str | None, data: bytes) -> bool | None:
    """Whether a labelled digest (base 32 or hex) is that of ``data``; null if
    none is stated or its algorithm isn't known here."""
    if not stated or ":" not in stated:
        return None
    name, value = stated.split(":", 1)
    name = name.strip().lower().replace("-", "")
    if name not in ("md5", "sha1", "sha256", "sha512"):
        return None
    raw = hashlib.new(name, data).digest()
    return value.strip().rstrip("=").upper() in (raw.hex().upper(), base64.b32encode(raw).decode().rstrip("="))


def split_http(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """(status, header fields, body) of an HTTP response; (None, [], block) of anything else."""
    if not block.startswith(b"HTTP/"):
        return None, [], block
    m = re.search(rb"\r?\n\r?\n", block)
    head, body = (block[: m.start()], block[m.end() :]) if m else (block, b"")
    lines = re.split(r"\r?\n(?![ \t])", head.decode("latin-1"))
    status = re.match(r"HTTP/\S+\s+(\d{3})", lines[0])
    fields = [(k.strip(), " ".join(v.split())) for k, s, v in (x.partition(":") for x in lines[1:]) if s]
    return int(status[1]) if status else None, fields, body


def unchunked(body: bytes) -> tuple[bytes, bool]:
    """(content, complete) of a chunked body; a body that doesn't begin with a
    chunk is one whose writer has undone the chunks."""
    out, at = [], 0
    while m := CHUNK.match(body, at):
        size = int(m[1], 16)
        if not size:
            return b"".join(out), True
        out.append(body[m.end() : m.end() + min(size, len(body))])
        if size > len(body) - m.end():
            return b"".join(out), False
        at = m.end() + size
        at += 2 if body[at : at + 2] == b"\r\n" else body[at : at + 1] == b"\n"
    return (b"".join(out), False) if out else (body, True)


def inflated(body: bytes, coding: str) -> tuple[bytes, bool]:
    """(content, complete) of a gzip (of any number of members) or deflate body;
    one without a gzip header is one whose writer has undone the coding."""
    if coding == "deflate":
        zlib_head = len(body) > 1 and body[0] & 15 == 8 and int.from_bytes(body[:2], "big") % 31 == 0
        for bits in (15, -15) if zlib_head else (-15,):
            got, complete, _ = _member(body, bits)
            if complete or got and not body.lstrip().startswith(b"<"):
                return got, complete
        return body, True
    out, rest, complete = [], body, True
    while rest.startswith(b"\x1f\x8b") and complete:
        got, complete, rest = _member(rest, 31)
        out.append(got)
    return (b"".join(out), complete) if out else (body, True)


def _member(body: bytes, bits: int) -> tuple[bytes, bool, bytes]:
    """(content, complete, bytes behind it) of one compressed stream, as far as it can be read."""
    unpack, out = zlib.decompressobj(bits), []
    try:
        for at in range(0, len(body), 1 << 16):
            out.append(unpack.decompress(body[at : at + (1 << 16)]))
            if unpack.eof:
                return b"".join(out), True, unpack.unused_data + body[at + (1 << 16) :]
        out.append(unpack.flush())
    except zlib.error:
        pass
    return b"".join(out), unpack.eof, b""


def undone(http: list[tuple[str, str]], body: bytes) -> tuple[list[bytes], bool, str | None]:
    """(forms of the body: as stored, without chunks, without codings; complete;
    the coding that isn't known here, which is left on the last form)."""
    stated = lambda name: [c.strip().lower() for k, v in http if k.lower() == name for c in v.split(",") if c.strip()]
    forms, all_read = [body], True
    for codings in (stated("transfer-encoding"), stated("content-encoding")):
        for coding in reversed(codings):
            if coding == "chunked":
                body, complete = unchunked(body)
            elif coding in ("gzip", "x-gzip", "deflate"):
                body, complete = inflated(body, coding)
            elif coding == "identity":
                complete = True
            else:
                return [*forms, body], all_read, coding
            all_read &= complete
        forms.append(body)
    return forms, all_read, None


def decode_body(body: bytes, content_type: str) -> tuple[str, str]:
    """(text, charset) by a byte order mark, the content type, the statement in
    the page's head, or UTF-8, which also stands in for names that are no text
    encoding of the web."""
    for mark, name in MARKS:
        if body.startswith(mark):
            return body[len(mark) :].decode(name, "replace"), name
    name = stated[1] if (stated := CHARSET.search(content_type)) else _inside(body)
    try:
        if len(name) <= 40 and codecs.lookup(name).name in ENCODINGS:
            return body.decode(name, "replace"), name.lower()
    except LookupError:
        pass
    return body.decode("utf-8", "replace"), "utf-8"


def _inside(body: bytes) -> str:
    """The charset that a meta element of the head states, else UTF-8."""
    end = BODY.search(body)
    head = body[: body.rfind(b">", 0, end.start() if end else len(body)) + 1]
    for m in META.finditer(head):
        if stated := META_CHARSET.search(m[0]):
            name = stated[1].decode("ascii", "replace").lower()
            return "utf-8" if name.startswith("utf-16") else name  # a statement that can be read as ASCII isn't UTF-16
    return "utf-8"


def read(page: str) -> tuple[str, str | None, str | None, list[str]]:
    """(visible text, title, language, links) of a page. The text has one line
    per block, white space made single; comments and elements whose content
    isn't text are left out, and nothing inside them counts."""
    parts: list[str] = []
    title = lang = None
    links: dict[str, None] = {}
    ends, skip = dict(closed_elements(page)), 0
    for m in scan(page):
        if ends:
            if m.start() < skip:
                continue
            if m.start() in ends:
                skip = ends[m.start()]
                parts.append(" ")
                continue
        if m[6] is not None:
            parts.append(m[6])
        elif m[3] is not None:
            name = m[3].lower()
            if name in LINES:
                parts.append("\n")
            if m[2]:
                continue
            if name == "a":
                if link := LINK.search(m[4]):
                    links[_clean(unescape(link[1] or link[2] or link[3] or ""))] = None
            elif name == "title" and title is None:
                end = END_OF_TITLE.search(page, m.end())
                inner = page[m.end() : end.start() if end else len(page)]
                title = _clean(unescape("".join(t[6] for t in scan(inner) if t[6] is not None)))
            elif name == "html" and lang is None and (stated := LANG.search(m[4])):
                lang = stated[1]
        elif m[1] or page.startswith("<!--", m.start()):
            parts.append(" ")
    lines = (" ".join(x.split()) for x in unescape("".join(parts)).split("\n"))
    return "\n".join(line for line in lines if line), title, lang, list(links)


def visible_text(page: str) -> str:
    """The text a reader sees."""
    return read(page)[0]


def _clean(value: str) -> str:
    return " ".join(value.split())


def derive(fields: dict[str, str], block: bytes | None) -> list[dict]:
    """Records of one response."""
    given = {k.lower(): v for k, v in fields.items() if v is not None}
    source, uri, date = given.get("warc-record-id"), given.get("warc-target-uri"), given.get("warc-date")
    block = block or b""
    status, http, body = split_http(block)
    content_type = next((v for k, v in http if k.lower() == "content-type"), "text/html" if status is None and body else "")
    forms, complete, unknown = undone(http, body)
    body = forms[-1]
    payload = [digest_holds(given.get("warc-payload-digest"), f) for f in dict.fromkeys(forms)]  # writers differ in which one they mean
    checks = [digest_holds(given.get("warc-block-digest"), block), True if True in payload else payload[0]]
    holds = None if checks == [None, None] else all(c is not False for c in checks)
    name = source or "|".join([uri or "", date or "", hashlib.sha1(block).hexdigest()])
    ids = {kind: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{kind}')}>" for kind in ("metadata", "conversion")}
    textual = bool(body) and unknown is None and re.match(r"(?i)text/|application/(xhtml|xml)", content_type.strip() or "text/html") is not None

    out, lines = [], []
    if status is not None:
        lines.append(("http-status", str(status)))
    if unknown is not None:
        lines.append(("unknown-encoding", unknown))
    if not complete:
        lines.append(("payload-complete", "false"))
    if textual:
        page, charset = decode_body(body, content_type)
        text, is_html = page, not re.match(r"(?i)text/(?!html|xml)", content_type.strip())
        lines.append(("charset", charset))
        if is_html:
            text, title, lang, links = read(page)
            if title is not None:
                lines.append(("title", title))
            if lang:
                lines.append(("language", lang))
            for link in links:
                try:
                    lines.append(("outlink", urljoin(uri or "", link)))
                except ValueError:  # not a URL
                    lines.append(("outlink", link))
    if holds is not None:
        lines.append(("source-digest-holds", str(holds).lower()))
    lines += [(f"source-warc-{k}", _clean(v)) for k, v in fields.items() if v is not None]
    lines += [(f"source-http-{k}", v) for k, v in http]
    content = "".join(f"{k}: {v}\r\n" for k, v in lines).encode("utf-8", "replace")

    def add(kind: str, other: str | None, media: str, data: bytes) -> None:
        head = {"WARC-Type": kind, "WARC-Record-ID": ids[kind]}
        linked = {"WARC-Refers-To": source, "WARC-Target-URI": uri, "WARC-Date": date, "WARC-Concurrent-To": other}
        head |= {k: _clean(v) for k, v in linked.items() if v}
        head |= {"Content-Type": media, "WARC-Block-Digest": sha1(data), "Content-Length": str(len(data))}
        own = {"warc-type", "warc-record-id", "warc-target-uri", "warc-date"}
        head |= {f"X-Source-{k}": _clean(v) for k, v in fields.items() if v is not None and k.lower() not in own}
        out.append({"record_id": ids[kind], "record_type": kind, "refers_to": source, "concurrent_to": other, "target_uri": uri, "date": date, "fields": list(head.items()), "content": data, "block_digest": head["WARC-Block-Digest"], "digest_ok": holds})

    add("metadata", ids["conversion"] if textual else None, "application/warc-fields", content)
    if textual:
        add("conversion", ids["metadata"], "text/plain; charset=utf-8", text.encode("utf-8", "replace"))
    return out


def serialize(fields: dict[str, str], content: bytes) -> bytes:
    """A record as the bytes of a WARC 1.1 file."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\n{head}\r\n".encode("utf-8", "replace") + content + b"\r\n\r\n"


def derivatives(responses: DataFrame, fields_col: str = "warc_fields", block_col: str = "block", record_col: str | None = None) -> DataFrame:
    """Records of every response: the columns of ``RECORD``, after those of the
    input other than ``fields_col`` and ``block_col``; with ``record_col`` also
    each record's bytes as written to a WARC file."""
    extra = [T.StructField(record_col, T.BinaryType())] if record_col else []
    src = without(responses, *RECORD.names, *(f.name for f in extra))
    kept = [c for c in src.columns if c not in (fields_col, block_col)]
    out = nullable(T.StructType([*(src.schema[c] for c in kept), *RECORD.fields, *extra]))
    names = [f.name for f in RECORD.fields]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        text = pa.string()
        kinds = [text] * 6 + [pa.map_(text, text), pa.binary(), text, pa.bool_()]
        for whole in batches:
            for b in slices(whole, block_col):
                rows, records = [], []
                fields = b.column(b.schema.get_field_index(fields_col)).to_pylist()
                for i, (f, block) in enumerate(zip(fields, b.column(b.schema.get_field_index(block_col)).to_pylist())):
                    got = derive(dict(f or []), block)
                    rows += [i] * len(got)
                    records += got
                at = pa.array(rows, pa.int64())
                cols = [b.column(b.schema.get_field_index(c)).take(at) for c in kept]
                cols += [pa.array([r[n] for r in records], k) for n, k in zip(names, kinds)]
                if record_col:
                    cols.append(pa.array([serialize(dict(r["fields"]), r["content"]) for r in records], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[*kept, *names, *([record_col] if record_col else [])])

    return src.mapInArrow(run, out)


def response(page_id: int | None, body: bytes) -> bytes:
    """A page as an HTTP message: plain, chunked or gzip by its id."""
    how = zlib.crc32(str(page_id).encode()) % 3
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if how == 1:
        parts = [body[at : at + 4096] for at in range(0, len(body), 4096)]
        return head + b"Transfer-Encoding: chunked\r\n\r\n" + b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"
    if how == 2:
        head, body = head + b"Content-Encoding: gzip\r\n", gzip.compress(body, 6, mtime=0)
    return head + b"Content-Length: %d\r\n\r\n" % len(body) + body


def responses_of(pages: DataFrame) -> DataFrame:
    """Stand-in for a reader of response records: the ``pages`` table in the
    schema :func:`derivatives` expects (page_id, warc_fields, block)."""
    names = [*pages.columns, "_sent"]

    def send(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for b in slices(whole, "html"):
                ids, html_ = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("page_id", "html"))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([response(i, (p or "").encode("utf-8", "replace")) for i, p in zip(ids, html_)], pa.binary())], names=names)

    pages = pages.mapInArrow(send, nullable(T.StructType([*pages.schema.fields, T.StructField("_sent", T.BinaryType())])))
    body, block = F.coalesce(F.col("html"), F.lit("")).cast("binary"), F.col("_sent")
    md5 = F.md5(F.concat_ws("|", F.col("page_id").cast("string"), F.col("url")))
    rid = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(md5, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    fields = {
        "WARC-Type": F.lit("response"),
        "WARC-Record-ID": rid,
        "WARC-Target-URI": F.col("url"),
        "WARC-Date": F.lit("2024-05-01T00:00:00Z"),
        "Content-Type": F.lit("application/http; msgtype=response"),
        "WARC-Block-Digest": F.concat(F.lit("sha1:"), F.sha1(block)),
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.sha1(body)),
    }
    return pages.select("page_id", F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)]).alias("warc_fields"), block.alias("block"))


def digests(pages: DataFrame) -> DataFrame:
    """Both derivative records of every page, contents as text."""
    out = derivatives(responses_of(pages.select("page_id", "url", "html")))
    return out.withColumn("content", F.decode("content", "UTF-8"))
