import gzip
import hashlib
import re
import zlib
from html.parser import HTMLParser

from pyspark.sql import types as T

from starloom.llm import queries as Q
from starloom.llm import warc as W

SF = "/root/testdata/sf0.001"
SOURCE = {"WARC-Record-ID": "<urn:uuid:00000000-0000-0000-0000-000000000001>", "warc-target-uri": "http://a.example.org/d/x", "WARC-Date": "2020-02-02T02:02:02Z"}


class Reader(HTMLParser):
    """Visible text by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.silent = [], 0

    def handle_starttag(self, tag, attrs):
        self.silent += bool(re.fullmatch(W._SILENT, tag))
        if re.fullmatch(W._LINES, tag):
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.silent -= bool(re.fullmatch(W._SILENT, tag))
        if re.fullmatch(W._LINES, tag):
            self.out.append("\n")

    def handle_data(self, data):
        if not self.silent:
            self.out.append(" ".join(re.split(r"\n", data)) if "\n" not in data else data)


def parse(raw):
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    n = int(fields["Content-Length"])
    assert first == "WARC/1.1" and rest[n:] == b"\r\n\r\n"
    return fields, rest[:n]


def test_pages_give_linked_records(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = Q.op9_warc_derivatives(spark, SF).collect()
    assert len(got) == 2 * len(pages)
    by = {(r.page_id, r.record_type): r for r in got}
    assert len({r.record_id for r in got}) == len(got)
    for i, p in pages.items():
        m, c = by[i, "metadata"], by[i, "conversion"]
        assert m.refers_to == c.refers_to and m.concurrent_to == c.record_id and c.concurrent_to == m.record_id
        assert m.target_uri == c.target_uri == p.url and m.digest_ok and c.digest_ok
        reader = Reader()
        reader.feed(p.html)
        reader.close()
        assert c.content == "\n".join(x for x in (" ".join(line.split()) for line in "".join(reader.out).split("\n")) if x)
        payload = "sha1:" + hashlib.sha1(p.html.encode()).hexdigest()
        assert c.fields["X-Source-WARC-Payload-Digest"] == payload and f"source-warc-WARC-Payload-Digest: {payload}\r\n" in m.content
        assert m.content.count("outlink: ") == len(set(re.findall(r'href="([^"]*)"', p.html)))
        assert "http-status: 200\r\n" in m.content and "charset: utf-8\r\n" in m.content


def test_text_conversion():
    page = "<!DOCTYPE html><title>T &amp; t</title><body>a<b>b</b> &lt;c&gt;<br>d <!-- <p>no</p> --><script>if (a<b) '</p>'</script><p title='x>y'>e\n f</p><ul><li>1<li>2</ul>3 < 4<style>p{"
    assert W.visible_text(page) == "T & t\nab <c>\nd\ne\nf\n1\n2\n3 < 4"


def test_records_round_trip_and_digests(spark):
    body = "<html lang=de><title>Grüße</title><a href='/up'>ä</a><a href=\"y?a=1&amp;b=2\">z</a>".encode("latin-1")
    head = b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html;\r\n charset=ISO-8859-1\r\nX-A: b\r\n\r\n"
    good = SOURCE | {"WARC-Block-Digest": W.sha1(head + body), "WARC-Payload-Digest": "sha256:" + hashlib.sha256(body).hexdigest()}
    rows = [(1, good, head + body, "x"), (2, good | {"WARC-Payload-Digest": "sha1:AAAA"}, head + body, "x"), (3, SOURCE, b"HTTP/1.0 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG", "x")]
    rows += [(4, SOURCE, None, "x"), (5, None, b"<p>no head", "x"), (6, {}, b"", None), (None, SOURCE, b"HTTP/1.1 200 OK\nContent-Type: text/plain\n\na <b>", "x"), (1, good, head + body, "x")]
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("warc_fields", T.MapType(T.StringType(), T.StringType())), T.StructField("block", T.BinaryType()), T.StructField("Content", T.StringType())])
    df = spark.createDataFrame(rows, schema)
    got = W.derivatives(df, record_col="record").collect()
    by = {}
    for r in got:
        by.setdefault((r.n, r.record_type), []).append(r)
        fields, content = parse(bytes(r.record))
        assert fields == r.fields and content == bytes(r.content) and fields["WARC-Block-Digest"] == W.sha1(content)
    assert len(by[1, "metadata"]) == 2 and by[1, "metadata"][0].record_id == by[1, "metadata"][1].record_id
    meta = bytes(by[1, "metadata"][0].content).decode()
    assert all(x in meta for x in ("http-status: 404", "charset: iso-8859-1", "title: Grüße", "language: de", "outlink: http://a.example.org/up", "outlink: http://a.example.org/d/y?a=1&b=2", "source-http-X-A: b", "source-digest-holds: true"))
    assert bytes(by[1, "conversion"][0].content).decode() == "Grüße\näz" and by[1, "conversion"][0].refers_to == SOURCE["WARC-Record-ID"]
    assert by[2, "metadata"][0].digest_ok is False
    assert (3, "conversion") not in by and (4, "conversion") not in by and (6, "conversion") not in by
    assert by[3, "metadata"][0].concurrent_to is None and by[3, "metadata"][0].digest_ok is None
    assert bytes(by[5, "conversion"][0].content) == b"no head" and by[5, "conversion"][0].refers_to is None
    assert bytes(by[None, "conversion"][0].content) == b"a <b>"
    assert W.derivatives(df.limit(0)).count() == 0


def test_text_behind_silent_names():
    for tag in ('<svg-icon name="x"></svg-icon>', "<title-bar></title-bar>", "<template-card>", "<svg class='i'/>", "<svg class=i>", "<object data=x>", "<iframe-x>", "<template>"):
        assert W.visible_text(f"<p>a</p>{tag}<p>body text</p>") == "a\nbody text", tag
    assert W.visible_text("<p>a<svg><svg>no</svg>no</svg> b<img alt='<!-- '><template><svg>no</template> c<p>d<script>no</p>") == "a b c\nd"
    block = b"<title-bar>x</title-bar><title>T</title><a-card href=/no></a-card><svg class='i'/><a href=/yes>y</a>"
    meta = W.derive(SOURCE, block)[0]["content"].decode()
    assert re.findall("(?:title|outlink): .*", meta) == ["title: T\r", "outlink: http://a.example.org/yes\r"]
    assert W.visible_text("<p>a<svg>" * 20_000).count("a") == 20_000


def test_encoded_bodies_give_equal_texts():
    page = "<title>Grüße</title><p>body</p><a href=/x>y</a>".encode() * 300
    chunked = lambda b: b"".join(b"%X;e=1\r\n%b\r\n" % (len(b[i : i + 999]), b[i : i + 999]) for i in range(0, len(b), 999)) + b"0\r\nT: v\r\n\r\n"
    raw = zlib.compressobj(wbits=-15)
    half = len(page) // 2
    plain = W.derive(SOURCE, b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page)[1]["content"]
    cases = {
        "Transfer-Encoding: chunked": chunked(page),
        "content-encoding: GZIP": gzip.compress(page),
        "Content-Encoding: x-gzip, identity": gzip.compress(page[:half]) + gzip.compress(page[half:]),
        "Content-Encoding: deflate": zlib.compress(page),
        "Content-Encoding:deflate": raw.compress(page) + raw.flush(),
        "Content-Encoding: deflate, gzip\r\nTransfer-Encoding: gzip, chunked": chunked(gzip.compress(gzip.compress(zlib.compress(page)))),
        "Content-Encoding: gzip\r\nTransfer-Encoding: chunked": page,  # undone by the writer
    }
    for head, body in cases.items():
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{head}\r\n\r\n".encode() + body
        for digest in (W.sha1(body), W.sha1(page)):
            meta, text = W.derive(SOURCE | {"WARC-Payload-Digest": digest}, block)
            assert text["content"] == plain and meta["digest_ok"], head
            assert b"title: Gr\xc3\xbc\xc3\x9fe" in meta["content"] and b"outlink: http://a.example.org/x" in meta["content"]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Encoding: "
    (only,) = W.derive(SOURCE, head + b"br\r\n\r\n\x0b\x02")
    assert only["record_type"] == "metadata" and b"unknown-encoding: br\r\n" in only["content"]
    meta, text = W.derive(SOURCE, head + b"gzip\r\n\r\n" + gzip.compress(page)[:-12])
    assert b"payload-complete: false" in meta["content"] and text["content"]
    sent = [W.response(i, page) for i in range(30)]
    assert {W.derive({}, b)[1]["content"] for b in sent} == {plain} and len(set(sent)) == 3
