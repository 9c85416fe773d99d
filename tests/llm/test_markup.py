import codecs
import random
import time

import pytest

from starloom.llm import html_blocks as H
from starloom.llm import warc as W
from starloom.llm.markup import scan, unescape

MB = 1 << 20
BAD = {
    "tags": "<a " * (MB // 3),
    "declarations": "<!x" * (MB // 3),
    "double quotes": '<a ">"' * (MB // 6),
    "both quotes": "<a x=\"'>" * (MB // 8) + "'",
    "names": "<html lang" * (MB // 10),
    "script ends": "<script>" + "</script " * (MB // 9),
    "scripts": '<script "' * (MB // 9) + ">",
    "metas": "<meta " * (MB // 6),
    "titles": "<title>" * (MB // 7),
    "links": "<a href=\"" * (MB // 9) + ">",
    "closed": "<svg><template " * (MB // 15),
}


@pytest.mark.parametrize("name", BAD)
def test_time_is_linear(name):
    def took(page):
        at = time.process_time()
        H.blocks(page)
        W.derive({}, b"HTTP/1.1 200 OK\r\n\r\n" + page.encode())
        return time.process_time() - at

    assert took(BAD[name]) < 6  # a megabyte; quadratic time would be hours


def test_random_pages_are_covered_without_gaps():
    rng = random.Random(4)
    for _ in range(2000):
        page = "".join(rng.choice(["<", ">", "\"", "'", "a", "!--", "-->", "/", " ", "script", "</script>", "svg", "<p>", "x", "&#", "9" * 20, "=", "\x00", "é"]) for _ in range(rng.randrange(40)))
        found = list(scan(page))
        assert "".join(m[0] for m in found) == page
        assert W.visible_text(page) is not None and H.blocks(page) is not None
        W.derive({}, bytes(rng.randrange(256) for _ in range(60)))


def test_tags_without_end():
    assert W.visible_text('<p>a</p><a title="x>b</a> c') == "a\nb c"  # quotes never end: the tag ends at its first >
    assert W.visible_text("a <b") == "a <b" and [b.text for b in H.blocks("<p>a <b")] == ["a <b"]
    assert W.visible_text("<p>a</p> 1 < 2 <!-- no") == "a\n1 < 2"


def test_references():
    assert unescape("&#" + "9" * 5000 + ";x") == "�x" and unescape("&#x" + "f" * 5000 + " ") == "� "
    assert unescape("&#" + "0" * 5000 + "65;&#x" + "0" * 5000 + "42;") == "AB"
    assert unescape("&#0000000038;amp;") == "&amp;" and unescape("&amp;&eacute;") == "&é"


def test_encodings():
    for name in ("idna", "undefined", "unicode_escape", "punycode", "utf-7", "rot13", "base64", "no-such", "x" * 5000, "aliases"):
        for head, page in ((f"text/html; charset={name}", "<p>é</p>"), ("text/html", f"<meta charset={name}><p>é</p>")):
            meta, text = W.derive({}, f"HTTP/1.1 200 OK\r\nContent-Type: {head}\r\n\r\n".encode() + page.encode())
            assert text["content"].decode() == "é" and b"charset: utf-8\r\n" in meta["content"]
    far = "<head><style>" + "x" * 9000 + "</style><meta charset=windows-1252></head><p>é</p>"
    assert W.decode_body(far.encode("cp1252"), "") == (far, "windows-1252")
    for mark, name in W.MARKS:
        assert W.decode_body(mark + "é".encode(name), "text/html; charset=koi8-r") == ("é", name)
    assert W.decode_body("é".encode("shift-jis", "replace"), "charset=Shift_JIS")[1] == "shift_jis" and codecs.lookup("shift_jis").name in W.ENCODINGS


def test_oversize_chunk():
    assert W.unchunked(b"ffffffffffffffff\r\nabc") == (b"abc", False)
    assert W.unchunked(b"3\r\nabc\r\n0\r\n\r\n") == (b"abc", True)


def test_title_of_the_shown_markup():
    page = "<html lang=en><!-- <title>old</title> --><svg><title>icon</title></svg><title>new &amp; <b>own</title><a href='/x?a&amp;b'>l</a>"
    assert W.read(page)[1:] == ("new & own", "en", ["/x?a&b"])


def test_one_such_page_ends_no_job(spark):
    rows = [(1, "http://a/1", "<p>&#" + "9" * 5000 + "; text</p>"), (2, "http://a/2", "<p>plain</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert W.digests(df).count() == 4
