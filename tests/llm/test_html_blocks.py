import re
from html.parser import HTMLParser

import numpy as np
import pytest

from starloom.llm import html_blocks as H
from starloom.llm import queries as Q

SF = "/root/testdata/sf0.001"


class Article(HTMLParser):
    """Text of the article element, a line per h1 or p, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.inside = [], False

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        if tag in ("p", "h1"):
            self.out.append("")
        elif tag == "br" and self.inside:
            self.out[-1] += " "

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        if tag in ("p", "h1"):
            self.out.append("")

    def handle_data(self, data):
        if self.inside and self.out:
            self.out[-1] += data


def plain(page):
    p = Article()
    p.feed(page or "")
    p.close()
    return "\n".join(t for t in (" ".join(x.split()) for x in p.out) if t)


@pytest.fixture(scope="module")
def net(spark):
    return H.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_pages_equal_a_plain_parser(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = Q.op2_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == plain(pages[r.page_id].html) and r.url == pages[r.page_id].url and r.n_chars == len(r.text)


def test_blocks():
    page = "<body><!-- <p>no --><div class='Post main' id=c1>a &amp; <b>b</b>\n <a href='>'>ccc</a><p>d<br>e<p>f<ul><li>1<li>2</ul></div>g<script>x='</p>'</script> h<title>no</title>< 5"
    got = [(b.text, "/".join(b.path), b.linked) for b in H.blocks(page)]
    div = "<body>/<div>/post/main/c"
    assert got == [("a & b ccc", div, 3), ("d e", f"{div}/<p>", 0), ("f", f"{div}/<p>", 0), ("1", f"{div}/<ul>/<li>", 0), ("2", f"{div}/<ul>/<li>", 0), ("g h< 5", "<body>", 0)]


def test_composed_pages_held_out(net, spark):
    stock = [b.text for r in spark.read.parquet(f"{SF}/pages.parquet").limit(40).collect() for b in H.blocks(r.html)]
    composer, features = H.Composer(stock, seed=77), H.Features()
    pages = [composer.page() for _ in range(150)]
    got = net.labels([features.page(b) for b, _ in pages])
    assert np.mean(np.concatenate([g == y for g, (_, y) in zip(got, pages)])) > 0.97


def test_other_layouts(net):
    text = "A sentence that is long enough to be part of a story, with some words. "
    page = f"""<html><head><title>t</title><style>p{{}}</style></head><body><div class="header"><div class=logo>Site</div></div>
    <div id="menu"><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></div><div class="cookie-notice">We use cookies, {text}</div>
    <div class="post"><div class="entry-content"><h1>Head &lt;line&gt;</h1><p>{text * 2}</p><div class="ad">{text}</div><p>{text * 3}</div></div>
    <div class="sidebar"><ul><li><a href=/x>{text}</a></li></ul></div><section id="comments"><ol class=comment-list><li><p>{text}</p></li></ol></section>
    <form class=search-form><label>Search</label><button>Go</button></form><div class="footer"><p>&copy; {text}</p></div></body></html>"""
    found = H.blocks(page)
    main = net.labels([H.Features().page(found)])[0]
    assert [b.text for b, m in zip(found, main) if m] == ["Head <line>", (text * 2).strip(), (text * 3).strip()]


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = H.Network(1)
    for k in net.w:
        net.w[k] = net.w[k].astype(np.float64)
    x = rng.normal(size=(5, 2, H.INPUT))
    live = np.array([[1, 1], [1, 1], [1, 1], [1, 0], [1, 0]], bool)
    y = rng.integers(0, 2, (5, 2)) * live

    def loss():
        p = net.forward(x, live)[0]
        return -(np.where(y == 1, np.log(p), np.log(1 - p)) * live).sum() / live.sum()

    grads, dx = net.gradients(x, live, y)
    for array, grad in [(net.w[k], grads[k]) for k in ("xf", "hf", "bf", "xb", "hb", "out", "bias")] + [(x, dx)]:
        for _ in range(6):
            at = tuple(rng.integers(s) for s in array.shape)
            old = array[at]
            array[at] = old + 1e-3
            up = loss()
            array[at] = old - 1e-3
            down = loss()
            array[at] = old
            assert grad[at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-5)


def test_padding_changes_nothing(net):
    features = H.Features()
    pages = [features.page(H.blocks("<body><nav>a</nav><article>" + "<p>word and word.</p>" * n + "</article>")) for n in (1, 5, 40, 3)]
    apart = [net.labels([p])[0].tolist() for p in pages]
    assert [p.tolist() for p in net.labels(pages)] == apart


def test_odd_rows(spark, net):
    long = "<article>" + "<p>Some words of a story, again and again.</p>" * 30_000 + "</article>"
    rows = [(1, "u", None, 5), (2, None, "", 5), (3, "u", "<nav>", 5), (None, "u", long, 5), (4, "u", "<article><p>Same words, all of them.</article>", 5), (4, "u", "<article><p>Same words, all of them.</article>", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, `Text` int")
    got = H.extract(df, net).collect()
    assert [r.text for r in got if r.page_id in (1, 2, 3)] == ["", "", ""]
    assert len([r for r in got if r.page_id == 4]) == 2 and len({r.text for r in got if r.page_id == 4}) == 1
    assert [r.text.count("\n") for r in got if r.page_id is None][0] > 29_000
    assert H.digests(df.limit(0).select("page_id", "url", "html")).count() == 0
    assert re.fullmatch(r"\d+", str(H.digests(df.limit(1).select("page_id", "url", "html")).first().n_chars))


def test_text_behind_silent_names():
    texts = lambda page: [b.text for b in H.blocks(page)]
    for tag in ('<svg-icon name="x"></svg-icon>', "<title-bar></title-bar>", "<template-card>", "<svg class='i'/>", "<svg class=i>", "<math/>", "<object data=x>", "<script-x>", "<template>"):
        assert texts(f"<p>a</p>{tag}<p>body text</p>") == ["a", "body text"], tag
    assert texts("<p>a<svg><svg><text>no</text></svg><text>no</text></svg> b<template><svg><p>no</template> c<object><p>no</object></p><p>d</svg>") == ["a b c", "d"]
    assert texts("<p>area <math><mi>x</mi><mo>+</mo><mn>1</mn></math> holds<p>b") == ["area x+1 holds", "b"]
    assert texts("<p title='<svg>'>a<img alt='<!-- '> b</p><p>c<script>no</p><p>no") == ["a b", "c"]
    assert len(texts("<p>a<svg>" * 20_000)) == 20_000


def test_whole_path(net):
    utility = "".join(f'<div class="flex px mt text bg rounded shadow u{w} v{w}">' for w in "abcdefgh")
    page = lambda tag: f"<{tag}>{utility}<p>A sentence that is long enough, with some words.</p><p>Another one of them, as long as it is.</p>{'</div>' * 8}</{tag}>"
    found = H.blocks("<body>" + page('nav class="menu"') + page("article") + page('footer class="site-footer"'))
    paths = H.Features().page(found)[0]
    assert len(found) == 6 and len(found[0].path) > 24 and len({tuple(p) for p in paths}) == 3
    for names, b in zip(paths, found):
        assert {H.Features().name(n) for n in b.path} <= set(names)
    assert net.labels([H.Features().page(found)])[0].tolist() == [False, False, True, True, False, False]


def test_long_pages_train_to_their_end():
    page = H.blocks("<body>" + "<p>Same words here.</p>" * 90 + "<div class=tail><p>Same words here.</p></div>" * 30)
    y = np.arange(120) < 90
    other = H.blocks("<body><div class=head><p>Same words here.</p></div><p>Same words here.</p>")
    net = H.train([(page, y)] * 160 + [(other, np.array([False, True]))] * 160)
    assert net.labels([H.Features().page(page)])[0].tolist() == y.tolist()


def test_batches_hold_every_page():
    sizes = [5, 100, 80, 3_000, 81, 20_000, 1] * 9
    got = list(H._batches(sizes, np.random.default_rng(1).permutation(len(sizes))))
    assert sorted(i for b in got for i in b) == list(range(len(sizes)))
    assert all(len(b) <= 16 and (len(b) == 1 or len(b) * max(sizes[i] for i in b) <= H.STEPS) for b in got)
