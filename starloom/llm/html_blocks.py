"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks: runs of text between the boundaries of block
elements. A bidirectional LSTM in numpy reads the page's blocks in order; a
block's input is the sum of learned vectors of its tag path (each different tag
of all open elements and word of their class, id and role), the mean of learned
vectors of its hashed words, and a few shares (length, links, punctuation,
place). Both directions see the whole page, so every block is classified in
the context of all others. Blocks labelled as main text are joined.

Training: no page comes labelled. A bounded sample of pages (``SAMPLE_PAGES``
pages in hash order, of at most ``SAMPLE_CHARS`` characters) goes to the
driver. Their blocks are the raw material of ``MADE_PAGES`` composed pages
whose layout is drawn at random - container elements and class names of main
text, menus, headers, footers, sidebars, notices, adverts, forms, comments -
so that each block's label is known; sampled pages that mark their main text
by one article or main element are added with the labels this implies. Pages
are trained on whole; path names that training never met have zero vectors.

Defined results: a null or empty page has an empty text; equal pages have
equal texts; only an unclosed script, style, noscript, iframe or title hides
what follows it, as in a browser, and formulas are text of their block; a page of any length is read whole; an empty table stays empty;
without pages to learn from, the composed pages use a few built-in words.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import nullable, slices, without
from starloom.llm.markup import RAW, closed_elements, scan, unescape

SAMPLE_PAGES = 200
SAMPLE_CHARS = 60_000
MADE_PAGES = 700
LONG_BLOCKS = 80  # pages of more blocks are trained on in batches of their own
EPOCHS = 6
PATHS, WORDS = 2048, 4096
VECTOR, HIDDEN, SHARES = 12, 20, 8
INPUT = 2 * VECTOR + SHARES
CACHE_WORDS = 200_000
STEPS = 1 << 14  # padded blocks that one pass of the network holds, a longer page aside

# Elements that bound blocks, elements without content.
BOUNDS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html input label legend li main menu nav ol option p pre section select summary table tbody "
    "td textarea tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = f"{RAW}|title"
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORD = re.compile(r"[a-z]+", re.I)


@dataclass
class Block:
    text: str
    path: list[str]
    linked: int  # characters inside links


def blocks(page: str) -> list[Block]:
    """Blocks with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    parts: list[str] = []
    in_link, linked = False, 0

    def end() -> None:
        nonlocal parts, in_link, linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(Block(text, [n for _, names in stack for n in names], linked))
            parts, linked = [], 0
        in_link = False

    unseen, skip = dict(closed_elements(page, SILENT)), 0
    for m in scan(page, SILENT):
        if unseen:
            skip = max(skip, unseen.get(m.start(), 0))
            if m.start() < skip:
                continue
        text = m[6]
        if text is not None:
            parts.append(text)
            if in_link:
                linked += len(text)
            continue
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BOUNDS:
            if tag == "a":
                in_link = not m[2]
            elif tag == "br":
                parts.append(" ")
            continue
        end()
        if m[2]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    del stack[at:]
                    break
            continue
        if stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "option", "td", "th", "tr", "dd", "dt")):
            stack.pop()  # end tags that HTML lets a page leave out
        if tag not in VOID:
            names = [w.lower() for v in NAMED.findall(m[4]) for w in _WORD.findall("".join(v))]
            stack.append((tag, [f"<{tag}>", *names]))
    end()
    return out


class Features:
    """Blocks -> hashed path rows, hashed word rows and shares."""

    def __init__(self) -> None:
        self._words: dict[str, int] = {}
        self._names: dict[str, int] = {}

    def name(self, n: str) -> int:
        got = self._names.get(n)
        if got is None:
            if len(self._names) >= CACHE_WORDS:
                self._names.clear()
            got = self._names[n] = zlib.crc32(n.encode()) % PATHS
        return got

    def word(self, w: str) -> int:
        got = self._words.get(w)
        if got is None:
            if len(self._words) >= CACHE_WORDS:
                self._words.clear()
            got = self._words[w] = zlib.crc32(w.lower().encode("utf-8", "replace")) % WORDS
        return got

    def page(self, found: list[Block]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        paths, words = [], []
        shares = np.zeros((len(found), SHARES), np.float32)
        for i, b in enumerate(found):
            paths.append([self.name(n) for n in dict.fromkeys(b.path)] + [self.name(f"leaf {b.path[-1] if b.path else ''}")])
            words.append([self.word(w) for w in b.text.split()])
            n = len(b.text)
            shares[i, :6] = np.log1p(n) / 8, min(1.0, b.linked / n), min(1.0, 10 * sum(map(b.text.count, ".!?,;")) / n), np.log1p(len(words[-1])) / 6, b.text[-1] in ".!?", b.text.isupper()
            shares[i, 6:] = i / len(found), 1 / (1 + len(found) - i)
        return paths, words, shares


def _sums(table: np.ndarray, rows: list[list[int]], mean: bool) -> np.ndarray:
    sizes = np.array([len(r) for r in rows])
    flat = np.fromiter((x for r in rows for x in r), np.int64, sizes.sum())
    out = np.add.reduceat(table[flat], np.r_[0, np.cumsum(sizes)[:-1]], axis=0)
    return out / sizes[:, None] if mean else out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights, forward pass and gradients of the labeller."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        self.w = {"paths": normal(0.3, PATHS, VECTOR), "words": normal(0.1, WORDS, VECTOR), "out": normal(0.2, 2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.w[f"x{d}"] = normal(1 / np.sqrt(INPUT), INPUT, 4 * HIDDEN)
            self.w[f"h{d}"] = normal(1 / np.sqrt(HIDDEN), HIDDEN, 4 * HIDDEN)
            self.w[f"b{d}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)  # gates: in, forget, out, candidate

    def inputs(self, paths, words, shares) -> np.ndarray:
        return np.concatenate([_sums(self.w["paths"], paths, False), _sums(self.w["words"], words, True), shares], axis=1).astype(np.float32)

    def _direction(self, d: str, x: np.ndarray, live: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (steps, pages, HIDDEN) of one direction; x: (steps, pages, INPUT)."""
        steps, pages, _ = x.shape
        h = c = np.zeros((pages, HIDDEN), np.float32)
        drive = x.reshape(-1, INPUT) @ self.w[f"x{d}"] + self.w[f"b{d}"]
        drive = drive.reshape(steps, pages, -1)
        out, past = np.zeros((steps, pages, HIDDEN), np.float32), [None] * steps
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = drive[t] + h @ self.w[f"h{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            on = live[t][:, None]
            c_new = np.where(on, f * c + i * g, c)
            h_new = np.where(on, o * np.tanh(c_new), h)
            if keep:
                past[t] = (h, c, c_new, i, f, o, g)
            h, c, out[t] = h_new, c_new, h_new
        return out, past

    def forward(self, x: np.ndarray, live: np.ndarray, keep: bool = False):
        hf, pf = self._direction("f", x, live, keep)
        hb, pb = self._direction("b", x, live, keep)
        hidden = np.concatenate([hf, hb], axis=2)
        return _sigmoid(hidden @ self.w["out"] + self.w["bias"][0]), hidden, (pf, pb)

    def gradients(self, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean cross-entropy, and of x."""
        p, hidden, pasts = self.forward(x, live, keep=True)
        err = ((p - y) * live / max(1, live.sum())).astype(np.float32)
        grads = {"out": np.einsum("tb,tbh->h", err, hidden), "bias": np.array([err.sum()], np.float32)}
        dx = np.zeros_like(x)
        steps = len(x)
        for d, past, part in (("f", pasts[0], slice(0, HIDDEN)), ("b", pasts[1], slice(HIDDEN, None))):
            dh_next = np.zeros((x.shape[1], HIDDEN), np.float32)
            dc_next = np.zeros_like(dh_next)
            dz_all = np.zeros((steps, x.shape[1], 4 * HIDDEN), np.float32)
            gh = np.zeros_like(self.w[f"h{d}"])
            for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
                h, c, c_new, i, f, o, g = past[t]
                on = live[t][:, None]
                dh = err[t][:, None] * self.w["out"][part] + dh_next
                tc = np.tanh(c_new)
                dc = np.where(on, dc_next + dh * o * (1 - tc * tc), 0)
                dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1) * on
                dz_all[t] = dz
                gh += h.T @ dz
                dh_next = np.where(on, dz @ self.w[f"h{d}"].T, dh)
                dc_next = np.where(on, dc * f, dc_next)
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            grads[f"h{d}"], grads[f"x{d}"], grads[f"b{d}"] = gh, x.reshape(-1, INPUT).T @ flat, flat.sum(axis=0)
            dx += (flat @ self.w[f"x{d}"].T).reshape(x.shape)
        return grads, dx

    def labels(self, pages: list[tuple]) -> list[np.ndarray]:
        """Main text or not, for each block of pages given by their features."""
        out: list[np.ndarray | None] = [None] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][0]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and len(pages[order[stop]][0]) * (stop + 1 - at) <= STEPS:
                stop += 1
            some = order[at:stop]
            sizes = [len(pages[i][0]) for i in some]
            if max(sizes):
                x, live = padded([self.inputs(*pages[i]) if n else np.zeros((0, INPUT), np.float32) for i, n in zip(some, sizes)])
                p = self.forward(x, live)[0]
            for k, (i, n) in enumerate(zip(some, sizes)):
                out[i] = p[:n, k] >= 0.5 if n else np.zeros(0, bool)
            at = stop
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    live = np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k] = p
        live[: len(p), k] = True
    return x, live


def train(pages: list[tuple[list[Block], np.ndarray]], seed: int = 3) -> Network:
    """Fit on pages given as blocks and their labels (Adam)."""
    net, rng, features = Network(seed), np.random.default_rng(seed), Features()
    data = [(*features.page(b), y.astype(np.float32)) for b, y in pages if b]
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for epoch in range(EPOCHS):
        for batch in _batches([len(d[3]) for d in data], rng.permutation(len(data))):
            some = [data[i] for i in batch]
            x, live = padded([net.inputs(*d[:3]) for d in some])
            y = np.zeros(live.shape, np.float32)
            for k, d in enumerate(some):
                y[: len(d[3]), k] = d[3]
            grads, dx = net.gradients(x, live, y)
            grads |= {"paths": np.zeros_like(net.w["paths"]), "words": np.zeros_like(net.w["words"])}
            for k, (paths, words, _, _) in enumerate(some):
                for t, (p, w) in enumerate(zip(paths, words)):
                    np.add.at(grads["paths"], p, dx[t, k, :VECTOR])
                    np.add.at(grads["words"], w, dx[t, k, VECTOR : 2 * VECTOR] / len(w))
            step += 1
            rate = 0.01 * (1 - 0.8 * epoch / EPOCHS)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    net.w["paths"][~second["paths"].any(axis=1)] = 0  # names never met say nothing, so many of them drown no other
    return net


def _batches(sizes: list[int], order: np.ndarray, most: int = 16) -> Iterator[list[int]]:
    """Whole pages in ``order``, those of more than ``LONG_BLOCKS`` blocks last;
    a batch holds at most ``STEPS`` padded blocks, a longer page aside."""
    some: list[int] = []
    for i in sorted(order, key=lambda i: sizes[i] > LONG_BLOCKS):
        widest = max(sizes[j] for j in [*some, i])
        if some and (len(some) == most or widest > LONG_BLOCKS >= sizes[some[0]] or widest * (len(some) + 1) > STEPS):
            yield some
            some = []
        some.append(i)
    if some:
        yield some


# --- composed pages -------------------------------------------------------------------------------------

_NAMES = {  # words that sites commonly use in class, id and role of a part
    "main": "content post entry article story body text main page-content post-content entry-content article-body rich-text",
    "menu": "nav menu navbar navigation topnav menubar breadcrumb breadcrumbs pagination tabs",
    "header": "header masthead site-header logo branding topbar banner",
    "footer": "footer site-footer copyright colophon legal bottom",
    "side": "sidebar side widget widgets related recent popular toc share social tags",
    "notice": "cookie cookies consent notice gdpr alert popup modal newsletter subscribe paywall",
    "advert": "ad ads advert advertisement sponsor sponsored promo banner-ad adsbygoogle",
    "form": "form search login signup contact search-form",
    "comments": "comments comment comment-list comment-body replies disqus discussion respond",
}
_TAGS = {"main": ("article", "main", "div", "section", "div"), "menu": ("nav", "div", "ul"), "header": ("header", "div"), "footer": ("footer", "div"), "side": ("aside", "div"), "notice": ("div", "section", "aside"), "advert": ("div", "aside", "section"), "form": ("form",), "comments": ("section", "div", "ol")}
_BUILT_IN = ["A first sentence of some length, with a comma.", "Home", "More words follow here and there.", "About us", "Short", "The last of the sentences was the longest of all of them, by far."]


class Composer:
    """Draws pages with known labels from a stock of texts."""

    def __init__(self, stock: list[str], seed: int = 5) -> None:
        self.rng = np.random.default_rng(seed)
        self.stock = stock or _BUILT_IN

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def text(self, short: bool) -> str:
        text = self.pick(self.stock)
        if short:
            words = text.split()
            at = int(self.rng.integers(len(words)))
            text = " ".join(words[at : at + int(self.rng.integers(1, 5))])
        return html.escape(text, quote=False)

    def opened(self, kind: str) -> tuple[str, str]:
        tag = self.pick(_TAGS[kind])
        named = tag in ("div", "section", "ul", "ol") or self.rng.random() < 0.4
        attr = f' {self.pick(("class", "id"))}="{self.pick(_NAMES[kind].split())}"' if named else ""
        return f"<{tag}{attr}>", f"</{tag}>"

    def main(self) -> str:
        mark = "\x01"  # in front of every block that is main text
        out = [f"<h{self.rng.integers(1, 3)}>{mark}{self.text(self.rng.random() < 0.5)}</h1>"]
        for _ in range(int(self.rng.integers(1, 9))):
            kind = self.rng.random()
            if kind < 0.70:
                out.append(f"<p>{mark}{self.pick(('', '<b>'))}{self.text(self.rng.random() < 0.2)}{self.pick(('</p>', '</p>', '', '<br>'))}")
            elif kind < 0.78:
                out.append("<ul>" + "".join(f"<li>{mark}{self.text(self.rng.random() < 0.5)}" for _ in range(3)) + "</ul>")
            elif kind < 0.84:
                out.append(f"<h{self.rng.integers(2, 5)}>{mark}{self.text(True)}</h2>")
            elif kind < 0.88:
                out.append(f"<blockquote>{mark}{self.text(False)}</blockquote>")
            elif kind < 0.92:
                out.append(f'<p>{mark}{self.text(False)} <a href="x">{self.text(True)}</a></p>')
            else:
                out.append(self.other(self.pick(("advert", "side", "notice", "form"))))
        return "".join(out)

    def other(self, kind: str) -> str:
        start, end = self.opened(kind)
        n = int(self.rng.integers(1, 7))
        if kind in ("menu", "side") and self.rng.random() < 0.8:
            body = "<ul>" + "".join(f'<li><a href="/{i}">{self.text(True)}</a></li>' for i in range(n)) + "</ul>"
        elif kind == "form":
            body = f"<label>{self.text(True)}</label><input><button>{self.text(True)}</button>"
        elif kind == "comments":
            body = "".join(f"<li><p>{self.text(False)}</p></li>" for _ in range(n))
        else:
            body = "".join(self.pick(("{}", "<p>{}</p>", "<div>{}</div>")).format(self.text(self.rng.random() < 0.4)) for _ in range(1 + n // 3))
        return start + body + end

    def page(self) -> tuple[list[Block], np.ndarray]:
        chance = self.rng.random
        start, end = self.opened("main")
        if chance() < 0.3:
            outer = self.opened("main")
            start, end = outer[0] + start, end + outer[1]
        before = [self.other(k) for k in ("header", "menu", "notice", "advert", "form", "side") if chance() < 0.45]
        after = [self.other(k) for k in ("side", "comments", "advert", "form", "menu", "notice") if chance() < 0.3]
        self.rng.shuffle(before)
        if chance() < 0.85:
            after.append(self.other("footer"))
        inside = self.other("comments") if chance() < 0.15 else ""
        page = f"<html><body>{''.join(before)}{start}{self.main()}{inside}{end}{''.join(after)}"
        found = blocks(page)
        y = np.array([b.text.startswith("\x01") for b in found])
        for b in found:
            b.text = b.text.replace("\x01", "").strip() or "x"
        return found, y


def _implied(found: list[Block]) -> np.ndarray | None:
    """Labels of a page whose main text is marked by an article or main element."""
    inside = np.array(["<article>" in b.path or "<main>" in b.path for b in found])
    apart = np.array([any(f"<{t}>" in b.path for t in ("nav", "aside", "footer", "form", "button")) for b in found])
    return inside & ~apart if inside.any() and not inside.all() else None


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Network:
    """Train on a sample of ``pages`` and pages composed from its blocks."""
    share = min(1.0, 4 * SAMPLE_PAGES / max(1, pages.count()))  # so that tasks send few pages, however many tasks there are
    keyed = pages.select(id_col, html_col, F.xxhash64(F.col(html_col), F.col(id_col), F.lit(17)).alias("_h"))
    sample = keyed.where(F.length(html_col).between(1, SAMPLE_CHARS) & (F.col("_h") <= int(share * 2**64) - 2**63 - (share == 1.0)))
    rows = sample.orderBy("_h", id_col, html_col).limit(SAMPLE_PAGES).collect()
    found = [blocks(r[html_col]) for r in rows]
    made = Composer([b.text for page in found for b in page])
    data = [made.page() for _ in range(MADE_PAGES)]
    data += [(b, y) for b in found if b and (y := _implied(b)) is not None]
    return train(data)


def extract(pages: DataFrame, net: Network, html_col: str = "html", text_col: str = "text", keep_html: bool = False) -> DataFrame:
    """``pages`` with ``text_col``: the main text of every whole page."""
    shipped = pages.sparkSession.sparkContext.broadcast(net)
    src = without(pages, text_col)
    kept = [c for c in src.columns if keep_html or c != html_col]
    out = nullable(T.StructType([*(src.schema[c] for c in kept), T.StructField(text_col, T.StringType())]))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        network, features = shipped.value, Features()
        for whole in batches:
            for b in slices(whole, html_col):
                found = [blocks(p) if p else [] for p in b.column(b.schema.get_field_index(html_col)).to_pylist()]
                main = network.labels([features.page(f) for f in found])
                texts = ["\n".join(x.text for x, y in zip(f, m) if y) for f, m in zip(found, main)]
                cols = [b.column(b.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string())], names=[*kept, text_col])

    return src.mapInArrow(run, out)


def digests(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    p = pages.select("page_id", "url", "html")
    return extract(p, fit(p)).withColumn("n_chars", F.length("text").cast("long"))
