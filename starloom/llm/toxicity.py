"""Toxicity: a convolutional text classifier trained in numpy.

A word (a run of letters, digits or underscores, lower case; longer runs count
as words of 32) is the mean of
hashed embeddings: one row for the word and one for each of its letter
4-grams, so unseen words built from seen parts still say something. Filters
of widths 1, 2 and 3 slide over the words, each filter's largest response
over the whole text is kept (max pooling, which makes the score depend on
what is in a text, not on how long it is), and a linear layer with a sigmoid
gives the score. Nothing but the text enters a score.

Training reads every labelled row that is not held out. A fifth of them (by
the hash of the id) is kept from the updates and calibrates. The rest is dealt
over shards of about ``SHARD_TEXTS`` texts by the hash of their id. One pass counts,
over all of them, in how many texts of each class an embedding row occurs (the
start of the weights); then, in ``passes`` passes (one where there are
``TEXTS_SEEN`` texts, up to ``EPOCHS`` where there are fewer), every shard goes on
from the same weights with AdaGrad steps over all its texts, and the shards' changes are
averaged, each weight by how many steps changed it. Sums are of whole numbers, so the model
depends neither on partitions nor on order. Scoring runs over every whole text inside
Arrow batches. On the calibrating rows each language's threshold is set to the score that separates its
classes best; a language with fewer than ``MIN_PER_LANGUAGE`` calibrating
positives uses 0.5. Thresholds decide ``rejected``; they never enter scores.

Defined results: null and empty texts get the score of the empty text; equal
texts get equal scores; without labelled rows, or with one class only, every
score is the share of positives (0 without labels).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import Remembered, nullable, slices, without
from starloom.session import remove_folder, scratch_path

BUCKETS = 1 << 16
DIM = 16
FILTERS = 8
WIDTHS = (1, 2, 3)
PAD = sum(WIDTHS) * FILTERS
MAX_TRAIN_CHARS = 16_000
SHARD_TEXTS = 8192  # labelled texts of a shard, about
TEXTS_SEEN = 16_384  # texts that the passes together see, at least, if EPOCHS passes hold them
MIN_PER_LANGUAGE = 5
EPOCHS = 5
RATE = 0.1
WORD_DROPOUT = 0.2
BATCH = 16  # texts of a step
BATCH_WORDS = 65_536  # a step takes no further text beyond these
BLOCK_WORDS = 16_384
SETTLED = 0.01  # errors below this change nothing
SCALE = 2.0**24  # changes of weights are summed as whole parts of this
SCORE_BINS = 1 << 16  # calibrating scores are counted in this many bins
CACHE_WORDS = 200_000
WORD = re.compile(r"\w{1,32}")


def _gram(gram: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(gram, 1) % BUCKETS


_GRAMS = Remembered(_gram, CACHE_WORDS, 4)  # of this process


def parts(word: str) -> list[int]:
    """Embedding rows of a word: itself and its 4-grams with word ends."""
    import xxhash

    whole, grams = f"<{word}>", _GRAMS
    return [xxhash.xxh32_intdigest(word) % BUCKETS] + [grams[whole[i : i + 4]] for i in range(max(1, len(whole) - 3))]


def _hashes(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH32 (seed 1) of the ``size`` (below 16) bytes of ``text`` at each ``start``."""
    p1, p2, p3, p4, p5 = (np.uint32(p) for p in (2654435761, 2246822519, 3266489917, 668265263, 374761393))

    def mixed(h: np.ndarray, bits: int, by: np.uint32) -> np.ndarray:
        return (h << np.uint32(bits) | h >> np.uint32(32 - bits)) * by

    out = np.empty(len(start), np.uint32)
    for n in np.unique(size):
        own = np.flatnonzero(size == n)
        at = start[own]
        h = np.full(len(own), (1 + int(p5) + int(n)) & 0xFFFFFFFF, np.uint32)
        for i in range(0, n - 3, 4):
            lane = text[at + i] | text[at + i + 1] << np.uint32(8) | text[at + i + 2] << np.uint32(16) | text[at + i + 3] << np.uint32(24)
            h = mixed(h + lane * p3, 17, p4)
        for i in range(n - n % 4, n):
            h = mixed(h + text[at + i] * p5, 11, p1)
        h = (h ^ h >> np.uint32(15)) * p2
        h = (h ^ h >> np.uint32(13)) * p3
        out[own] = h ^ h >> np.uint32(16)
    return out


def parts_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(rows of each word's :func:`parts`, one word's after the other's, how many each has)."""
    import xxhash

    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    chars = np.fromiter(map(len, words), np.int64, len(words)) + 2
    text = np.frombuffer(f"<{'><'.join(words)}>".encode(), np.uint8).astype(np.uint32)
    at = np.append(np.flatnonzero(text & 0xC0 != 0x80), len(text))  # where each character starts
    grams = np.maximum(chars - 3, 1)
    sizes = grams + 1
    ends = np.cumsum(sizes)
    first = np.repeat(np.cumsum(chars) - chars, grams) + np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams, grams)
    start = at[first]
    size = at[first + np.repeat(np.minimum(chars, 4), grams)] - start
    short = size < 16
    hashed = np.empty(len(start), np.uint32)
    hashed[short] = _hashes(text, start[short], size[short])
    for i in np.flatnonzero(~short):  # four characters of four bytes
        hashed[i] = xxhash.xxh32_intdigest(text[start[i] : start[i] + size[i]].astype(np.uint8).tobytes(), 1)
    rows = np.empty(ends[-1], np.int64)
    whole = np.zeros(len(rows), bool)
    whole[ends - sizes] = True
    rows[whole] = np.fromiter(map(xxhash.xxh32_intdigest, words), np.int64, len(words)) % BUCKETS
    rows[~whole] = hashed % BUCKETS
    return rows, sizes


class KnownRows(dict):
    """Embedding rows of words, remembered within a bound; those of new words are found together."""

    def learn(self, texts: list[list[str]]) -> None:
        """Remember the rows of all words of some texts, at least."""
        words = set().union(*texts)
        new = [w for w in words if w not in self]
        if len(self) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(words)
        rows, sizes = parts_of(new)
        ends = np.cumsum(sizes).tolist()
        for w, a, b in zip(new, [0, *ends], ends):
            self[w] = rows[a:b]


@dataclass
class Model:
    """Weights; ``thresholds`` by language, 0.5 where there is none."""

    embedding: np.ndarray
    filters: list[np.ndarray]  # by width: (width * DIM, FILTERS)
    filter_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def word_vectors(self, words: list[list[int]]) -> np.ndarray:
        """Mean embedding of each word given by its rows."""
        return means(self.embedding, words)

    def projections(self, vectors: np.ndarray) -> np.ndarray:
        """What each word adds to each filter at each of its places."""
        places = np.concatenate([f[j * DIM : (j + 1) * DIM] for w, f in zip(WIDTHS, self.filters) for j in range(w)], axis=1)
        return (vectors @ places).astype(np.float32, copy=False)

    def _responses(self, proj: np.ndarray, first: bool, last: bool) -> Iterator[tuple[int, np.ndarray]]:
        """Of each width: (place of the first window, responses of all windows)."""
        at, n = 0, len(proj)
        for w in WIDTHS:
            rows = max(1, n + w - 1)
            conv = np.zeros((rows, FILTERS), np.float32)
            for j in range(w):  # places before the first word hold nothing
                conv[w - 1 - j : w - 1 - j + n] += proj[:, at : at + FILTERS]
                at += FILTERS
            skip = 0 if first else w - 1
            yield skip - (w - 1), conv[skip : rows if last else rows - (w - 1)]

    def largest(self, proj: np.ndarray, first: bool = True, last: bool = True) -> np.ndarray:
        """Largest response of each filter; proj: (words, PAD). A window may
        hang over the text's ends, not over a block's."""
        return np.concatenate([conv.max(axis=0) for _, conv in self._responses(proj, first, last)])

    def pooled(self, proj: np.ndarray, first: bool = True, last: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(largest response, its place) of each filter."""
        best, place = [], []
        for start, conv in self._responses(proj, first, last):
            place.append(conv.argmax(axis=0) + start)
            best.append(conv.max(axis=0))
        return np.concatenate(best), np.concatenate(place)

    def hidden(self, best: np.ndarray) -> tuple[np.ndarray, float]:
        """(responses above their bias, likelihood) of a text's largest responses."""
        hidden = np.maximum(best + self.filter_bias, 0)
        return hidden, float(1 / (1 + np.exp(-np.clip(hidden @ self.out + self.out_bias, -30, 30))))


def means(table: np.ndarray, words: list[list[int]]) -> np.ndarray:
    """Mean of each word's rows of ``table``."""
    if not words:
        return np.zeros((0, table.shape[1]), np.float32)
    return _means(table, np.concatenate(words), np.fromiter(map(len, words), np.int64, len(words)))


def _means(table: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.add.reduceat(table[rows], np.r_[0, np.cumsum(sizes)[:-1]], axis=0) / sizes.astype(np.float32).reshape(-1, 1)


def blocks(n: int) -> Iterator[tuple[slice, bool, bool]]:
    """(places, whether first, whether last) of a text's blocks of words; each
    begins with the words that a window may reach back to."""
    overlap = max(WIDTHS) - 1
    for at in range(0, max(1, n), BLOCK_WORDS):
        yield slice(max(0, at - overlap), at + BLOCK_WORDS), at == 0, at + BLOCK_WORDS >= n


class Scorer:
    """Scores texts with a bounded memory of words' projections."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.table = model.projections(model.embedding)  # of each embedding row
        self.places: dict[str, int] = {}
        self.rows = np.zeros((1024, PAD), np.float32)  # the first stays zero: it stands between texts

    def score(self, text: str) -> float:
        return self.model.hidden(self._pooled(WORD.findall(text.lower())))[1]

    def scores(self, texts: list[str]) -> list[float]:
        """:meth:`score` of each text; short ones are pooled together."""
        out, some, held = [], [], 0
        for text in texts:
            words = WORD.findall(text.lower())
            if some and held + len(words) > BLOCK_WORDS:
                out += self._together(some)
                some, held = [], 0
            some.append(words)
            held += len(words)
        return out + self._together(some) if some else out

    def _together(self, texts: list[list[str]]) -> list[float]:
        if len(texts) == 1:
            best = [self._pooled(texts[0])]
        else:
            best = self._pooled_each(texts)
        return [self.model.hidden(b)[1] for b in best]

    def _pooled(self, words: list[str]) -> np.ndarray:
        """Largest responses over a text, a block of words at a time."""
        most = None
        for at, first, last in blocks(len(words)):
            places = self._lookup(words[at])
            got = self.model.largest(self.rows[places], first, last)
            most = got if most is None else np.maximum(most, got)
        return most

    def _pooled_each(self, texts: list[list[str]]) -> np.ndarray:
        """Largest responses over each of some texts, laid out one after the
        other with as many zero rows between them as a window may hang over."""
        gap = max(WIDTHS) - 1
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        end = np.cumsum(sizes + gap)
        start = end - sizes
        line = np.zeros(end[-1] + gap + 1, np.int64)
        line[np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())] = self._lookup([w for t in texts for w in t])
        proj, best, at = self.rows[line], [], 0
        for w in WIDTHS:
            conv = np.zeros((len(line) - w + 1, FILTERS), np.float32)
            for j in range(w):
                conv += proj[j : j + len(conv), at : at + FILTERS]
                at += FILTERS
            # windows that begin from w - 1 places before a text to its last word
            best.append(np.maximum.reduceat(conv, np.stack([start - (w - 1), end], axis=1).ravel(), axis=0)[::2])
        return np.concatenate(best, axis=1)

    def _lookup(self, words: list[str]) -> np.ndarray:
        """Places of the words' projections in ``rows``."""
        known = self.places
        got = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(got < 0)
        if len(missing):
            new = list(dict.fromkeys(words[i] for i in missing))
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                new, missing = list(dict.fromkeys(words)), np.arange(len(words))
            start = len(known) + 1
            known.update(zip(new, range(start, start + len(new))))
            while len(self.rows) < start + len(new):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[start : start + len(new)] = _means(self.table, *parts_of(new))
            got[missing] = [known[words[i]] for i in missing]
        return got


class Vocabulary:
    """Words of the training texts and their embedding rows."""

    def __init__(self, rows_of: Callable[[str], list[int]] = parts) -> None:
        self.rows_of = rows_of
        self.places: dict[str, int] = {}
        self.rows: list[list[int]] = []

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of(WORD.findall(text.lower()))

    def ids_of(self, words: list[str]) -> np.ndarray:
        places = self.places
        for w in dict.fromkeys(words):
            if w not in places:
                places[w] = len(self.rows)
                self.rows.append(self.rows_of(w))
        return np.fromiter(map(places.__getitem__, words), np.int32, len(words))


def _distinct(rows: list, last: np.ndarray) -> np.ndarray:
    """Embedding rows that occur among those of some words, in any order;
    ``last``: room for BUCKETS numbers, whatever they are."""
    every = np.concatenate(rows).astype(np.int64, copy=False) if rows else np.zeros(0, np.int64)
    place = np.arange(len(every))
    last[every] = place
    return every[last[every] == place]


def _log_odds(seen: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """How much likelier each embedding row occurs in a positive text, from the
    numbers of texts of each class with the row (2, BUCKETS) and of texts: log
    odds of document frequencies, drawn to zero where there are few texts."""
    share = (seen + 0.5) / (np.maximum(texts, 1).reshape(2, 1) + 1)
    total = seen.sum(axis=0)
    return np.clip(np.log(share[1] / share[0]), -1, 4) * total / (total + 5)


def start_model(seen: np.ndarray, texts: np.ndarray, seed: int = 7) -> Model:
    """Weights before the first step, from the counts of :func:`_log_odds`; with
    texts of one class only, or none, every score is the share of positives."""
    rng = np.random.default_rng(seed)
    axis = rng.normal(0, 1, DIM)
    axis /= np.linalg.norm(axis)
    model = Model(  # one direction says how much likelier a row's word parts are in positive texts
        embedding=(rng.normal(0, 0.01, (BUCKETS, DIM)) + np.outer(_log_odds(seen, texts), axis)).astype(np.float32),
        filters=[(rng.normal(0, 0.3 / np.sqrt(w * DIM), (w * DIM, FILTERS)) + np.tile(axis, w).reshape(-1, 1) / w).astype(np.float32) for w in WIDTHS],
        filter_bias=np.full(len(WIDTHS) * FILTERS, -0.5, np.float32),
        out=np.full(len(WIDTHS) * FILTERS, 0.3, np.float32),
        out_bias=-2.0,
    )
    if not texts.all():
        share = texts[1] / texts.sum() if texts.any() else 0.0
        model.out[:] = 0
        model.out_bias = float(np.clip(np.log(max(share, 1e-12) / max(1 - share, 1e-12)), -30, 30))
    return model


class Trainer:
    """AdaGrad steps on a model's weights, which it changes in place."""

    def __init__(self, model: Model, texts: np.ndarray, seed: int) -> None:
        self.model, self.weight = model, texts.sum() / (2 * texts)  # classes weigh alike
        self.rng = np.random.default_rng(seed)
        like = {"e": model.embedding, **{f"f{i}": f for i, f in enumerate(model.filters)}, "b": model.filter_bias, "o": model.out}
        self.grown = {k: np.full_like(v, 1e-3) for k, v in like.items()}
        self.grown_bias = 1e-3
        self.steps = 0  # that changed something
        self.touched = np.zeros(BUCKETS, np.int64)  # steps that changed an embedding row

    def _adagrad(self, key: str, at, value: np.ndarray, grad: np.ndarray, rate: float) -> None:
        self.grown[key][at] += grad * grad
        value[at] -= rate * grad / np.sqrt(self.grown[key][at])

    def step(self, texts: list[np.ndarray], rows: list[list[int]], labels: list[int], rate: float) -> None:
        """One step on texts given as ids of words, ``rows`` being each word's rows."""
        model = self.model
        seen = [t[self.rng.random(len(t)) >= WORD_DROPOUT] for t in texts]
        every = np.concatenate(seen)
        kept = np.zeros(len(rows), bool)
        kept[every] = True
        used, back = np.flatnonzero(kept), (np.cumsum(kept) - 1)[every]
        vectors = model.word_vectors([rows[u] for u in used])
        proj = model.projections(vectors)
        g_f = [np.zeros_like(f) for f in model.filters]
        g_b, g_o, g_bias = np.zeros_like(model.filter_bias), np.zeros_like(model.out), 0.0
        g_words = np.zeros_like(vectors)
        start, moved = 0, False
        for t, y in zip(seen, labels):
            words = back[start : start + len(t)]
            start += len(t)
            found = [(at, model.largest(proj[words[at]], first, last)) for at, first, last in blocks(len(words))]
            best = np.max([b for _, b in found], axis=0)
            hidden, p = model.hidden(best)
            if abs(p - y) < SETTLED:
                continue
            moved = True
            place = self._places(proj, words, np.argmax([b for _, b in found], axis=0))
            err = float((p - y) * self.weight[y] / BATCH)
            g_o += err * hidden
            g_bias += err
            d = (err * model.out * (hidden > 0)).astype(np.float32)
            g_b += d
            for i, w in enumerate(WIDTHS):
                own = slice(i * FILTERS, (i + 1) * FILTERS)
                for j in range(w):
                    at_word = place[own] + j
                    inside = np.flatnonzero((at_word >= 0) & (at_word < len(words)))
                    if len(inside):
                        hit = words[at_word[inside]]
                        part = slice(j * DIM, (j + 1) * DIM)
                        g_f[i][part, inside] += vectors[hit].T * d[own][inside]
                        np.add.at(g_words, hit, (model.filters[i][part, inside] * d[own][inside]).T)
        if not moved:
            return
        self.steps += 1
        for i in range(len(WIDTHS)):
            self._adagrad(f"f{i}", slice(None), model.filters[i], g_f[i], rate)
        self._adagrad("b", slice(None), model.filter_bias, g_b, rate)
        self._adagrad("o", slice(None), model.out, g_o, rate)
        np.maximum(model.out, 0, out=model.out)  # a filter finds evidence for the class, never against it
        self.grown_bias += g_bias * g_bias
        model.out_bias -= rate * g_bias / np.sqrt(self.grown_bias)
        touched = np.flatnonzero(g_words.any(axis=1))
        if len(touched):
            sizes = np.array([len(rows[used[u]]) for u in touched])
            at_rows, where = np.unique(np.concatenate([rows[used[u]] for u in touched]), return_inverse=True)
            total = np.zeros((len(at_rows), DIM), np.float32)
            np.add.at(total, where, np.repeat(g_words[touched] / sizes.reshape(-1, 1), sizes, axis=0))
            self._adagrad("e", at_rows, model.embedding, total, rate)
            self.touched[at_rows] += 1

    def _places(self, proj: np.ndarray, words: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Place of each filter's largest response, which lies in the block of this number."""
        place = np.zeros(len(block), np.int64)
        for i, (at, first, last) in enumerate(blocks(len(words))):
            if (block == i).any():
                place = np.where(block == i, at.start + self.model.pooled(proj[words[at]], first, last)[1], place)
        return place


def train(texts: list[np.ndarray], rows: list[list[int]], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit in one process on texts given as ids of words, ``rows`` being each word's rows."""
    seen, last = np.zeros((2, BUCKETS)), np.empty(BUCKETS, np.int64)
    for words, y in zip(texts, labels):
        seen[y, _distinct([rows[u] for u in np.unique(words)], last)] += 1
    n = np.bincount(labels, minlength=2)
    model = start_model(seen, n, seed)
    if not n.all():
        return model
    trainer = Trainer(model, n, seed)
    for epoch in range(EPOCHS):
        order = trainer.rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            trainer.step([texts[t] for t in some], rows, [labels[t] for t in some], RATE * (1 - epoch / EPOCHS))
    return model


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The score that gives the largest F1; the middle of the gap it lies in."""
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    ends = np.r_[s[1:] != s[:-1], True]  # equal scores stay on one side
    at = int(np.argmax(np.where(ends, f1, -1)))
    return float((s[at] + (s[at + 1] if at + 1 < len(s) else 0.0)) / 2)


def _drawn(known: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows (doc_id, toxic, n): those of at most
    ``MAX_TRAIN_CHARS`` characters in hash order, then the shortest of the longer
    ones while all drawn hold no more than ``most * MAX_TRAIN_CHARS`` (the first
    row is drawn in any case). :func:`fit` draws nothing; it learns from every row."""
    long = F.when(F.col("n") > MAX_TRAIN_CHARS, F.col("n")).otherwise(0)
    order = [long, F.xxhash64(F.col("doc_id"), F.lit(11)), F.col("doc_id")]
    first = known.orderBy(*order).limit(most)
    so_far = F.sum("n").over(Window.orderBy(*order))  # over the drawn rows only
    return first.withColumn("_held", so_far).where((F.col("_held") <= most * MAX_TRAIN_CHARS) | (F.col("_held") == F.col("n"))).drop("_held")


def _labelled(documents: DataFrame, labels: DataFrame, pin: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(texts to learn from, texts to calibrate on): doc_id, toxic, text, lang of
    every id of ``labels`` (doc_id, toxic 0/1) that is not held out and has a text.
    Both are read from the folder ``pin``, if given, written once for all passes."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    whole = documents.where("doc_id is not null").where(~held_out("doc_id"))
    text = F.coalesce("text", F.lit(""))
    whole = whole.select("doc_id", F.struct(F.length(text).alias("n"), text.alias("text"), F.coalesce("lang", F.lit("")).alias("lang")).alias("t"))
    texts = whole.join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.min("t").alias("t")).select("doc_id", "toxic", "t.text", "t.lang")
    if pin:
        texts.write.parquet(pin, compression="zstd")
        texts = documents.sparkSession.read.schema(texts.schema).parquet(pin)
    back = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(5)) == 0
    return texts.where(~back), texts.where(back)


def _texts(batches: Iterator) -> Iterator[tuple[str, int]]:
    for whole in batches:
        for b in slices(whole, "text"):
            yield from zip(b.column("text").to_pylist(), b.column("toxic").to_pylist())


def _steps(batches: Iterator) -> Iterator[tuple[list[list[str]], list[int]]]:
    """(words of each text, labels) of the texts of one step after the other's."""
    texts, labels = [], []
    for text, y in _texts(batches):
        texts.append(WORD.findall(text.lower()))
        labels.append(y)
        if len(texts) == BATCH or sum(map(len, texts)) >= BATCH_WORDS:
            yield texts, labels
            texts, labels = [], []
    if texts:
        yield texts, labels


def _counts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts of each class every embedding row occurs, (2, BUCKETS),
    and how many texts of each class there are."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen = np.zeros((2, BUCKETS + 1), np.int64)  # the last place counts the texts
        known, last = KnownRows(), np.empty(BUCKETS, np.int64)
        for texts, labels in _steps(batches):
            known.learn(texts)
            for words, y in zip(texts, labels):
                seen[y, _distinct([known[w] for w in set(words)], last)] += 1
                seen[y, BUCKETS] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[0, at]), pa.array(seen[1, at])], names=["at", "n0", "n1"])

    sums = texts.select("text", "toxic").mapInArrow(run, "at long, n0 long, n1 long").groupBy("at").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    got = sums.toArrow()  # a row per embedding row at most
    seen = np.zeros((2, BUCKETS + 1), np.int64)
    for cls in (0, 1):
        seen[cls, got["at"].to_numpy()] = got[f"n{cls}"].to_numpy()
    return seen[:, :BUCKETS].astype(float), seen[:, BUCKETS]


def _flat(model: Model) -> np.ndarray:
    """All weights in rows of DIM: the embedding's, then the others'."""
    rest = np.concatenate([*[f.ravel() for f in model.filters], model.filter_bias, model.out, [model.out_bias]]).astype(np.float64)
    return np.concatenate([model.embedding, np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)])


def _unflat(rows: np.ndarray) -> Model:
    sizes = [w * DIM * FILTERS for w in WIDTHS] + [len(WIDTHS) * FILTERS] * 2 + [1]
    *filters, bias, out, out_bias, _ = np.split(rows[BUCKETS:].ravel(), np.cumsum(sizes))
    filters = [f.reshape(-1, FILTERS).astype(np.float32) for f in filters]
    return Model(rows[:BUCKETS].astype(np.float32), filters, bias.astype(np.float32), out.astype(np.float32), float(out_bias[0]))


def _pass(texts: DataFrame, model: Model, n: np.ndarray, rate: float, seed: int) -> Model:
    """Every shard (a partition, its texts in the order of a hash) goes on from
    ``model`` with steps over all its texts; their changes averaged, each row of
    weights by the steps that changed it."""
    order = F.xxhash64("doc_id", F.lit(11))
    texts = texts.repartition(max(1, -(-int(n.sum()) // SHARD_TEXTS)), order).sortWithinPartitions(order, "doc_id")
    shipped = texts.sparkSession.sparkContext.broadcast(_flat(model))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        before = shipped.value
        own = _unflat(before.copy())
        trainer = Trainer(own, n, seed)
        known = KnownRows()
        for words, labels in _steps(batches):
            known.learn(words)
            vocabulary = Vocabulary(known.__getitem__)
            trainer.step([vocabulary.ids_of(w) for w in words], vocabulary.rows, labels, rate)
        after = _flat(own)
        steps = np.concatenate([trainer.touched, np.full(len(after) - BUCKETS, trainer.steps)])
        at = np.flatnonzero(steps)
        change = np.rint((after[at] - before[at]) * SCALE).astype(np.int64) * steps[at].reshape(-1, 1)
        columns = [pa.array(at), pa.array(steps[at]), *[pa.array(np.ascontiguousarray(change[:, i])) for i in range(DIM)]]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["at", "steps", *[f"v{i}" for i in range(DIM)]]
    changes = texts.select("text", "toxic").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    got = changes.groupBy("at").agg(*[F.sum(c).alias(c) for c in names[1:]]).toArrow()  # a row per row of weights
    out = _flat(model).astype(np.float64)
    at = got["at"].to_numpy()
    out[at] += np.stack([got[c].to_numpy() for c in names[2:]], axis=1) / SCALE / got["steps"].to_numpy().reshape(-1, 1)
    return _unflat(out)


def _thresholds(scored: DataFrame) -> dict[str, float]:
    """:func:`best_threshold` by language of (lang, score, toxic), scores of one
    bin staying on one side; languages with few positives, or no negative, have none."""
    bins = scored.groupBy("lang", F.floor(F.col("score") * SCORE_BINS).alias("bin")).agg(
        F.sum("toxic").alias("y"), F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")
    )
    every, down = Window.partitionBy("lang"), Window.partitionBy("lang").orderBy(F.desc("bin"))  # at most SCORE_BINS + 1 rows each
    at = bins.select(
        "lang",
        "bin",
        F.sum("y").over(every).alias("positives"),
        F.sum("n").over(every).alias("rows"),
        (2 * F.sum("y").over(down) / (F.sum("n").over(down) + F.sum("y").over(every))).alias("f1"),
        ((F.col("lo") + F.coalesce(F.lead("hi").over(down), F.lit(0.0))) / 2).alias("at"),
    )
    best = at.where((F.col("positives") >= MIN_PER_LANGUAGE) & (F.col("rows") > F.col("positives"))).groupBy("lang").agg(F.max_by("at", F.struct("f1", "bin")).alias("at"))
    return {r["lang"]: r["at"] for r in best.collect()}  # a row per language


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Train on every row of ``labels`` (doc_id, toxic 0/1) that is not held
    out (:func:`held_out`); a document with several labels counts as toxic if
    one says so, an id with several texts counts with the shortest of them, the
    least of these."""
    pin = scratch_path(documents.sparkSession, "labelled")
    try:
        return _fit(*_labelled(documents, labels, pin))
    finally:
        remove_folder(documents.sparkSession, pin)


def _fit(texts: DataFrame, back: DataFrame) -> Model:
    seen, n = _counts(texts)
    model = start_model(seen, n)
    if not n.all():
        return model
    passes = int(min(EPOCHS, -(-TEXTS_SEEN // n.sum())))
    for i in range(passes):
        model = _pass(texts, model, n, RATE * (1 - i / passes), seed=7 + i)
    model.thresholds = _thresholds(score(back, model).select("lang", "score", "toxic"))
    return model


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def score(df: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``df`` with ``out_col double`` from 0 to 1: the score of every whole text."""
    shipped = df.sparkSession.sparkContext.broadcast(model)
    src = without(df, out_col)
    names = src.columns
    out = nullable(T.StructType([*src.schema.fields, T.StructField(out_col, T.DoubleType())]))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = Scorer(shipped.value)
        for whole in batches:
            for b in slices(whole, text_col):
                got = scorer.scores([t or "" for t in b.column(b.schema.get_field_index(text_col)).to_pylist()])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], names=[*names, out_col])

    return src.mapInArrow(run, out)


def rejected(model: Model, score_col: str = "score", lang_col: str = "lang") -> F.Column:
    """Whether the score reaches the threshold of the row's language."""
    limit = F.lit(0.5)
    for lang, at in model.thresholds.items():
        limit = F.when(F.col(lang_col) == lang, F.lit(at)).otherwise(limit)
    return F.col(score_col) >= limit


def digests(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and rejected by language's threshold."""
    model = fit(documents, labels)
    scored = score(documents.select("doc_id", "text", "lang"), model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), rejected(model).alias("rejected"))
