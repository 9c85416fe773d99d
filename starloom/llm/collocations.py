"""Phrase collocation mining on a weighted de Bruijn graph.

Words of a piece of text are read through windows of ``LONGEST`` (four) words,
one at every word. A full window is an edge of a de Bruijn graph: from the node
of its first three words to the node of its last three, overlapping in two. The
windows at a piece's end have fewer words; they are the piece-end corrections.
So every word occurrence gives one row, pre-counted inside the task, and:

* the weight of an edge is its phrase's count;
* the flow of a node, its out-edges' weights plus the pieces that end with it,
  is the count of its three words; likewise the flow of the nodes that begin
  with a pair, plus pieces that end with the pair, is the pair's count, and so
  on down to words. Windows are dealt by node, so edges and flows come out of
  one shuffle; only the flows travel on.

Words are counted first: a phrase that reaches ``min_count`` has only words that
do, so a window ends at any other word as at a piece's end. If these words are
few enough for a broadcast (``VOCABULARY``, checked), windows are whole numbers;
beyond that they carry their text, with equal results.

Among phrases that reach ``min_count``, an edge as heavy as both of its nodes
is the only way out of the one and into the other. Chains of such edges are
compacted into paths by pointer doubling (they can't be longer than a piece, nor
circular). A path stands for all its nodes and edges: it covers its pairs with
one row each and drops its inner nodes without a look-up; ``paths`` returns them,
whatever their length.

A candidate's score is its weakest cut: ``scale * f(phrase) / (f(first part) +
f(rest))`` in whole numbers, rounded down; the earliest of equal cuts. Looked-up
counts are spread over ``SALTS`` copies, so a word or pair that stands in a third
of all candidates doesn't meet them in one task; the best of a language are
taken by partial top lists.

Defined results: null texts have no words; a null language is ``und``; repeated
rows count as often as they stand; an empty table gives empty tables; other
columns are not read. Only A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import materialize, slices

LONGEST = 4
MIN_COUNT = 30
COVER_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
UNKNOWN = "und"
SALTS = 16
CHUNK_WORDS = 1_500_000  # words that a task counts at once
WORD_BITS = 20
VOCABULARY = (1 << WORD_BITS) - 1  # most words that are numbered and broadcast

# fixed values: what ends a piece, what parts words
PIECE_END = b".,;:!?\x0a\x0b\x0c\x0d"
BLANK = b"\x20\x09"


class Mined(NamedTuple):
    """Tables of one run."""

    counts: DataFrame  # lang, phrase, k, f: words (all), longer phrases of min_count and more
    paths: DataFrame  # lang, phrase, n_words, f: maximal unary paths of the heavy graph
    collocations: DataFrame  # lang, rank, phrase, a, l, r, n, score


def _plain_text() -> bytes:
    """Translation of bytes: A-Z to a-z, every piece end to the first, every blank to the first."""
    plain = bytearray(range(256))
    plain[65:91] = range(97, 123)
    for signs in (PIECE_END, BLANK):
        for c in signs:
            plain[c] = signs[0]
    return bytes(plain)


def _chunks(batches: Iterator, numbering) -> Iterator:
    """(numbering, {lang: word numbers}) of CHUNK_WORDS words at a time; a piece
    ends with the number 0. ``numbering()`` gives the object whose items number
    a language's words."""
    import numpy as np

    plain, end, between = _plain_text(), PIECE_END[:1], BLANK[:1]
    numbers, held, n_held = numbering(), {}, 0
    for whole in batches:
        for b in slices(whole, "text"):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tokens = text.encode("utf-8", "replace").translate(plain).replace(end, between + end + between).split(between)
                ids = np.fromiter(map(numbers[lang].__getitem__, filter(None, tokens)), np.int64)
                held.setdefault(lang, []).append(np.append(ids, 0))
                n_held += len(ids)
                if n_held >= CHUNK_WORDS:
                    yield numbers, {k: np.concatenate(v) for k, v in held.items()}
                    numbers, held, n_held = numbering(), {}, 0
    if held:
        yield numbers, {k: np.concatenate(v) for k, v in held.items()}


class _Met(dict):
    """Numbers words as they come, from 1; the piece end is 0."""

    def __init__(self) -> None:
        self[PIECE_END[:1]] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _ByLang(dict):
    def __init__(self, kind) -> None:
        self.kind = kind

    def __missing__(self, lang: str):
        self[lang] = made = self.kind()
        return made


class _Known(dict):
    """Numbers of given words; any other, and the piece end, is 0."""

    def __missing__(self, word: bytes) -> int:
        return 0


def _following(w) -> list:
    """The words at every place and at the three behind it, 0 from a piece's end on."""
    import numpy as np

    cols = [w]
    for i in range(1, LONGEST):
        cols.append(np.where(cols[-1] != 0, np.append(w[i:], np.zeros(min(i, len(w)), np.int64)), 0))
    return cols


def _texts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")


def _word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all words."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for numbers, held in _chunks(batches, lambda: _ByLang(_Met)):
            for lang, w in held.items():
                counts = np.bincount(w, minlength=len(numbers[lang]))[1:]
                words = pa.array(list(numbers[lang])[1:], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), words, pa.array(counts, pa.int64())], names=["lang", "phrase", "c"])

    return texts.mapInArrow(run, "lang string, phrase string, c long").groupBy("lang", "phrase").agg(F.sum("c").alias("f"))


def _windows(texts: DataFrame) -> DataFrame:
    """(lang, gram, c): windows of up to LONGEST words, counted per task."""
    between = BLANK[:1].decode()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for numbers, held in _chunks(batches, lambda: _ByLang(_Met)):
            for lang, w in held.items():
                n, words = len(numbers[lang]), pa.array(list(numbers[lang]), pa.binary()).cast(pa.string())
                cols = [c[w != 0] for c in _following(w)]
                # two words to a number, twice, made dense so that a pair of pairs fits 64 bits
                (pairs, left), (rests, right) = (np.unique(a * n + b, return_inverse=True) for a, b in (cols[:2], cols[2:]))
                keys, counts = np.unique(left * max(1, len(rests)) + right, return_counts=True)
                left, right = pairs[keys // max(1, len(rests))], rests[keys % max(1, len(rests))]
                at = [left // n, left % n, right // n, right % n]
                for lo in range(0, len(keys), 200_000):
                    hi = lo + 200_000
                    parts = [words.take(pa.array(a[lo:hi], mask=a[lo:hi] == 0)) for a in at]
                    gram = pc.binary_join_element_wise(*parts, between, null_handling="skip")
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), gram, pa.array(counts[lo:hi], pa.int64())], names=["lang", "gram", "c"])

    return texts.mapInArrow(run, "lang string, gram string, c long")


def _numbered_windows(texts: DataFrame, table: Broadcast) -> DataFrame:
    """(node, next, c): windows of two to LONGEST words that reach ``min_count``,
    by their numbers; a word that doesn't ends a window as a piece end does."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known = _ByLang(_Known)
        for lang, words, first in table.value:
            known[lang] = _Known(zip(words, range(first, first + len(words))))
        for _, held in _chunks(batches, lambda: known):
            cols = _following(np.concatenate(list(held.values())))
            live = (cols[0] != 0) & (cols[1] != 0)
            a, b, c, d = (x[live] for x in cols)
            nodes, at = np.unique((a << 2 * WORD_BITS) | (b << WORD_BITS) | c, return_inverse=True)
            keys, counts = np.unique((at << WORD_BITS) | d, return_counts=True)
            names = ["node", "next", "c"]
            last = (keys & ((1 << WORD_BITS) - 1)).astype(np.int32)
            for lo in range(0, len(keys), 200_000):
                part = np.s_[lo : lo + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array(nodes[keys[part] >> WORD_BITS]), pa.array(last[part]), pa.array(counts[part], pa.int64())], names=names)

    return texts.mapInArrow(run, "node long, next int, c long")


def _count_by_number(texts: DataFrame, words: DataFrame, min_count: int) -> DataFrame:
    """lang, phrase, k, f of the phrases of two and more words."""
    spark = texts.sparkSession
    by_lang: dict[str, list[tuple[int, bytes]]] = {}
    for r in words.where(F.col("f") >= min_count).collect():  # VOCABULARY rows at most
        by_lang.setdefault(r["lang"], []).append((-r["f"], r["phrase"].encode()))
    table, first = [], 1
    for lang in sorted(by_lang):
        table.append((lang, [w for _, w in sorted(by_lang[lang])], first))
        first += len(by_lang[lang])
    shipped = spark.sparkContext.broadcast(table)
    both = F.expr("CASE WHEN next > 0 THEN array(struct(next, c), struct(0 AS next, c)) ELSE array(struct(next, c)) END")
    at_node = _numbered_windows(texts, shipped).repartition("node").select("node", F.inline(both)).groupBy("node", "next").agg(F.sum("c").alias("f"))
    # the node of the first two words alone holds the pair's flow
    word, pair = (1 << WORD_BITS) - 1, f"shiftleft(shiftright(node, {WORD_BITS}), {WORD_BITS})"
    whole = f"""CASE WHEN next > 0 OR node & {word}L = 0 THEN array(struct(node, next, f))
                     WHEN f >= {min_count} THEN array(struct(node, next, f), struct({pair} AS node, next, f))
                     ELSE array(struct({pair} AS node, next, f)) END"""
    flows = at_node.where(f"next = 0 OR f >= {min_count}").select(F.inline(F.expr(whole))).groupBy("node", "next").agg(F.sum("f").alias("f")).where(f"f >= {min_count}")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        langs = [lang for lang, some, _ in shipped.value for _ in some]
        names = pa.array([b"", *(w for _, some, _ in shipped.value for w in some)], pa.binary()).cast(pa.string())
        for b in batches:
            node, last = b.column(0).to_numpy(), b.column(1).to_numpy()
            at = [node >> 2 * WORD_BITS, (node >> WORD_BITS) & word, node & word, last.astype(np.int64)]
            phrase = pc.binary_join_element_wise(*(names.take(pa.array(a, mask=a == 0)) for a in at), " ", null_handling="skip")
            k = sum((a != 0).astype(np.int32) for a in at)
            yield pa.RecordBatch.from_arrays([pa.array([langs[i - 1] for i in at[0].tolist()], pa.string()), phrase, pa.array(k, pa.int32()), b.column(2)], names=["lang", "phrase", "k", "f"])

    return flows.mapInArrow(run, "lang string, phrase string, k int, f long")


def _words(gram: str) -> str:
    return f"(length({gram}) - length(replace({gram}, ' ', '')) + 1)"


def _flows(rows: DataFrame, level: int, min_count: int) -> DataFrame:
    """One step down: from rows (lang, gram, f, done) whose undone grams have up
    to ``level`` words and are whole counts at ``level``, to whole counts of
    their first ``level`` - 1 words. Heavy grams are kept as done."""
    whole = f"NOT done AND {_words('gram')} = {level}"
    shorter = f"substring_index(gram, ' ', {level - 1})"
    step = rows.select(
        "lang",
        F.explode(
            F.expr(
                f"""CASE WHEN {whole} AND f >= {min_count} THEN array(struct(gram, f, true AS done), struct({shorter} AS gram, f, false AS done))
                         WHEN {whole} THEN array(struct({shorter} AS gram, f, false AS done))
                         ELSE array(struct(gram, f, done)) END"""
            )
        ).alias("s"),
    ).select("lang", "s.gram", "s.f", "s.done")
    return step.groupBy("lang", "gram", "done").agg(F.sum("f").alias("f"))


def _count_by_text(texts: DataFrame, min_count: int) -> DataFrame:
    """lang, phrase, k, f: all words, and longer phrases of min_count and more."""
    node = f"substring_index(gram, ' ', {LONGEST - 1})"
    windows = _windows(texts).withColumn("bucket", F.expr(f"pmod(xxhash64(lang, {node}), {1 << 20})").cast("int"))
    # dealt by node: the weights of a node's edges and its flow need no other shuffle
    both = f"CASE WHEN {_words('gram')} = {LONGEST} THEN array(struct(gram, true AS edge), struct({node} AS gram, false AS edge)) ELSE array(struct(gram, false AS edge)) END"
    at_node = windows.repartition("bucket").select("bucket", "lang", F.inline(F.expr(both)), "c")
    flows = at_node.groupBy("bucket", "lang", "gram", "edge").agg(F.sum("c").alias("f"))
    rows = flows.where(f"NOT edge OR f >= {min_count}").select("lang", "gram", "f", F.col("edge").alias("done"))
    for level in range(LONGEST - 1, 1, -1):
        rows = _flows(rows, level, min_count)
    return rows.select("lang", F.col("gram").alias("phrase"), F.expr(_words("gram")).cast("int").alias("k"), "f")


def count_phrases(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, vocabulary: int = VOCABULARY) -> DataFrame:
    """lang, phrase, k, f: all words, and phrases of up to LONGEST words with
    f >= min_count.

    Words are counted first. Those that reach ``min_count``, the only ones such
    a phrase can hold, are numbered and sent to the tasks if they are
    ``vocabulary`` at most; beyond that windows carry their words."""
    texts = _texts(df, text_col, lang_col)
    words = materialize(_word_counts(texts), "words")
    n_heavy = words.where(F.col("f") >= min_count).count()
    if n_heavy > vocabulary:
        return _count_by_text(texts, min_count)
    longer = _count_by_number(texts, words, min_count)
    return words.select("lang", "phrase", F.lit(1).alias("k"), "f").unionByName(longer)


def compact(counts: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """lang, words, f: the paths of the graph of heavy nodes and edges that
    remain when unary edges are merged; a node on no unary edge is a path alone."""
    edges, nodes = counts.where(f"k = {LONGEST}"), counts.where(f"k = {LONGEST - 1} AND f >= {min_count}").select("lang", "phrase", "f")
    head, tail = F.expr(f"substring_index(phrase, ' ', {LONGEST - 1})"), F.expr(f"substring_index(phrase, ' ', -{LONGEST - 1})")
    ends = edges.select("lang", "f", head.alias("head"), tail.alias("tail"))
    flow = nodes.select("lang", "f", "phrase")
    unary = ends.join(flow.withColumnRenamed("phrase", "head"), ["lang", "f", "head"]).join(flow.withColumnRenamed("phrase", "tail"), ["lang", "f", "tail"])
    start = nodes.join(unary.select("lang", F.col("tail").alias("phrase"), F.col("head").alias("before")), ["lang", "phrase"], "left")
    at = materialize(start.select("lang", "phrase", "f", F.coalesce("before", "phrase").alias("before"), F.col("before").isNotNull().cast("int").alias("steps")), "paths")
    while True:
        there = at.where("steps > 0").select("lang", F.col("phrase").alias("before"), F.col("before").alias("_b"), F.col("steps").alias("_s"))
        moved = at.join(there, ["lang", "before"], "left")
        moved = moved.select("lang", "phrase", "f", F.coalesce("_b", "before").alias("before"), (F.col("steps") + F.coalesce("_s", F.lit(0))).alias("steps"), F.col("_b").isNotNull().alias("_moved"))
        moved = materialize(moved, "paths")
        at = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            break
    parts = at.groupBy("lang", F.col("before").alias("first")).agg(F.first("f").alias("f"), F.sort_array(F.collect_list(F.struct("steps", F.element_at(F.split("phrase", " "), -1).alias("word")))).alias("s"))
    return parts.select("lang", F.concat(F.split("first", " "), F.expr("transform(slice(s, 2, greatest(size(s) - 1, 0)), x -> x.word)")).alias("words"), "f")


def _candidates(counts: DataFrame, paths: DataFrame, min_count: int) -> DataFrame:
    """Phrases of two words and more that no longer candidate covers: lang, phrase, k, a."""
    heavy = counts.where(f"k > 1 AND f >= {min_count}").select("lang", "phrase", "k", F.col("f").alias("a"))
    def within(size: int) -> DataFrame:
        """Phrases of ``size`` words inside paths, one row a phrase and path."""
        spread = F.expr(f"array_distinct(transform(sequence(1, size(words) - {size - 1}), i -> concat_ws(' ', slice(words, i, {size}))))")
        return paths.where(f"size(words) >= {size}").select("lang", "f", F.explode(spread).alias("phrase"))

    pairs = within(2)  # a node covers its pairs, and no edge weighs more than its nodes
    long_paths = paths.where(f"size(words) >= {LONGEST}")  # unary edges cover their nodes
    spread = F.expr(f"transform(sequence(1, size(words) - {LONGEST - 2}), i -> concat_ws(' ', slice(words, i, {LONGEST - 1})))")
    inner = long_paths.select("lang", "f", F.explode(spread).alias("phrase"))
    branching = heavy.where(f"k = {LONGEST}").join(within(LONGEST).select("lang", "phrase"), ["lang", "phrase"], "left_anti")
    ends = F.array_distinct(F.array(*(F.expr(f"substring_index(phrase, ' ', {way}{LONGEST - 1})") for way in ("", "-"))))
    nodes = branching.select("lang", F.col("a").alias("f"), F.explode(ends).alias("phrase"))
    cover = pairs.unionByName(inner).unionByName(nodes).groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    return heavy.join(cover, ["lang", "phrase"], "left").where(f"cover IS NULL OR 100 * cover < {COVER_PERCENT} * a").drop("cover")


def _scored(candidates: DataFrame, counts: DataFrame, min_count: int) -> DataFrame:
    """Candidates with l, r and score of their weakest cut."""
    parts = F.expr("flatten(transform(sequence(1, k - 1), i -> array(struct(i AS cut, true AS first, substring_index(phrase, ' ', i) AS part), struct(i AS cut, false AS first, substring_index(phrase, ' ', i - k) AS part))))")
    asked = candidates.withColumn("s", F.explode(parts)).select("lang", "phrase", "a", "s.cut", "s.first", "s.part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    told = counts.where(f"f >= {min_count} AND k < {LONGEST}").select("lang", F.col("phrase").alias("part"), "f", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")).alias("salt"))
    cuts = asked.join(told, ["lang", "part", "salt"]).groupBy("lang", "phrase", "a", "cut").agg(F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    score = F.expr(f"(cast(a AS decimal(20)) * {SCALE}) div (cast(l AS decimal(20)) + r)")
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s"))
    return weakest.select("lang", "phrase", "a", "s.l", "s.r", "s.score")


def mine(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int = TOP) -> Mined:
    """Count, compact and score: see :class:`Mined`."""
    counts = materialize(count_phrases(df, text_col, lang_col, min_count), "phrases")
    paths = materialize(compact(counts, min_count), "paths")
    scored = _scored(_candidates(counts, paths, min_count), counts, min_count)
    total = counts.where("k = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    out = best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    return Mined(counts, paths.select("lang", F.concat_ws(" ", "words").alias("phrase"), F.size("words").alias("n_words"), "f"), out)


SQL = f"""
WITH p AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
o AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(list_slice(ws, i, i + k - 1), ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS k) WHERE len(ws) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM o GROUP BY ALL HAVING k = 1 OR count(*) >= {MIN_COUNT}),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= {MIN_COUNT}),
inside AS (
  SELECT lang, f, unnest(list_transform(range(1, k - s + 2), lambda i: array_to_string(list_slice(ws, i, i + s - 1), ' '))) AS phrase
  FROM c, (SELECT unnest(range(2, {LONGEST})) AS s) WHERE s < k),
cover AS (SELECT lang, phrase, max(f) AS most FROM inside GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN cover USING (lang, phrase) WHERE most IS NULL OR 100 * most < {COVER_PERCENT} * f),
halves AS (
  SELECT lang, phrase, f AS a, cut, array_to_string(list_slice(ws, 1, cut), ' ') AS p1, array_to_string(list_slice(ws, cut + 1, k), ' ') AS p2
  FROM kept, (SELECT unnest(range(1, {LONGEST})) AS cut) WHERE cut < k),
cuts AS (
  SELECT h.lang, h.phrase, a, cut, l.f AS l, r.f AS r, (a::HUGEINT * {SCALE} // (l.f + r.f))::BIGINT AS score
  FROM halves h JOIN f l ON l.lang = h.lang AND l.phrase = p1 JOIN f r ON r.lang = h.lang AND r.phrase = p2),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
