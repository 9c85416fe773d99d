"""Document fingerprints: SimHash with permuted block tables.

Terms are the three-word shingles of the lower-cased text (fewer words: the
whole sequence), weighted by 1 + ln(count). Each term's 128-bit hash votes
with its weight, for a bit that is set and against one that isn't; a bit of
the fingerprint is set where the votes are above zero. Bits of two
fingerprints agree as often as their weighted terms point the same way, so
the likeness of two texts is estimated as max(0, cos(pi * differing / 128)).

Search within a Hamming radius r: the 128 bits are cut into r + 1 blocks. Two
fingerprints that differ in at most r bits agree in at least one block; there
is one table per block, permuted so that its block leads, and equal leading
blocks bring candidates together, whose distance is then verified. Equal
fingerprints are one entry, whatever their number of documents. Entries with
the same leading block are compared in squares of ``RUN_BLOCK`` entries, so
several tasks share a long run; a pair counts in the first table that holds
it; only sums per entry leave a task, never pairs.

The next document is found with one shuffle of the texts: rows are sorted in
ranges of descending ids and read as a stream; what follows the last row of a
range - the first of the next one - is matched up afterwards, one row a range.

Defined results: null and empty texts have no terms, fingerprint zero, and
likeness 1 to each other; equal texts have equal fingerprints; documents with
equal ids follow each other in the order of their texts' hashes; null ids come
last; a single document is its own next one; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize, slices

BITS = 128
SHINGLE = 3
RUN_BLOCK = 1024


def term_hashes(raw: bytes) -> np.ndarray:
    """(terms with repeats, 16) bytes: hashes of a UTF-8 text's shingles."""
    import xxhash

    words = raw.lower().split()
    if not words:
        return np.zeros((0, 16), np.uint8)
    h, join = xxhash.xxh3_128_digest, b" ".join
    if len(words) <= SHINGLE:
        return np.frombuffer(h(join(words)), np.uint8).reshape(1, 16)
    return np.frombuffer(b"".join([h(join(s)) for s in zip(*(words[i:] for i in range(SHINGLE)))]), np.uint8).reshape(-1, 16)


def vote(hashes: np.ndarray) -> int:
    """Fingerprint of the terms with these hashes."""
    if not len(hashes):
        return 0
    keys, first, counts = np.unique(hashes[:, :8].copy().view("<u8").ravel(), return_index=True, return_counts=True)
    weights = (1 + np.log(counts)).astype(np.float64)
    votes = np.zeros(BITS)
    for at in range(0, len(keys), 32768):
        part = slice(at, at + 32768)
        bits = np.unpackbits(hashes[first[part]], axis=1)
        for w in np.unique(weights[part]):  # few different counts: integer sums, so no order of addition shows
            own = bits[weights[part] == w]
            votes += w * (2.0 * own.sum(axis=0, dtype=np.int64) - len(own))
    return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def fingerprint(text: str | None) -> int:
    return vote(term_hashes((text or "").encode("utf-8", "replace")))


def likeness(a: int, b: int) -> float:
    """0 (nothing in common) to 1 (equal fingerprints)."""
    return max(0.0, float(np.cos(np.pi * (a ^ b).bit_count() / BITS))) if a != b else 1.0


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many code points of the next one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def edited_fingerprint(text: str, hashes: np.ndarray, following: str) -> tuple[int, bytes]:
    """(fingerprint, UTF-8) of the edited text; the shingles of the part that
    stays are not hashed again."""
    new = edited(text, following).encode("utf-8", "replace")
    n = len(text) // 3
    whole = len(text[: len(text) - n].encode("utf-8", "replace").lower().split()) - 1  # the last word may go on
    same = hashes[: max(0, whole - SHINGLE + 1)]
    if not len(same):
        return vote(term_hashes(new)), new
    # shingles from word number len(same) on: those that reach into the seam or beyond
    words = new.lower().split()
    rest = term_hashes(b" ".join(words[len(same) :])) if len(words) - len(same) >= SHINGLE else np.zeros((0, 16), np.uint8)
    return vote(np.concatenate([same, rest])), new


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


class _Rows:
    """Results gathered into Arrow batches."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, text: str, hashes: np.ndarray, fp: int, following: str, following_fp: int) -> None:
        new_fp, new = edited_fingerprint(text, hashes, following)
        self.rows.append((doc_id, len(text), hashlib.sha256(new).hexdigest(), f"{fp:032x}", f"{new_fp:032x}", likeness(fp, new_fp), likeness(fp, following_fp), None, None, None))

    def batch(self):
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "_range", "_first", "_last"]
        columns = zip(*self.rows) if self.rows else [[]] * len(kinds)
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        self.rows = []
        return out


def _stream(batches: Iterator) -> Iterator:
    """Sorted rows (doc_id, text) of one range -> a result for every row but
    the last, and one row with the range's first and last text."""
    from pyspark import TaskContext

    out, before, first = _Rows(), None, None
    for whole in batches:
        for b in slices(whole, "text"):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = text or ""
                hashes = term_hashes(text.encode("utf-8", "replace"))
                fp = vote(hashes)
                if before is None:
                    first = text
                else:
                    out.add(*before, text, fp)
                before = (doc_id, text, hashes, fp)
            yield out.batch()
    if before is not None:
        out.rows.append((before[0], *[None] * 6, TaskContext.get().partitionId(), first, before[1]))
        yield out.batch()


def _ends(batches: Iterator) -> Iterator:
    """(doc_id, last text of a range, first text of the next) -> results."""
    out = _Rows()
    for b in batches:
        for doc_id, text, following in zip(*(b.column(i).to_pylist() for i in range(3))):
            hashes = term_hashes(text.encode("utf-8", "replace"))
            out.add(doc_id, text, hashes, vote(hashes), following, fingerprint(following))
            yield out.batch()


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next of every row."""
    docs = documents.select("doc_id", "text")
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    extra = ", _range int, _first string, _last string"
    rows = materialize(ranged.mapInArrow(_stream, RESULT + extra), "fingerprints")
    ends = rows.where("_range is not null").select("_range", "doc_id", "_first", "_last")
    numbers = sorted(r["_range"] for r in ends.select("_range").collect())  # one number per range
    after = dict(zip(numbers, numbers[1:] + numbers[:1]))
    if not after:
        return rows.select(*[c.split()[0] for c in RESULT.split(", ")])
    following = docs.sparkSession.createDataFrame(list(after.items()), "_range int, _after int")
    firsts = ends.select(F.col("_range").alias("_after"), F.col("_first").alias("_following"))
    pairs = ends.join(following, "_range").join(firsts, "_after").select("doc_id", "_last", "_following")
    last = pairs.mapInArrow(_ends, RESULT + extra)
    names = [c.split()[0] for c in RESULT.split(", ")]
    return rows.where("_range is null").select(*names).unionByName(last.select(*names))


def near_counts(fps: DataFrame, radius: int = 3, col: str = "fingerprint") -> DataFrame:
    """Different values of ``col`` (hex digits) -> ``n_equal`` rows that have
    the value and ``n_near`` rows whose fingerprint lies within ``radius``
    bits of it, themselves included."""
    if not 0 <= radius <= 15:
        raise ValueError("radius must be from 0 to 15")
    tables = radius + 1
    cuts = [BITS // 4 * t // tables for t in range(tables + 1)]  # in hex digits
    entries = materialize(fps.groupBy(F.col(col).alias("fp")).agg(F.count(F.lit(1)).alias("n")), "fingerprints")
    leads = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").substr(cuts[t] + 1, cuts[t + 1] - cuts[t]).alias("lead")) for t in range(tables)])
    permuted = entries.select("fp", "n", F.explode(leads).alias("k")).select("fp", "n", "k.t", "k.lead")
    runs = permuted.groupBy("t", "lead").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    own = F.pmod(F.xxhash64("fp"), F.col("squares")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("squares") - 1), lambda o: F.struct(F.least(o, own).alias("a"), F.greatest(o, own).alias("b"), own.alias("own")))
    dealt = permuted.join(runs, ["t", "lead"]).withColumn("squares", F.ceil(F.col("size") / RUN_BLOCK).cast("int")).select("t", "lead", "fp", "n", F.explode(others).alias("s"))
    squares = dealt.groupBy("t", "lead", "s.a", "s.b").agg(F.collect_list(F.struct("fp", "n", F.col("s.own").alias("own"))).alias("entries")).where(F.size("entries") > 1).select("t", "a", "b", "entries")
    bounds = [c * 4 for c in cuts]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                t, a, b = (batch.column(c)[i].as_py() for c in range(3))
                listed = batch.column(3)[i].values
                hexed = listed.field(0).to_pylist()
                n = listed.field(1).to_numpy(zero_copy_only=False)
                place = listed.field(2).to_numpy(zero_copy_only=False)
                bits = np.frombuffer(bytes.fromhex("".join(hexed)), ">u8").reshape(-1, 2)
                left = np.flatnonzero(place == a)
                right = np.flatnonzero(place == b)
                near = np.zeros(len(hexed), np.int64)
                for at in range(0, len(left), 256):
                    some = left[at : at + 256]
                    x = bits[some][:, None, :] ^ bits[right][None, :, :]
                    close = np.bitwise_count(x).sum(axis=2) <= radius
                    close &= some[:, None] < right[None, :] if a == b else True
                    for u, v in zip(*np.nonzero(close)):
                        gap = int(x[u, v, 0]) << 64 | int(x[u, v, 1])
                        agree = next(k for k in range(tables) if not gap >> (BITS - bounds[k + 1]) & ((1 << bounds[k + 1] - bounds[k]) - 1))
                        if agree == t:
                            near[some[u]] += n[right[v]]
                            near[right[v]] += n[some[u]]
                hit = np.flatnonzero(near)
                if len(hit):
                    yield pa.RecordBatch.from_arrays([pa.array([hexed[h] for h in hit], pa.string()), pa.array(near[hit], pa.int64())], names=["fp", "more"])

    more = squares.mapInArrow(run, "fp string, more long").groupBy("fp").agg(F.sum("more").alias("more"))
    return entries.join(more, "fp", "left").select(F.col("fp").alias(col), F.col("n").alias("n_equal"), (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_near"))


def digests(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and its edited text, with ``n_near``:
    documents whose fingerprint lies within three bits, itself included."""
    rows = materialize(fingerprints(documents), "fingerprints")
    near = materialize(near_counts(rows).select("fingerprint", "n_near"), "fingerprints")
    return rows.join(near, "fingerprint").select(*[c.split()[0] for c in RESULT.split(", ")], "n_near")
