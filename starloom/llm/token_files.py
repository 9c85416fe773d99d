"""Token-id files: seekable, checked, compressed.

A file holds the ids of many documents, one after another in ascending order of
document id, as little-endian unsigned integers. It follows the published
seekable format of zstandard:

* independent zstandard frames of about ``FRAME_IDS`` ids each. A frame ends
  behind a document; a document with more ids than that is cut into frames of
  its own;
* a skippable frame with the index: id and number of ids of every document;
* a skippable frame with the seek table, last: compressed size, plain size and
  checksum (low half of XXH64 of the plain bytes) of every frame, then their
  number, a flag byte and the magic number.

Any zstandard tool decompresses such a file to the plain ids. A reader that
wants some documents reads the last bytes, the table, the index, and then only
the frames that hold those documents; every frame is checked when it is read.

:func:`write` range-partitions the texts by document id, so each task holds a
contiguous run of ids and writes it as a sequence of files of about
``FILE_IDS`` ids, streaming: a task holds one frame, one file's index and one
slice of texts. What a task wrote counts only if its rows reach the list of
files, a Parquet table that Spark commits last; files of lost or repeated
attempts have other names, are never listed, and are removed at the end.
Positions over all documents are prefix sums: per task on the driver (a row a
task), per file inside the task's own rows.

Defined results: a null text is an empty one; a null document id comes first;
rows with equal ids keep all their documents, in the order of their texts'
hashes; an empty table gives a list of no files and reads back as no rows;
other columns of the input are not read, whatever they are called.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import Remembered, slices

FRAME_IDS = 1 << 16
FILE_IDS = 1 << 25
LEVEL = 3
TEXT_SLICE = 1 << 20  # text bytes encoded at once, a longer single text aside
MEMORY = 300_000  # parts of text whose ids a worker remembers, and as many older ones
LONG_PART = 64  # characters; longer parts are encoded anew each time
READ_IDS = 1 << 20  # ids in one Arrow batch of a reader, a longer single document aside

# fixed values of byte-level pre-tokenization, for letters, numbers and white space whose classes never change
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBERS = "0-9²³¹¼-¾"
PLAIN = re.compile("[\t-\r -~¡-¬®-ɏ]*")
PARTS = re.compile(f"'(?:[sdmt]|ll|ve|re)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\\s{_LETTERS}{_NUMBERS}]+|\\s+(?!\\S)|\\s+", re.ASCII)

# fixed values of the zstandard seekable format
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

INDEX_MAGIC = b"SLTI"
LIST = "_files"
FILES_SCHEMA = "pid int, seq int, name string, n_docs long, n_ids long, least long, most long, has_null boolean"


class CorruptFile(ValueError):
    """A file is cut short, or a frame doesn't match its checksum."""


def _checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def _file_system(root: str):
    """(file system, path in it) of a folder named by path or URI."""
    from pyarrow import fs

    if "://" in root or root.startswith("file:"):
        if root.startswith("file:") and not root.startswith("file://"):
            root = "file://" + root[5:]
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


class FileWriter:
    """Writes one file to an open binary stream."""

    def __init__(self, sink, width: int = 4, frame_ids: int = FRAME_IDS, level: int = LEVEL) -> None:
        import zstandard

        self.sink, self.width, self.frame_ids = sink, width, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.table: list[tuple[int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.n_held and self.n_held + len(ids) > self.frame_ids:
            self._frame()
        for at in range(0, len(ids), self.frame_ids):
            part = ids[at : at + self.frame_ids]
            self.held.append(part)
            self.n_held += len(part)
            if self.n_held >= self.frame_ids:
                self._frame()
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)

    def _frame(self) -> None:
        plain = np.concatenate(self.held).astype(f"<u{self.width}").tobytes()
        packed = self.zstd.compress(plain)
        self.sink.write(packed)
        self.table.append((len(packed), len(plain), _checksum(plain)))
        self.held, self.n_held = [], 0

    def close(self) -> None:
        if self.n_held:
            self._frame()
        null = np.array([d is None for d in self.doc_ids], np.uint8)
        docs = np.array([d or 0 for d in self.doc_ids], "<i8")
        body = null.tobytes() + docs.tobytes() + np.array(self.lengths, "<i8").tobytes()
        packed = self.zstd.compress(body)
        index = INDEX_MAGIC + struct.pack("<BQI", self.width, len(docs), _checksum(body)) + packed
        index = struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index
        self.sink.write(index)
        self.table.append((len(index), 0, _checksum(b"")))
        table = b"".join(struct.pack("<III", *entry) for entry in self.table)
        table += struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_TABLE, len(table)) + table)


class FileReader:
    """Reads documents of one file; ``frames_read`` counts what was decompressed."""

    def __init__(self, source, size: int) -> None:
        import zstandard

        self.source = source
        self.zstd = zstandard.ZstdDecompressor()
        self.frames_read = 0
        self._at, self._plain = -1, b""
        if size < 17:
            raise CorruptFile("no seek table")
        n, flags, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG or 12 * n + 17 > size or not n:
            raise CorruptFile("no seek table with checksums at the end")
        table = self._bytes(size - 17 - 12 * n, 12 * n + 8)
        if struct.unpack("<II", table[:8]) != (SKIPPABLE_TABLE, 12 * n + 9):
            raise CorruptFile("the seek table's frame header doesn't fit")
        entries = np.frombuffer(table[8:], "<u4").reshape(n, 3).astype(np.int64)
        starts = np.concatenate(([0], np.cumsum(entries[:, 0])))
        if starts[-1] != size - 17 - 12 * n:
            raise CorruptFile("the frames' sizes don't add up to the file's")
        if (entries[-1, 1:] != (0, _checksum(b""))).any():
            raise CorruptFile("the last entry isn't the index's")
        self.packed, self.sums = starts[:n], entries[: n - 1, 2]
        self.packed_size = entries[:, 0]
        index = self._bytes(int(starts[n - 1]), int(entries[n - 1, 0]))
        if struct.unpack("<I", index[:4])[0] != SKIPPABLE_INDEX or index[8:12] != INDEX_MAGIC:
            raise CorruptFile("no index in front of the seek table")
        self.width, docs, told = struct.unpack("<BQI", index[12:25])
        body = self._plain_of(index[25:])
        if _checksum(body) != told or len(body) != 17 * docs:
            raise CorruptFile("the index doesn't match its checksum")
        self.null = np.frombuffer(body, np.uint8, docs).astype(bool)
        self.doc_ids = np.frombuffer(body, "<i8", docs, docs)
        self.lengths = np.frombuffer(body, "<i8", docs, 9 * docs)
        self.ends = np.cumsum(self.lengths)
        self.frame_ends = np.cumsum(entries[: n - 1, 1]) // self.width

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        got = self.source.read(n)
        if len(got) != n:
            raise CorruptFile("the file ends early")
        return got

    def _plain_of(self, packed: bytes) -> bytes:
        import zstandard

        try:
            return self.zstd.decompress(packed)
        except zstandard.ZstdError as e:
            raise CorruptFile(str(e)) from e

    def _frame(self, f: int) -> bytes:
        if f != self._at:
            plain = self._plain_of(self._bytes(int(self.packed[f]), int(self.packed_size[f])))
            self.frames_read += 1
            if _checksum(plain) != self.sums[f]:
                raise CorruptFile(f"frame {f} doesn't match its checksum")
            self._at, self._plain = f, plain
        return self._plain

    def raw(self, doc: int) -> bytes:
        """The bytes of the ids of the document at this place of the index."""
        end = int(self.ends[doc])
        at = end - int(self.lengths[doc])
        out = []
        while at < end:
            f = int(np.searchsorted(self.frame_ends, at, side="right"))
            first = int(self.frame_ends[f - 1]) if f else 0
            stop = min(end, int(self.frame_ends[f]))
            out.append(self._frame(f)[(at - first) * self.width : (stop - first) * self.width])
            at = stop
        return b"".join(out)

    def places(self, wanted: Sequence[int] | None) -> np.ndarray:
        """Places of the index with these document ids (None: all)."""
        if wanted is None:
            return np.arange(len(self.doc_ids))
        return np.flatnonzero(np.isin(self.doc_ids, np.asarray(wanted, np.int64)) & ~self.null)


class Encoder:
    """Ids of whole texts by the tokenizers library, each distinct part of byte-
    level pre-tokenization being given to the library's model once while it is
    remembered.

    Text of the signs in ``PLAIN`` is parted by that pre-tokenizer's rule. Other
    text is first cut in front of blanks that have no white space on either side,
    where the rule always parts it; stretches with other signs go through the
    whole tokenizer. So does every text if the definition isn't plainly
    byte-level."""

    def __init__(self, definition: bytes) -> None:
        import json
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_buffer(definition)
        self.tokenizer.encode_special_tokens = True  # a text's own "<|...|>" is ordinary text
        told = json.loads(definition)
        cut = told.get("pre_tokenizer") or {}
        self.byte_level = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True) and not told.get("normalizer")
        self.byte_level = self.byte_level and all(t.get("special") for t in told.get("added_tokens", []))
        self.parts = Remembered(self._part, MEMORY, LONG_PART)
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        others = [b for b in range(256) if b not in own]
        self.signs = {b: 256 + i for i, b in enumerate(others)}

    @staticmethod
    def stretches(text: str) -> list[str]:
        parts = text.split(" ")
        out = parts[:1]
        for part in parts[1:]:
            if part and out[-1] and not part[0].isspace() and not out[-1][-1].isspace():
                out.append(" " + part)
            else:
                out[-1] += " " + part
        return out

    def _part(self, part: str) -> bytes:
        ids = [t.id for t in self.tokenizer.model.tokenize(part.encode().decode("latin-1").translate(self.signs))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, PARTS.findall(text)))

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if not self.byte_level:
            return self._whole(text)
        if PLAIN.fullmatch(text):
            return self._plain(text)
        return b"".join(self._plain(s) if PLAIN.fullmatch(s) else self._whole(s) for s in self.stretches(text))


_ENCODERS: dict[int, Encoder] = {}


def _encoder(definition: bytes) -> Encoder:
    """The worker's encoder for a definition (built once a process)."""
    key = hash(definition)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


def write(df: DataFrame, root: str, tokenizer: bytes, end_id: int, id_col: str = "doc_id", text_col: str = "text", width: int = 4, frame_ids: int = FRAME_IDS, file_ids: int = FILE_IDS, level: int = LEVEL) -> None:
    """Encode every whole text of ``df`` and write the ids, each document's
    followed by ``end_id``, to files below ``root`` (path or URI of a fresh
    folder that driver and executors share).

    ``tokenizer``: a definition for the tokenizers library, as bytes."""
    spark = df.sparkSession
    shipped = spark.sparkContext.broadcast(tokenizer)  # a vocabulary: a few MB
    src = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keys = ["id", F.xxhash64("text")]
    files, folder = _file_system(root)
    files.create_dir(folder, recursive=True)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode = _encoder(shipped.value)
        fs, at = _file_system(root)
        pid, attempt, rows, writer, sink, name = TaskContext.get().partitionId(), uuid.uuid4().hex, [], None, None, None
        last = np.array([end_id], "<u4").tobytes()

        def close() -> None:
            writer.close()
            sink.close()
            known = [d for d in writer.doc_ids if d is not None]
            rows.append((pid, len(rows), name, len(writer.doc_ids), writer.n_ids, min(known, default=None), max(known, default=None), len(known) < len(writer.doc_ids)))

        try:
            for whole in batches:
                for b in slices(whole, "text", TEXT_SLICE):
                    for doc_id, got in zip(b.column(0).to_pylist(), map(encode, b.column(1).to_pylist())):
                        if writer is None:
                            name = f"ids-{pid:06d}-{len(rows):05d}-{attempt}.zst"
                            sink = fs.open_output_stream(f"{at}/{name}", compression=None)
                            writer = FileWriter(sink, width, frame_ids, level)
                        writer.add(doc_id, np.frombuffer(got + last, "<u4"))
                        if writer.n_ids >= file_ids:
                            close()
                            writer = None
            if writer is not None:
                close()
        except BaseException:
            if sink is not None and not sink.closed:
                sink.close()
            raise
        cols = list(zip(*rows)) if rows else [()] * 8
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        names = ["pid", "seq", "name", "n_docs", "n_ids", "least", "most", "has_null"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    dealt = src.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt.mapInArrow(run, FILES_SCHEMA).write.parquet(f"{root}/{LIST}")
    _remove_unlisted(spark, root)


def _remove_unlisted(spark: SparkSession, root: str) -> None:
    """Files of attempts whose rows were not committed."""
    from pyarrow import fs as arrow_fs

    fs, folder = _file_system(root)
    there = {i.base_name for i in fs.get_file_info(arrow_fs.FileSelector(folder)) if i.base_name.endswith(".zst")}
    if len(there) == _listed(spark, root).count():
        return
    for row in _listed(spark, root).select("name").toLocalIterator():
        there.discard(row["name"])
    for name in there:
        fs.delete_file(f"{folder}/{name}")


def _listed(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(FILES_SCHEMA).parquet(f"{root}/{LIST}")


def files(spark: SparkSession, root: str) -> DataFrame:
    """The list of files with ``start``, the number of ids in front of each."""
    listed = _listed(spark, root)
    per_task = sorted((r["pid"], r["n"]) for r in listed.groupBy("pid").agg(F.sum("n_ids").alias("n")).collect())
    before, offsets = 0, []
    for pid, n in per_task:
        offsets.append((pid, before))
        before += n
    shift = F.broadcast(spark.createDataFrame(offsets, "pid int, shift long"))  # a row a task
    earlier = F.sum("n_ids").over(Window.partitionBy("pid").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    return listed.withColumn("earlier", F.coalesce(earlier, F.lit(0))).join(shift, "pid").withColumn("start", F.col("shift") + F.col("earlier")).drop("shift", "earlier")


def read(spark: SparkSession, root: str, doc_ids: Sequence[int] | None = None, raw: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, and ``ids``:
    array<long>, or with ``raw`` their bytes as stored. ``doc_ids``: only these
    documents (a short list); files and frames without them are not read."""
    listed = files(spark, root)
    wanted = None if doc_ids is None else sorted(set(doc_ids))
    if wanted is not None:
        hit = F.lit(False)
        for d in wanted:
            hit = hit | F.col("least").isNotNull() & F.lit(d).between(F.col("least"), F.col("most"))
        listed = listed.where(hit)
    n = listed.count()
    dealt = listed.select("name", "start").repartition(max(1, min(n, 8 * spark.sparkContext.defaultParallelism)))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        fs, folder = _file_system(root)
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with fs.open_input_file(f"{folder}/{name}") as source:
                    r = FileReader(source, source.size())
                    places = r.places(wanted)
                    done = 0
                    while done < len(places):
                        sizes = np.cumsum(r.lengths[places[done:]])
                        some = places[done : done + max(1, int(np.searchsorted(sizes, READ_IDS, side="right")))]
                        done += len(some)
                        got = [r.raw(int(i)) for i in some]
                        lengths = r.lengths[some]
                        ends = np.concatenate(([0], np.cumsum(lengths)))
                        if raw:
                            ids = pa.array(got, pa.binary())
                        else:
                            plain = np.frombuffer(b"".join(got), f"<u{r.width}").astype(np.int64)
                            ids = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(plain)).cast(pa.list_(pa.int64()))
                        cols = [pa.array(r.doc_ids[some], pa.int64(), mask=r.null[some]), pa.array(start + r.ends[some] - lengths), pa.array(lengths.astype(np.int64)), ids]
                        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids"])

    return dealt.mapInArrow(run, f"doc_id long, start long, n_tokens long, ids {'binary' if raw else 'array<long>'}")


def digests(df: DataFrame, root: str, tokenizer: bytes, end_id: int) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what was written, read back from the files."""
    write(df, root, tokenizer, end_id)
    got = read(df.sparkSession, root, raw=True)
    return got.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
