"""Packing of token sequences by bounded-space online best-fit (operator 7).

Each task streams its documents into a fixed number of open bins.  A bitset keyed by free space finds the
fullest bin that still takes a piece; when a bin more than allowed is open, the fullest is closed.  Bins
still open when a task's input ends hold at most ``OPEN`` bins' worth a task; those alone are packed
again, by fewer tasks, so that part-filled bins do not pile up with the number of tasks.

Defined cases: a null or empty text is the end token alone; texts above the capacity are cut into full
pieces and a rest; repeated rows are packed as often as they occur; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

import zlib

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import documents, slabs, stash, text_or_empty

CAPACITY, END_ID, OPEN = 4096, 1, 256
#: Leftovers of so many tasks are packed again by one.
TOGETHER = 64
FIELDS = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, left boolean"
VOCABULARY = "word_bpe_49k.json"
#: Characters of texts that are encoded together; the more, the fewer times a word is looked up.
SLAB = 16_000_000


class OpenBins:
    """Open bins by free space: bit f of ``bits`` is set while a bin with f free places is open."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.bits, self.n = capacity, most, 0, 0
        self.by_free: dict[int, list[list]] = {}

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.n -= 1
        return found

    def put(self, length: int, row: tuple) -> list[list]:
        """Place a piece; the bins that this closes, each a list of (offset, row)."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            held = self._take(free)
        else:
            free, held = self.capacity, []
        held.append((self.capacity - free, row))
        free -= length
        if free == 0:
            return [held]
        self.by_free.setdefault(free, []).append(held)
        self.bits |= 1 << free
        self.n += 1
        if self.n > self.most:
            return [self._take((self.bits & -self.bits).bit_length() - 1)]
        return []

    def rest(self) -> list[list]:
        return [b for bins in self.by_free.values() for b in bins]


def _emit(bins: list[list], first: int, left: bool):
    rows = [(*row, first + i, offset, left) for i, b in enumerate(bins) for offset, row in b]
    names = [x.split()[0] for x in FIELDS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _fill(rows, capacity: int, most: int, base: int, final: bool):
    """Arrow batches of packed pieces from (length, row) pairs."""
    bins, closed, n = OpenBins(capacity, most), [], 0
    for length, row in rows:
        closed += bins.put(length, row)
        if len(closed) >= 2000:
            yield _emit(closed, base + n, False)
            n, closed = n + len(closed), []
    yield _emit(closed, base + n, False)
    yield _emit(bins.rest(), base + n + len(closed), not final)


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    path = path or public_tokenizers.path(VOCABULARY)
    end = END_ID.to_bytes(4, "little")

    def first(batches):
        codec = bpe.word_codec(path)

        def pieces():
            for batch in batches:
                keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for a, b in slabs(texts, SLAB):
                    for key, ids in zip(keys[a:b], codec.encode(texts[a:b]), strict=True):
                        ids += end
                        for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                            part = ids[at : at + 4 * capacity]
                            yield len(part) // 4, (key, i, at // 4, len(part) // 4, zlib.crc32(part))

        yield from _fill(pieces(), capacity, OPEN, TaskContext.get().partitionId() << 36, False)

    def again(batches):
        def pieces():
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield row[3], row

        yield from _fill(pieces(), capacity, 16 * OPEN, 1 << 62 | TaskContext.get().partitionId() << 36, True)

    docs = docs.select("doc_id", text_or_empty().alias("text"))
    tasks = docs.rdd.getNumPartitions()
    packed = stash(docs.mapInArrow(first, FIELDS), "packed")
    row = ["doc_id", "piece", "start", "length", "ids_crc32"]
    left = packed.where("left").select(*row)
    few = max(1, tasks // TOGETHER)
    # long pieces first: short ones then fill the gaps
    left = left.repartition(few, F.xxhash64("doc_id", "piece")).sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    return packed.where("not left").drop("left").unionByName(left.mapInArrow(again, FIELDS).drop("left"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
