r"""Substring dedup by super-k-mer partitioning (operator 3).

A window is ``WINDOW`` words.  Consecutive windows that share a minimiser (an anchor of ``GRAM`` words)
travel as one packed string to the bucket of the minimiser, where each group's windows are sorted and runs
of equal windows give the smallest document that holds them.  Strings whose minimiser stays in one
document cannot hold a shared window and do not travel.

Defined cases: null, empty and short texts lose nothing; documents without doc_id lose nothing and take
nothing from others; rows that repeat a doc_id are rows of one document number: they take nothing from each
other, whatever their texts, and each loses what smaller numbers hold; very long texts are scanned in pieces;
an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from . import repeats

WINDOW, GRAM = 50, 12
#: Records of one minimiser that one task may sort; the windows of larger groups are counted by digest.
HOT = 20_000
SPANS = "key long, s long, e long"
PACKED = "bucket int, h long, key long, doc_id long, start long, n int, back int, packed binary"


def _packer(window: int):
    def pack(blob: bytes):
        words = blob.split()
        return lambda start, n: b" ".join(words[start : start + n + window - 1])

    return pack


def _windows(window: int):
    def windows(packed: bytes) -> list[bytes]:
        words = packed.split()
        return [b" ".join(words[j : j + window]) for j in range(len(words) - window + 1)]

    return windows


def _pack(window: int, buckets: int):
    def run(batches):
        for batch in batches:
            rows = []
            size = 0
            for key, doc, text, recs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.encode().split()
                for r in recs:
                    packed = b" ".join(words[r["start"] : r["start"] + r["n"] + window - 1])
                    rows.append((r["h"] % buckets, r["h"], key, doc, r["start"], r["n"], r["back"], packed))
                    size += len(packed)
                if size > 8_000_000:
                    yield _batch(rows)
                    rows, size = [], 0
            yield _batch(rows)

    return run


def _batch(rows):
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "h", "key", "doc_id", "start", "n", "back", "packed"])


def shared_windows(rows: list[tuple], window: int):
    """(key, first word, end word) of the repeated windows of one minimiser's (key, doc, start, n, back, packed) rows.

    Equal windows have the minimiser at the same place, so each place is sorted on its own; equal strings
    are one entry, and what is held at a time is one window of each entry."""
    first: dict[bytes, list[int]] = {}
    for _, doc, _, n, back, packed in rows:
        held = first.setdefault(packed, [doc, n, back])
        held[0] = min(doc, held[0])
    lowest: dict[bytes, list[int]] = {}
    if len(first) > 1:
        edges = {}
        for packed, (doc, n, _) in first.items():
            edges[packed] = [-1, *(i for i, c in enumerate(packed) if c == 32), len(packed)]
            lowest[packed] = [doc] * n
        for place in range(min(back - n + 1 for _, n, back in first.values()), max(back for _, _, back in first.values()) + 1):
            seen = []
            for packed, (doc, n, back) in first.items():
                j = back - place
                if 0 <= j < n:
                    e = edges[packed]
                    seen.append((packed[e[j] + 1 : e[j + window]], doc, packed, j))
            seen.sort(key=lambda x: x[:2])  # equal windows meet, the smallest document first
            last, low = None, -1
            for w, doc, packed, j in seen:
                if w != last:
                    last, low = w, doc
                lowest[packed][j] = low
    for key, doc, start, n, _, packed in rows:
        low = lowest.get(packed)
        if low is None:
            if first[packed][0] < doc:
                yield key, start, start + n + window - 1
            continue
        j = 0
        while j < n:
            if low[j] < doc:
                i = j
                while j < n and low[j] < doc:
                    j += 1
                yield key, start + i, start + j + window - 1
            j += 1


def _bucket(window: int):
    """Rows come sorted by minimiser; each group is bounded, and only one is held."""

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)

        out: list[tuple] = []
        for _, group in groupby(rows(), key=lambda r: r[0]):
            held = [r[1:] for r in group]
            if len(held) > 1:
                out += shared_windows(held, window)
            if len(out) > 20_000:
                yield _spans(out)
                out = []
        yield _spans(out)

    return run


def _spans(out):
    columns = list(zip(*out, strict=True)) if out else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "s", "e"])


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, s, e) word spans of ``keyed`` texts covered by windows that start in a document with a smaller doc_id; may overlap."""
    found, buckets = repeats.repeated(docs, repeats.word_units, window, gram, across=True, hot=HOT)
    cold = repeats.with_texts(docs, found.where("not hot"))
    packed = cold.mapInArrow(_pack(window, buckets), PACKED)
    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("h")
    spans = dealt.mapInArrow(_bucket(window), SPANS)
    if found.where("hot").limit(1).count():
        hot = repeats.with_texts(docs, found.where("hot"))
        spans = spans.unionByName(repeats.windows_by_digest(hot, _packer(window), _windows(window), window, True))
    return spans


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, kept (words joined by one space), n_words, n_removed and kept_sha256 of every document."""

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, ss, es in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.encode().split()
                n, gone, at, kept = len(words), 0, 0, []
                for s, e in repeats.merged(ss or [], es or []):
                    kept += words[at:s]
                    gone, at = gone + e - s, e
                kept += words[at:]
                joined = b" ".join(kept)
                out.append((doc, joined.decode(), n, gone, hashlib.sha256(joined).hexdigest()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "kept", "n_words", "n_removed", "kept_sha256"])

    texts = repeats.keyed(docs)
    return repeats.with_spans(texts, repeated_spans(texts, window, gram)).mapInArrow(run, "doc_id long, kept string, n_words long, n_removed long, kept_sha256 string")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir)).select("doc_id", F.col("n_words"), "n_removed", "kept_sha256")
