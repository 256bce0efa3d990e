"""Repeated windows of byte or word sequences: minimiser anchors, candidate selection, span bookkeeping.

Both repeat operators look for windows of fixed length that occur in more than one place.  A window's
anchor is the leftmost smallest hashed gram inside it, so equal windows have their anchors at equal
offsets.  Consecutive windows with one anchor form a record.  A window can only repeat if its anchor's
gram does, so grams are counted first (hash, document and place only; combined before the shuffle), and
only records whose gram repeats carry text to another task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts, slabs, stash, text_or_empty

RECORD = "h long, key long, start long, n int, back int"
#: Records a bucket; the number of buckets follows the input.
A_BUCKET = 20_000
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of a text that are scanned at once; longer ones are scanned in overlapping pieces.
_PIECE = 1_000_000

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64."""
    found = _powers.get(base)
    if found is None or len(found) < n:
        found = np.full(max(n, 1 << 20), base, np.uint64)
        found[0] = 1
        _powers[base] = found = np.multiply.accumulate(found)
    return found[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end], equal for equal content wherever it stands."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * _power(_INVERSE, n + 1)[starts])


def anchors(values: np.ndarray, owner_ends: np.ndarray, window: int, gram: int):
    """Records of one array that holds several owners' values one after the other.

    owner_ends: for each element the end of its owner.  Gives start, number of windows, anchor and gram
    hash of each record; windows never cross owners."""
    n = len(values)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    at = np.arange(n - gram + 1)
    hashes = span_hashes(values, at, at + gram)
    low = (hashes & ~_PLACE) | at.astype(np.uint64)
    width, have = window - gram + 1, 1
    while have < width:  # minima of runs of a doubling length
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    anchor = (low & _PLACE).astype(np.int64)
    valid = np.arange(len(anchor)) + window <= owner_ends[: len(anchor)]
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    starts = np.flatnonzero(fresh)
    upto = np.cumsum(valid)
    n_windows = np.diff(np.append(upto[starts] - 1, upto[-1]))
    return starts, n_windows, anchor[starts], hashes[anchor[starts]].view(np.int64)


def _record_batch(h, key, start, n, back):
    return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(key, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int32()), pa.array(back, pa.int32())], ["h", "key", "start", "n", "back"])


def byte_units(blobs: list[bytes], window: int):
    """Pieces of (blob number, unit offset, values), long blobs cut with overlap."""
    for i, b in enumerate(blobs):
        for at in range(0, max(1, len(b) - window + 1), _PIECE):
            yield i, at, np.frombuffer(b, np.uint8)[at : at + _PIECE + window - 1]


_SEPARATOR = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def word_places(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word."""
    space = _SEPARATOR[np.frombuffer(b, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    return edge[::2], edge[1::2]


def word_values(b: bytes, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the words that begin at s and end at e, piece by piece."""
    per = _PIECE // 4
    cut = [(s[at : at + per], e[at : at + per]) for at in range(0, len(s), per)]
    return np.concatenate([span_hashes(np.frombuffer(b, np.uint8)[x[0] : y[-1]], x - x[0], y - x[0]) for x, y in cut]) if cut else np.zeros(0, np.uint64)


def word_units(blobs: list[bytes], window: int):
    """The same by words: values are word hashes."""
    for i, b in enumerate(blobs):
        starts, ends = word_places(b)
        per = _PIECE // 4
        for at in range(0, max(1, len(starts) - window + 1), per):
            s, e = starts[at : at + per + window - 1], ends[at : at + per + window - 1]
            if len(s):
                yield i, at, span_hashes(np.frombuffer(b, np.uint8)[s[0] : e[-1]], s - s[0], e - s[0])


def records(docs: DataFrame, units, window: int, gram: int) -> DataFrame:
    """RECORD rows of all (key, text) rows: gram hash, first window's place, windows, anchor behind it."""

    def run(batches):
        for batch in batches:
            ids, texts = np.array(batch.column(0).to_pylist(), np.int64), batch.column(1).to_pylist()
            for a, b in slabs(texts, _PIECE):
                held, size = [], 0
                for piece in units([t.encode() for t in texts[a:b]], window):
                    if len(piece[2]) >= window:
                        held.append(piece)
                        size += len(piece[2])
                    if size >= _PIECE:
                        yield one(held, ids[a:b])
                        held, size = [], 0
                if held:
                    yield one(held, ids[a:b])

    def one(held, ids):
        sizes = np.array([len(v) for _, _, v in held])
        ends = np.cumsum(sizes)
        starts, n, anchor, h = anchors(np.concatenate([v for _, _, v in held]), np.repeat(ends, sizes), window, gram)
        of = np.searchsorted(ends, starts, side="right")
        begin = starts - (ends - sizes)[of] + np.array([at for _, at, _ in held])[of]
        return _record_batch(h, ids[np.array([i for i, _, _ in held])[of]], begin, n, anchor - starts)

    return docs.mapInArrow(run, RECORD)


def repeated(texts: DataFrame, units, window: int, gram: int, across: bool, hot: int):
    """The records of ``keyed`` texts whose gram repeats (under another key, if ``across``), marked ``hot`` if it has
    more than ``hot`` records, too many for one task; and the bucket count."""
    all_records = stash(records(texts.where("key is not null").select("key", "text"), units, window, gram), "records")
    counts = all_records.groupBy("h").agg(F.count("*").alias("c"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    # written first, so that a gram with many records is a skewed join of two scans, which Spark splits
    again = stash(counts.where("lo < hi" if across else "c > 1").select("h", (F.col("c") > hot).alias("hot")), "again")
    found = stash(all_records.join(again, "h"), "repeated")
    return found, max(parts(texts.sparkSession), all_records.count() // A_BUCKET + 1)


def row_key(docs: DataFrame) -> Column:
    """A number for each row: doc_id, or a hash of doc_id and text if a doc_id comes twice; null without doc_id.

    Rows that repeat both share a key; they have the same text, and so the same places and spans."""
    ids = docs.where("doc_id is not null").groupBy("doc_id").count()
    if ids.where("count > 1").limit(1).count():
        return F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", text_or_empty()))
    return F.col("doc_id")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(row_key(docs).alias("key"), "doc_id", text_or_empty().alias("text"))


def with_texts(texts: DataFrame, found: DataFrame) -> DataFrame:
    """(key, doc_id, text, recs) for the rows that have such records; texts are dealt by key."""
    per = found.groupBy("key").agg(F.collect_list(F.struct("start", "n", "back", "h")).alias("recs"))
    return texts.hint("shuffle_merge").join(per.hint("shuffle_merge"), "key").select("key", "doc_id", "text", "recs")


def merged(starts: list, ends: list) -> list[tuple[int, int]]:
    """Union of [start, end) spans as maximal runs."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(zip(starts, ends, strict=True)):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def windows_by_digest(texts: DataFrame, pack, windows, window: int, across: bool) -> DataFrame:
    """SPAN rows of repeated windows of hot grams, counted by the digest of their content.

    pack(text) gives a function from a record's start and number of windows to its packed units, and
    windows(packed) its windows.  Records are first counted by the digest of the whole, so copies of a
    passage are one row before any window is looked at; windows of distinct records are then counted,
    both with map-side combination, and every record takes back one list."""
    import hashlib

    def records_of(batches):
        for batch in batches:
            out, size = [], 0
            for key, doc, text, recs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cut = pack(text.encode())
                for r in recs:
                    packed = cut(r["start"], r["n"])
                    out.append((hashlib.md5(packed).digest(), key, doc, r["start"], packed))
                    size += len(packed)
                if size > 4_000_000:
                    yield batch_of(out)
                    out, size = [], 0
            yield batch_of(out)

    def batch_of(out):
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["whole", "key", "doc_id", "start", "packed"])

    def windows_of(batches):
        for batch in batches:
            for whole, lo, c, packed in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                held = [hashlib.md5(w).digest() for w in windows(packed)]
                n = len(held)
                yield pa.RecordBatch.from_arrays([pa.array([whole] * n, pa.binary()), pa.array(range(n), pa.int32()), pa.array(held, pa.binary()), pa.array([lo] * n, pa.int64()), pa.array([c] * n, pa.int64())], ["whole", "j", "digest", "lo", "c"])

    def spans_of(batches):
        for batch in batches:
            out = []
            for key, doc, start, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = [start + x["j"] for x in found if (x["lo"] < doc if across else x["c"] > 1)]
                out += [(key, s, e) for s, e in merged(at, [p + window for p in at])]
            columns = list(zip(*out, strict=True)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "s", "e"])

    # left lazy: in one plan with the other records, the exchange of the texts is made once and reused
    each = texts.mapInArrow(records_of, "whole binary, key long, doc_id long, start long, packed binary")
    distinct = each.groupBy("whole").agg(F.min("doc_id").alias("lo"), F.count("*").alias("c"), F.first("packed").alias("packed"))
    window_rows = distinct.mapInArrow(windows_of, "whole binary, j int, digest binary, lo long, c long")
    counts = window_rows.groupBy("digest").agg(F.min("lo").alias("lo"), F.sum("c").alias("c"))
    per = window_rows.select("whole", "j", "digest").join(counts, "digest").groupBy("whole").agg(F.collect_list(F.struct("j", "lo", "c")).alias("found"))
    return each.select("whole", "key", "doc_id", "start").join(per, "whole").select("key", "doc_id", "start", "found").mapInArrow(spans_of, "key long, s long, e long")


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, text, ss, es) of every row; ss and es are null where nothing repeats."""
    per = spans.groupBy("key").agg(F.collect_list("s").alias("ss"), F.collect_list("e").alias("es"))
    return texts.hint("shuffle_merge").join(per.hint("shuffle_merge"), "key", "left").select("doc_id", "text", "ss", "es")
