r"""Suffix-array dedup of byte strings (operator 2) by a distributed merge sort that knows common prefixes.

A byte goes if a ``WINDOW``-byte string over it also starts elsewhere.  The suffix array is sparse: only
suffixes at anchors (see ``repeats``) are sorted, which loses nothing, since equal windows have anchors
at equal offsets.  Each task sorts its suffixes into a front-coded run for each bucket, runs are merged by
a loser tree, and the shared prefix lengths that the merge yields, with the common parts on the left of
the anchors, tell which windows repeat.

The same sort works on words: a word is then its 64-bit hash, eight bytes of a string, and only whole
words count.  ``clean`` with ``words`` cuts passages of so many words, whatever white space stands between.

Defined cases: null, empty and short texts lose nothing; documents without doc_id take no part and keep
all; every row is a place of its own, so rows that repeat a doc_id lose what they share, and each its own
bytes; very long texts are scanned in pieces; an empty table gives no rows; ``clean`` keeps all columns of
its input, whatever their names, and drops bytes of characters cut in two.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import repeats
from .common import documents, text_or_empty
from .suffix_merge import LoserTree, common_suffix, front_code

WINDOW, GRAM = 400, 64
#: Bytes of strings that a task sorts into one set of runs.
RUN_BYTES = 8_000_000
#: Up to so many strings of one gram are compared pair by pair, more by offsets.
FEW = 12
#: Records of one gram that one task may merge; the windows of larger groups are counted by digest.
HOT = 20_000
RUN = "bucket int, shared array<int>, rest array<binary>, left array<binary>, owners array<int>, keys array<long>, starts array<long>"
_RUN_KINDS = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
SPANS = "key long, s long, e long"
#: Bytes of a word's hash.
WORD = 8


def _runs(held: dict[int, dict]) -> pa.RecordBatch:
    """One front-coded run a bucket; equal strings are one entry with several owners."""
    rows = []
    for bucket, entries in held.items():
        order = sorted(entries)
        shared, rest = front_code([right for right, _ in order])
        owners = [entries[k] for k in order]
        flat = [o for os in owners for o in os]
        rows.append((bucket, shared, rest, [left for _, left in order], [len(o) for o in owners], [d for d, _ in flat], [s for _, s in flat]))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _RUN_KINDS, strict=True)], [x.split()[0] for x in RUN.split(", ")])


def _strings(text: str, by_word: bool) -> bytes:
    blob = text.encode()
    return repeats.word_values(blob, *repeats.word_places(blob)).tobytes() if by_word else blob


def _sort(window: int, buckets: int, by_word: bool):
    u = WORD if by_word else 1

    def run(batches):
        held: dict[int, dict] = {}
        size = 0
        for batch in batches:
            for key, _, text, recs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blob = _strings(text, by_word)
                for r in recs:
                    start, anchor = r["start"], r["start"] + r["back"]
                    string = blob[u * anchor : u * (start + r["n"] - 1 + window)], blob[u * start : u * anchor]
                    held.setdefault(r["h"] % buckets, {}).setdefault(string, []).append((key, start))
                    size += len(string[0]) + len(string[1])
                if size > RUN_BYTES:
                    yield _runs(held)
                    held, size = {}, 0
        yield _runs(held)

    return run


def _read(row: dict):
    at = 0
    for shared, rest, left, n in zip(row["shared"], row["rest"], row["left"], row["owners"], strict=True):
        yield shared, rest, (left, list(zip(row["keys"][at : at + n], row["starts"][at : at + n], strict=True)))
        at += n


def repeated_offsets(entries: list, window: int, u: int = 1) -> list[list[tuple[int, int]]]:
    """For each (right, shared, left, owners) of one gram, in order, the (low, high) offsets of its repeated windows.

    A window at offset o begins o bytes before the anchor; it repeats if another entry agrees in o bytes
    on the left and in window - o on the right, or if the whole entry has a second owner.  Offsets are
    multiples of ``u`` bytes."""
    own = [(window - len(right), len(left)) for right, _, left, _ in entries]
    found: list[list[tuple[int, int]]] = [[o] if len(e[3]) > 1 else [] for o, e in zip(own, entries, strict=True)]
    if len(entries) <= FEW:
        for i in range(len(entries)):
            agree = window
            for j in range(i + 1, len(entries)):
                agree = min(agree, entries[j][1])
                left = common_suffix(entries[i][2], entries[j][2])
                for k in (i, j):
                    low, high = max(own[k][0], window - agree + agree % u), min(own[k][1], left - left % u)
                    if low <= high:
                        found[k].append((low, high))
        return found
    for o in range(min(x for x, _ in own), max(x for _, x in own) + 1, u):
        seen: dict[tuple[int, bytes], int] = {}
        cluster = 0
        for i, (_, shared, left, _) in enumerate(entries):
            cluster += shared < window - o
            if own[i][0] <= o <= own[i][1]:
                first = seen.setdefault((cluster, left[len(left) - o :]), i)
                if first != i:
                    found[i].append((o, o))
                    found[first].append((o, o))
    return found


def _merge(window: int, gram: int, by_word: bool):
    u = WORD if by_word else 1

    def spans(entries):
        if len(entries) == 1 and len(entries[0][3]) == 1:
            return
        for (_, _, left, owners), ranges in zip(entries, repeated_offsets(entries, window * u, u), strict=True):
            for low, high in repeats.merged([x // u for x, _ in ranges], [y // u + 1 for _, y in ranges]):
                for key, start in owners:
                    anchor = start + len(left) // u
                    yield key, anchor - high + 1, anchor - low + window

    def run(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        entries: list[list] = []
        same: dict[bytes, list] = {}  # entries with the present right part, by left part
        for right, shared, (left, owners) in LoserTree([_read(r) for r in table.to_pylist()]):
            if shared < gram * u:
                out += spans(entries)
                entries, same = [], {}
            elif not (shared == len(right) == len(entries[-1][0])):
                same = {}
            if left in same:
                same[left][3] += owners
            else:
                # what an entry shares is with the entry before it; equal strings in between share all
                entries.append([right, shared, left, list(owners)])
                same[left] = entries[-1]
        out += spans(entries)
        columns = list(zip(*out, strict=True)) if out else [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["key", "s", "e"])

    return run


def repeated_spans(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, by_word: bool = False) -> DataFrame:
    """(key, s, e) byte or word spans of ``keyed`` texts covered by windows that start in more than one place; may overlap."""
    found, buckets = repeats.repeated(texts, repeats.word_units if by_word else repeats.byte_units, window, gram, across=False, hot=HOT)
    cold = repeats.with_texts(texts, found.where("not hot"))
    runs = cold.mapInArrow(_sort(window, buckets, by_word), RUN)
    spans = runs.groupBy("bucket").applyInArrow(_merge(window, gram, by_word), SPANS)
    if found.where("hot").limit(1).count():
        u = WORD if by_word else 1
        hot = repeats.with_texts(texts, found.where("hot"))
        strings = (lambda blob: _strings(blob.decode(), True)) if by_word else (lambda blob: blob)

        def pack(blob):
            held = strings(blob)
            return lambda start, n: held[u * start : u * (start + n + window - 1)]

        windows = lambda packed: [packed[j : j + u * window] for j in range(0, len(packed) - u * window + 1, u)]
        spans = spans.unionByName(repeats.windows_by_digest(hot, pack, windows, window, False))
    return spans


def _cut(text: str, ss, es, by_word: bool = False) -> tuple[bytes, bytes, list]:
    blob = text.encode()
    runs = repeats.merged(ss or [], es or [])
    if by_word and runs:
        first, end = repeats.word_places(blob)
        runs = [(int(first[s]), int(end[e - 1])) for s, e in runs]
    at, kept = 0, []
    for s, e in runs:
        kept.append(blob[at:s])
        at = e
    kept.append(blob[at:])
    return blob, b"".join(kept), runs


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, kept binary, n_bytes, n_removed, n_spans, kept_sha256 of every document."""

    def run(batches):
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            out = []
            for doc, text, ss, es in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blob, kept, runs = _cut(text, ss, es)
                out.append((doc, kept, len(blob), len(blob) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    texts = repeats.keyed(docs)
    return repeats.with_spans(texts, repeated_spans(texts, window, gram)).mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def clean(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, words: bool = False) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; what is left of a character cut in two goes too.
    With ``words``, window and gram are numbers of words, and what is cut runs from a word's start to a word's end."""

    def run(batches):
        for batch in batches:
            texts = [_cut(t or "", ss, es, words)[1].decode(errors="ignore") if ss else t for t, ss, es in zip(*(c.to_pylist() for c in batch.columns[-3:]), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc", "text"])

    key = repeats.row_key(docs)
    spans = repeated_spans(docs.select(key.alias("key"), "doc_id", text_or_empty().alias("text")), window, gram, words)
    per = spans.groupBy("key").agg(F.collect_list("s").alias("_ss"), F.collect_list("e").alias("_es"))
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc")
    held = docs.select(key.alias("key"), rest, F.col("text").cast("string").alias("text")).join(per.hint("shuffle_merge"), "key", "left").select("doc", "text", "_ss", "_es")
    done = held.mapInArrow(run, held.select("doc", "text").schema)
    return done.select(*[F.col("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
