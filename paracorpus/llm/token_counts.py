"""Token counts of whole texts by prefix dynamic programming (operator 1).

The recurrence stores the exact count of every prefix of a pre-token: its last token is the only one
that is compatible with the last token of what stands before it.  Pre-tokens add up, so counts, budget
tests and truncation points come from one pass and nothing is encoded again.  Each worker keeps the
prefix counts of distinct pre-tokens in bounded caches, and drops them when it is idle.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings are single tokens, as the
library reads them; lone surrogates cannot occur in Spark strings; very long texts are counted whole, and pre-tokens
of over 32 bytes one by one; repeated rows give repeated rows;
an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import itertools

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import bpe
from .common import documents, slabs, text_or_empty

VOCABULARY = "byte_bpe_50k.json"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_bytes long"


def token_counts(docs: DataFrame, limit: int = 1024, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) and fitting_bytes: the longest
    prefix, in bytes, that has at most ``limit`` tokens when pre-tokens are those of the whole text."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        counter = bpe.byte_counter(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slabs(texts):
                lists, counts = counter.count_many(texts[a:b])
                sizes = [len(t.encode()) for t in texts[a:b]]
                tokens = [sum(c) for c in counts]
                fit = [s if n <= limit else counter.fitting(w, c, limit) for s, n, w, c in zip(sizes, tokens, lists, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([ids[a:b], pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens]), pa.array(fit, pa.int64())], ["doc_id", "n_bytes", "n_tokens", "over_limit", "fitting_bytes"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, SCHEMA)


def prefix_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ends array<long> and counts array<long>: at each pre-token border the bytes before it and the
    exact token count of that prefix, from which any budget question is a binary search."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        counter = bpe.byte_counter(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slabs(texts):
                lists, counts = counter.count_many(texts[a:b])
                ends = [list(itertools.accumulate(len(c.encode()) for c in cs)) for cs in lists]
                sums = [list(itertools.accumulate(c)) for c in counts]
                yield pa.RecordBatch.from_arrays([ids[a:b], pa.array(ends, pa.list_(pa.int64())), pa.array(sums, pa.list_(pa.int64()))], ["doc_id", "ends", "counts"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ends array<long>, counts array<long>")


def every_prefix(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and counts array<int>: element i is the exact token count of the first i + 1 bytes, pre-tokens being those of the
    whole text; any truncation or budget question is a look or a binary search, and nothing is encoded again."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        counter = bpe.byte_counter(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slabs(texts):
                lists, totals = counter.count_many(texts[a:b])
                out = []
                for chunks, counts in zip(lists, totals, strict=True):
                    found, before = [], 0
                    for chunk, count in zip(chunks, counts, strict=True):
                        found += [before + c for c in counter.prefixes(chunk)]
                        before += count
                    out.append(found)
                yield pa.RecordBatch.from_arrays([ids[a:b], pa.array(out, pa.list_(pa.int32()))], ["doc_id", "counts"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, counts array<int>")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
