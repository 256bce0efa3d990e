"""BPE encoding and decoding by speculation (operator 9).

Greedy longest matches propose the tokens of each distinct word; all adjacent pairs of a batch are tested
together for compatibility (a pair is compatible if its text encodes to it); words with a failing pair
are merged exactly.  White-space chunks are independent of each other, so chunks are coded once a worker.

Defined cases: a null, empty or white-space text has no tokens and decodes to the empty string; special
strings are single tokens; very long texts are coded whole, words of over 32 bytes merged exactly at once; repeated rows give repeated rows; an empty table gives no rows; other columns
of the input are ignored.
"""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import bpe
from .common import documents, slabs, text_or_empty

VOCABULARY = "word_bpe_49k.json"


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids array<int> and decoded string of each text."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        import numpy as np

        codec = bpe.word_codec(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slabs(texts):
                both = codec.round_trip(texts[a:b])
                ids = [np.frombuffer(x, "<u4").astype("i4") for x, _ in both]
                yield pa.RecordBatch.from_arrays([keys[a:b], pa.array(ids, pa.list_(pa.int32())), pa.array([d.decode() for _, d in both], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``encode`` with the digests of its outputs in their place, so that no id list leaves the worker."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        codec = bpe.word_codec(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slabs(texts):
                both = codec.round_trip(texts[a:b])
                yield pa.RecordBatch.from_arrays([keys[a:b], pa.array([len(x) // 4 for x, _ in both], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x, _ in both]), pa.array([hashlib.sha256(d).hexdigest() for _, d in both])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
