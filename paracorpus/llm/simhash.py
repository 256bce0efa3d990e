r"""SimHash near-duplicates by a positional inverted index with count filtering (operator 8).

Fingerprints at two or fewer differing bits share at least six of their eight positional bytes.  Lists under single bytes
would grow with the corpus, so the index first posts each distinct fingerprint under pairs of two-byte blocks: of four
blocks two at least agree, so every link meets in such a list, whose members share four positional bytes.  Each list is
split by the further bytes: its members are posted under each of the other four positions, the meetings of a pair are
tallied, and pairs that share fewer than six bytes in all are dropped.  What is left is verified bit by bit.  A list
of more than ``HOT`` fingerprints is not paired: its fingerprints are posted again with one or two of the free bits
struck out, which gives groups of four at most and the same links.  Copies of one fingerprint are one entry from the start.

Defined cases: a null, empty or word-free text has fingerprint zero and links like any other; very long texts are hashed
whole, in pieces; rows without doc_id have a fingerprint and count for no component's name; repeated rows give repeated rows, and
rows that repeat a doc_id are rows of their own in one component or several; an empty table gives no rows; other columns of the input are ignored by
``op8`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, slabs, stash, text_or_empty
from .components import components

SEED, HOT = 42, 512
#: Bits in which linked fingerprints may differ.
BITS = 2
_CHUNK = 200_000


def fingerprint(words: list[bytes], shingle: int = 3) -> int:
    """Majority bits over the hashes of word shingles, repeats included."""
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        part = words[at : min(n, at + _CHUNK) + shingle - 1]
        runs = [part[i : len(part) - shingle + 1 + i] for i in range(shingle)] if len(words) >= shingle else [[b" ".join(words)]]
        h = np.array([digest(s, SEED) for s in map(b" ".join, zip(*runs, strict=True))], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: tuple = ("doc_id",), shingle: int = 3) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed long."""
    schema = docs.select(*keep).schema.add("fp", "long")

    def run(batches):
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for a, b in slabs(texts):
                # lower() and split() of bytes know ASCII alone, which is what is asked for
                fps = [fingerprint(t.encode().lower().split(), shingle) for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays([*(batch.column(i)[a:b] for i in range(len(keep))), pa.array(np.array(fps, "u8").view("i8"), pa.int64())], [*keep, "fp"])

    return docs.select(*keep, text_or_empty().alias("_text")).mapInArrow(run, schema)


def candidates(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b) pairs of the distinct fingerprints in ``fp`` that share six positional bytes or more, what two differing bits leave."""
    blocks = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    mask = {i: 0xFFFF << (16 * i) for i in range(4)}
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    kept = F.array(*[F.lit(signed(mask[i] | mask[j])) for i, j in blocks])
    posted = distinct.select("fp", F.posexplode(kept).alias("combo", "mask")).select("fp", "combo", F.expr("fp & mask").alias("key"))
    sizes = posted.groupBy("combo", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = stash(posted.join(sizes, ["combo", "key"]), "postings")

    # a list shares four bytes; its members are posted under each of the other four, and a pair's tally is how often it meets
    others = F.create_map(*[x for c, (i, j) in enumerate(blocks) for x in (F.lit(c), F.array(*[F.lit(p) for p in range(8) if p // 2 not in (i, j)]))])
    byte = met.where(F.col("n") <= hot).select("combo", "key", "fp", F.explode(others[F.col("combo")]).alias("place"))
    byte = byte.withColumn("byte", F.expr("cast(shiftrightunsigned(fp, 8 * place) & 255 as int)"))
    on = ["combo", "key", "place", "byte"]
    pairs = byte.withColumnRenamed("fp", "a").join(byte.withColumnRenamed("fp", "b"), on).where("a < b")
    tallied = pairs.groupBy("combo", "key", "a", "b").agg((F.count("*") + 4).alias("shared")).where(f"shared >= {8 - BITS}").select("a", "b")

    # large postings: strike out one or two free bits; what is equal then differs nowhere else
    free = F.create_map(*[x for c, (i, j) in enumerate(blocks) for x in (F.lit(c), F.array(*[F.lit(b) for b in range(64) if b // 16 not in (i, j)]))])
    many = met.where(F.col("n") > hot).select("fp", F.explode(free[F.col("combo")]).alias("i"), free[F.col("combo")].alias("f"))
    many = many.select("fp", "i", F.explode(F.expr("filter(f, j -> j > i)")).alias("j")).select("fp", "i", "j", F.expr("fp & ~(shiftleft(1L, i) | shiftleft(1L, j))").alias("rest"))
    struck = many.groupBy("i", "j", "rest").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    more = struck.select(F.explode(F.expr("flatten(transform(fps, a -> transform(filter(fps, b -> b > a), b -> named_struct('a', a, 'b', b))))")).alias("p")).select("p.a", "p.b")
    return tallied.unionByName(more).distinct()


def links(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b) pairs of the distinct fingerprints in ``fp`` that differ in one or two bits: the candidates, verified bit by bit."""
    return candidates(distinct, hot).where(f"bit_count(a ^ b) <= {BITS}")


def grouped(marked: DataFrame) -> DataFrame:
    """``marked`` (doc_id, fp, ...) with component_id, the smallest doc_id that links reach."""
    distinct = stash(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(links(distinct))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp")
    low = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = rooted.join(low, "root").select("fp", "component_id")
    return marked.join(distinct, "fp").join(linked, "fp", "left").withColumn("component_id", F.coalesce("component_id", "first")).drop("first")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of every row."""
    return grouped(stash(fingerprints(docs), "marked"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group; of rows that repeat a doc_id one stays.
    Rows without doc_id cannot be told apart and all stay."""
    first = near_duplicates(docs).where("doc_id = component_id").select(F.col("doc_id").alias("_first")).distinct()
    kept = docs.join(first, docs["doc_id"] == first["_first"], "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
