r"""Near copies by exact Jaccard similarity of word shingles: operator 8's fingerprints first, prefix lists for what they miss.

The pipeline's near-dedup stage keeps one document of each group that pairs of similarity ``SIMILAR`` or more link.  Copies
with few edits are linked by the fingerprint index of ``simhash``.  Bit distances cannot decide the rest, since edited copies
of similarity 0.8 differ in ten bits of 64 and more, so the remaining documents meet by prefixes: in any fixed order of
shingles, two sets that are similar enough share one among the first n - ceil(SIMILAR * n) + 1 of each.  The order takes rare
shingles first, as a sketch of all shingles' counts tells, so that lists stay short.  Each list is compared with its smallest
member; then, in lists of more than one group, members of different groups are compared, unless their differences from that
smallest member rule a link out.  Every pair is verified on the whole sets, and nothing is capped.

Equal sets are one node, named by its smallest doc_id; sets are told apart by a 64-bit hash, and shingles are 64-bit hashes,
too.  Defined cases: texts under ``SHINGLE`` words have one shingle of all words; null, empty and word-free texts are copies of
each other; very long texts are taken whole; rows that repeat a doc_id count as copies, and one stays; rows without doc_id
all stay; an empty table gives no rows; other columns are kept, whatever their names.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import parts, slabs, stash, text_or_empty
from .components import components

SHINGLE, SIMILAR, SEED = 5, 0.8, 42
#: Cells of the sketch of counts that orders shingles, and how many of them are one row of it.
CELLS, ROW = 1 << 22, 1024
#: Bits of the bitmaps of what differs from a list's smallest member.
BITS = 256
MARKED = "doc_id long, node long, size int, fp long, prefix array<long>"


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of a text, in the order of their numbers."""
    words = text.encode().lower().split()
    runs = [islice(words, i, None) for i in range(shingle)] if len(words) >= shingle else [[b" ".join(words)]] if words else []
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in map(b" ".join, zip(*runs, strict=False))], "<u8").view("<i8"))


def _node(held: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(held.tobytes(), SEED)).view(np.int64))


def _fingerprint(held: np.ndarray) -> int:
    """Operator 8's majority bits, over the distinct shingles."""
    ones = sum((np.unpackbits(held[s : s + 100_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64) for s in range(0, len(held), 100_000)), np.zeros(64, np.int64))
    return int(np.packbits(ones * 2 > len(held), bitorder="little").view("<i8")[0])


def levels(docs: DataFrame, shingle: int = SHINGLE, cells: int = CELLS) -> np.ndarray:
    """For each cell a byte that grows with the logarithm of its count over all documents; its size is a parameter's."""

    def count(batches):
        total = np.zeros(cells, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slabs(texts):
                total += np.bincount(np.concatenate([shingles(t, shingle) for t in texts[a:b]]) & (cells - 1), minlength=cells)
        rows = np.minimum(total, 255).astype(np.uint8).reshape(-1, ROW)  # a task's most; crowded cells need no finer order
        for at in np.array_split(np.flatnonzero(rows.any(1)), max(1, len(rows) // 512)):
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([rows[i].tobytes() for i in at], pa.binary())], ["row", "counts"])

    def total(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                new = np.frombuffer(counts, np.uint8).astype(np.int64)
                held[row] = held[row] + new if row in held else new
        found = [np.minimum(np.round(8 * np.log2(1 + x)), 255).astype(np.uint8).tobytes() for x in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(found, pa.binary())], ["row", "counts"])

    schema = "row int, counts binary"
    out = np.zeros((cells // ROW, ROW), np.uint8)
    for r in docs.select(text_or_empty().alias("t")).mapInArrow(count, schema).repartition(parts(docs.sparkSession), "row").mapInArrow(total, schema).collect():
        out[r.row] = np.frombuffer(r.counts, np.uint8)
    return out.ravel()


def marked(docs: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR) -> DataFrame:
    """MARKED rows of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(levels(docs, shingle))

    def run(batches):
        level = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slabs(texts):
                nodes, sizes, fps, prefixes = [], [], [], []
                for text in texts[a:b]:
                    held = shingles(text, shingle)
                    n = len(held)
                    first = n - int(np.ceil(similar * n - 1e-9)) + 1 if n else 0
                    nodes.append(_node(held))
                    sizes.append(n)
                    fps.append(_fingerprint(held))
                    prefixes.append(held[np.lexsort((held, level[held & (len(level) - 1)]))[:first]])
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(fps, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))], ["doc_id", "node", "size", "fp", "prefix"])

    return docs.select("doc_id", text_or_empty().alias("t")).mapInArrow(run, MARKED)


def _words(held: np.ndarray) -> list[int]:
    """The set as a bitmap of ``BITS`` bits, as signed longs."""
    bits = np.zeros(BITS, bool)
    bits[(held >> 24) & (BITS - 1)] = True
    return np.packbits(bits, bitorder="little").view("<i8").tolist()


def _compared(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """a, b, near, shared, lost, own of the (a, b) pairs: are their sets similar, how many shingles do they share, and bitmaps of
    what b lacks of a and has besides."""

    def run(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            rows = []
            for i in range(batch.num_rows):
                p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
                has = np.isin(q, p, assume_unique=True)
                both = int(has.sum())
                rows.append((both >= similar * (len(p) + len(q) - both) - 1e-9, both, _words(np.setdiff1d(p, q[has], assume_unique=True)), _words(q[~has])))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = [pa.bool_(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["a", "b", "near", "shared", "lost", "own"])

    one = lambda c, name: sets.select(F.col("node").alias(c), F.col("held").alias(name))
    both = pairs.join(one("a", "x"), "a").join(one("b", "y"), "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a long, b long, near boolean, shared int, lost array<long>, own array<long>")


def _at_most(bits: str) -> str:
    """Bound on what the sets behind two bitmaps share: elements in common bits, and those that have no bit of their own."""
    common = " + ".join(f"bit_count(a_{bits}{i} & b_{bits}{i})" for i in range(BITS // 64))
    return f"{common} + least(a_{bits}_more, b_{bits}_more)"


def _sets(docs: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """(node, held): the whole sets of the nodes of ``pairs``, from the texts of the documents that name them."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slabs(texts):
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array([shingles(t, shingle) for t in texts[a:b]], pa.list_(pa.int64()))], ["node", "held"])

    # Spark broadcasts the written ids only if their file is under its threshold
    names = stash(pairs.selectExpr("explode(array(a, b)) node").distinct(), "needed")
    texts = docs.select(F.col("doc_id").alias("node"), text_or_empty().alias("t")).join(names, "node", "left_semi")
    return stash(texts.mapInArrow(run, "node long, held array<long>"), "sets")


def _rooted(df: DataFrame, links: DataFrame) -> DataFrame:
    """``df`` with the smallest node that links reach from each node."""
    return df.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))


#: What two sets may share at most if this is the first shingle that they share; another list has the pair if it is not.
_MOST = "least(a_size - a_pos, b_size - b_pos)"


def links(docs: DataFrame, nodes: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR) -> DataFrame:
    """(a, b) pairs of ``nodes`` (node, size, fp, prefix) that connect all similar nodes."""
    spark = docs.sparkSession
    first = nodes.groupBy("fp").agg(F.min("node").alias("a"))
    same = nodes.select("fp", F.col("node").alias("b")).join(first, "fp").select("a", "b").where("a <> b")
    near = simhash.links(first.select("fp"))
    # the index names fingerprints; each stands for the smallest node that has it
    near = near.join(first.select(F.col("fp").alias("a"), F.col("a").alias("x")), "a").join(first.select(F.col("fp").alias("b"), F.col("a").alias("y")), "b")
    proposed = stash(same.unionByName(near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))), "proposed")

    # one exchange for both sides of the join, as both take the same columns
    place = "size * 4294967296 + pos"
    posted = nodes.select(F.posexplode("prefix").alias("pos", "h"), "node", "size").select("h", "node", F.expr(place).alias("at")).repartition("h")
    shared = posted.groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.min("at").alias("at")).where("lo < hi and at >= 0").select("h")
    met = stash(posted.join(shared, "h").selectExpr("h", "node", "cast(at div 4294967296 as int) size", "cast(at % 4294967296 as int) pos"), "met")

    able = f"least(a_size, b_size) >= {similar}D * greatest(a_size, b_size) - 1e-9D and {_MOST} >= {similar / (1 + similar)}D * (a_size + b_size) - 1e-6D"
    reps = stash(met.groupBy("h").agg(F.min(F.struct("node", "size", "pos")).alias("rep")).selectExpr("h", "rep.node a", "rep.size a_size", "rep.pos a_pos"), "reps")
    one = met.select("h", F.col("node").alias("b"), F.col("size").alias("b_size"), F.col("pos").alias("b_pos"))
    star = reps.join(one, (reps["h"] == one["h"]) & F.expr(f"a <> b and {able}")).select("a", "b")
    star = stash(star.unionByName(proposed).distinct(), "star")
    told = stash(_compared(star, _sets(docs, star, shingle), similar), "told")
    found = told.where("near").select("a", "b")

    # lists of one group are done; in the others, members that differ from the smallest one in different shingles differ from
    # each other in all of them
    lists = stash(_rooted(met, found), "lists")
    opened = lists.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h")
    left = lists.join(opened, "h").join(reps.select("h", F.col("a").alias("rep"), F.col("a_size").alias("of")), "h")
    own = told.select(F.col("a").alias("rep"), F.col("b").alias("node"), "shared", "lost", "own")
    left = left.join(own, ["rep", "node"], "left").withColumn("shared", F.expr("if(rep = node, of, shared)"))
    bitmaps = [F.expr(f"if(rep = node, 0L, {c}[{i}])").alias(f"{c}{i}") for c in ("lost", "own") for i in range(BITS // 64)]
    more = [F.expr(f"{n} - shared - if(rep = node, 0, " + " + ".join(f"bit_count({c}[{i}])" for i in range(BITS // 64)) + ")").alias(f"{c}_more") for c, n in (("lost", "of"), ("own", "size"))]
    left = stash(left.select("h", "of", "root", "node", "size", "pos", F.expr("of - shared").alias("n_lost"), *bitmaps, *more), "left")
    one, other = (left.select("h", "of", *[F.col(c).alias(f"{s}_{c}") for c in left.columns[2:]]) for s in "ab")
    share = f"one.of - a_n_lost - b_n_lost + {_at_most('lost')} + {_at_most('own')}"
    may = f"coalesce({share} >= {similar / (1 + similar)}D * (a_size + b_size) - 1e-6D, true)"
    one, other = one.alias("one"), other.alias("other")
    cross = one.join(other, F.expr(f"one.h = other.h and a_root < b_root and {able} and {may}")).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    known = told.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    cross = stash(cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(known, ["a", "b"], "left_anti"), "cross")
    return found.unionByName(_compared(cross, _sets(docs, cross, shingle), similar).where("near").select("a", "b"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group; of rows that repeat a doc_id one stays.
    Rows without doc_id cannot be told apart and all stay."""
    held = marked(docs.where("doc_id is not null"), shingle, similar)
    named = held.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("prefix").alias("prefix"))
    nodes = stash(named.select(F.col("first").alias("node"), "size", "fp", "prefix"), "nodes")
    groups = _rooted(nodes.select("node"), links(docs, nodes, shingle, similar))
    ids = docs.where("doc_id is not null").select("doc_id")
    # what goes is less than what stays; Spark broadcasts the written ids only if their file is under its threshold
    gone = stash(ids.join(groups.where("node = root").select("node"), F.col("doc_id") == F.col("node"), "left_anti").distinct().withColumnRenamed("doc_id", "_gone"), "gone")
    kept = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    if ids.groupBy("doc_id").count().where("count > 1").limit(1).count():
        kept = kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))
    return kept
