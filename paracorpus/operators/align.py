"""Aligner output, bead scoring and monotone alignment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.text import newline_to_space
from ..sources.files import stash
from .ids import dense_index

MIN_SCORE = 0.5
_LINE = r"^\[([0-9, \-]*)\]:\[([0-9, \-]*)\]:([+-]?[0-9.]+(?:[eE][+-]?[0-9]+)?)"


def expand_range(c, strict: bool = True) -> Column:
    """"" to [], "5" to [5], "2--4" to [2, 3, 4], "6, 7" to [6, 7]; a range that falls is empty.  Anything else is an error,
    or with ``strict`` off is left out."""
    def one(part):
        a, b = (F.regexp_extract(part, r"^([0-9]+)--([0-9]+)$", i).try_cast("long") for i in (1, 2))
        single = part.try_cast("long")
        none = F.array().cast("array<bigint>")
        odd = F.when(part == "", none).otherwise(F.raise_error(F.concat(F.lit("no index or range: "), part)).cast("array<bigint>")) if strict else none
        return F.when(a.isNotNull() & b.isNotNull(), F.when(a <= b, F.sequence(a, F.greatest(a, b))).otherwise(none)).when(single.isNotNull(), F.array(single)).otherwise(odd)

    return F.flatten(F.transform(F.split(c, r"\s*,\s*"), lambda p: one(F.trim(p))))


def parse_beads(lines: DataFrame, column: str = "line", kind: str = "similarity") -> DataFrame:
    """src_idx, tgt_idx and score of the lines that are beads; a cost becomes a similarity of 1 - cost."""
    if kind not in ("similarity", "cost"):
        raise ValueError(kind)
    score = F.regexp_extract(column, _LINE, 3).try_cast("double")
    return lines.where(F.col(column).rlike(_LINE)).withColumns({
        "src_idx": expand_range(F.regexp_extract(column, _LINE, 1)), "tgt_idx": expand_range(F.regexp_extract(column, _LINE, 2)),
        "score": score if kind == "similarity" else 1 - score}).drop(column)


def two_sided(beads: DataFrame) -> DataFrame:
    return beads.where((F.size("src_idx") > 0) & (F.size("tgt_idx") > 0))


def above(beads: DataFrame, least: float = MIN_SCORE) -> DataFrame:
    return beads.where(F.col("score") >= least)


def gather(beads: DataFrame, sentences: DataFrame, index: str, text: str, key: str = "bead") -> DataFrame:
    """``text``: the members' texts by place, joined by spaces; indices without a sentence are left out.
    ``text``_lines: their original indices, if ``sentences`` has a column ``original``, else their own."""
    original = F.col("original") if "original" in sentences.columns else F.col("idx")
    members = beads.select(key, F.posexplode(index).alias("_at", "idx"))
    joined = members.join(sentences.select("idx", "text", original.alias("_original")), "idx")
    per = joined.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_at", "text", "_original"))).alias("_m"))
    per = per.select(key, F.array_join(F.transform("_m", lambda m: m["text"]), " ").alias(text), F.transform("_m", lambda m: m["_original"]).alias(f"{text}_lines"))
    out = beads.join(per, key, "left")
    return out.withColumns({text: F.coalesce(text, F.lit("")), f"{text}_lines": F.coalesce(f"{text}_lines", F.array().cast("array<bigint>"))})


def dedup_keep_first(sentences: DataFrame, least: int = 3, side: list[str] | None = None, dedup: bool = True) -> DataFrame:
    """First place of each text of ``least`` characters or more, newlines turned to spaces; all places without ``dedup``, so
    that repeated formulae keep theirs before a monotone alignment."""
    side = side or []
    flat = sentences.select(*side, "idx", newline_to_space(F.col("text")).alias("text")).where(F.length("text") >= least)
    if not dedup:
        return flat
    return flat.groupBy(*side, "text").agg(F.min("idx").alias("idx"))


def aligner_input(sentences: DataFrame, least: int = 3, dedup: bool = True) -> DataFrame:
    """line, idx, text: what an outside aligner reads, numbered from 0 in idx order, with each line's own idx."""
    return dense_index(dedup_keep_first(sentences, least, dedup=dedup), "idx", ["idx"], "line").select(F.col("line").cast("long").alias("line"), "idx", "text")


def text_hash(c) -> Column:
    return F.xxhash64(c)


def with_embeddings(sentences: DataFrame, vectors: DataFrame, keys: tuple = ("idx",)) -> DataFrame:
    """``sentences`` with the embedding of their key and text: ``vectors`` carry ``text_hash`` of what was embedded, and a
    vector of another text is stale and does not join."""
    return sentences.withColumn("text_hash", text_hash(F.col("text"))).join(vectors, [*keys, "text_hash"]).drop("text_hash")


def stale(sentences: DataFrame, vectors: DataFrame, keys: tuple = ("idx",)) -> DataFrame:
    """The sentences without a vector of their present text."""
    return sentences.withColumn("text_hash", text_hash(F.col("text"))).join(vectors.select(*keys, "text_hash"), [*keys, "text_hash"], "left_anti").drop("text_hash")


def pair_entities(pairs: DataFrame, entities: DataFrame, index: str, name: str, key: str = "bead") -> DataFrame:
    """``pairs`` with ``name``: the distinct entities of the sentences that ``index`` names, in order; (idx, entity) rows."""
    members = pairs.select(key, F.explode(index).alias("idx"))
    per = members.join(entities.select("idx", "entity"), "idx").groupBy(key).agg(F.array_sort(F.collect_set("entity")).alias(name))
    return pairs.join(per, key, "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))


def bead_scores(beads: DataFrame, embeddings: DataFrame, key: str = "bead") -> DataFrame:
    """score: inner product of the two sides' mean vectors; cosine: the same made independent of length.
    Embeddings have (side, idx, embedding)."""
    def pooled(index: str, side: str, name: str):
        members = beads.select(key, F.explode(index).alias("idx"))
        vectors = members.join(embeddings.where(F.col("side") == side).select("idx", "embedding"), "idx")
        return vectors.groupBy(key).agg(V.mean_pool(F.transform(F.array_sort(F.collect_list(F.struct("idx", "embedding"))), lambda m: m["embedding"])).alias(name))

    both = beads.join(pooled("src_idx", "src", "_s"), key).join(pooled("tgt_idx", "tgt", "_t"), key)
    score = V.dot(F.col("_s"), F.col("_t"))
    return both.withColumn("score", score).withColumn("cosine", F.col("score") / (V.norm(F.col("_s")) * V.norm(F.col("_t")))).drop("_s", "_t")


def _best(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the k largest of each row, ranked by 12 decimals, ties to the first; a few rows at a time and
    without an order of the others."""
    k = min(k, d.shape[1])
    best = np.empty((len(d), k), np.int64)
    for at in range(0, len(d), 128):
        r = np.round(d[at : at + 128], 12)
        row = np.arange(len(r))
        if k > 8 or not np.isfinite(r).all():
            best[at : at + 128] = np.argsort(-r, axis=1, kind="stable")[:, :k]
            continue
        for n in range(k):
            best[at : at + 128, n] = top = r.argmax(1)
            r[row, top] = -np.inf
    return best, np.take_along_axis(d, best, 1)


def _products(src: DataFrame, tgt: DataFrame, k: int, block: int, back: bool = False) -> DataFrame:
    """back, idx, tgt_idx, score: the k best targets of each source in each pair of blocks, one matrix product a pair; with
    ``back`` also the k best sources of each target, from the same product."""
    n_src, n_tgt = (df.count() // block + 1 for df in (src, tgt))
    cut = lambda df, n, name: df.select("idx", "embedding", F.pmod(F.xxhash64("idx"), F.lit(n)).cast("int").alias(name))
    lists = lambda n: F.array(*[F.lit(i) for i in range(n)]) if n <= 64 else F.sequence(F.lit(0), F.lit(n - 1))
    left = cut(src, n_src, "a").withColumn("b", F.explode(lists(n_tgt)))
    right = cut(tgt, n_tgt, "b").withColumn("a", F.explode(lists(n_src)))

    def product(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        x, y = x.sort_values("idx"), y.sort_values("idx")
        kinds = {"back": "bool", "idx": "int64", "tgt_idx": "int64", "score": "float64"}
        if x.empty or y.empty:
            return pd.DataFrame({c: [] for c in kinds}).astype(kinds)
        d = np.stack(x.embedding.to_numpy()).astype(float) @ np.stack(y.embedding.to_numpy()).astype(float).T
        i, j = x.idx.to_numpy(), y.idx.to_numpy()
        best, score = _best(d, k)
        out = [pd.DataFrame({"back": False, "idx": np.repeat(i, best.shape[1]), "tgt_idx": j[best].ravel(), "score": score.ravel()})]
        if back:
            best, score = _best(np.ascontiguousarray(d.T), k)
            out.append(pd.DataFrame({"back": True, "idx": i[best].ravel(), "tgt_idx": np.repeat(j, best.shape[1]), "score": score.ravel()}))
        return pd.concat(out)

    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(product, "back boolean, idx long, tgt_idx long, score double")


def _ranked(near: DataFrame, of: str, other: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(of).orderBy(F.desc(F.round("score", 12)), other))
    return near.drop("back").withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(src: DataFrame, tgt: DataFrame, k: int, block: int = 2048) -> DataFrame:
    """idx, rank, tgt_idx, score: the k targets of largest inner product of each source.

    Sources and targets are cut into blocks and each pair of blocks is one matrix product; only the best
    k of a pair leave it.  Ties go to the smaller target."""
    return _ranked(_products(src, tgt, k, block), "idx", "tgt_idx", k)


def mutual_nearest(src: DataFrame, tgt: DataFrame, block: int = 2048) -> DataFrame:
    """Pairs that are each other's nearest; both directions come from one product."""
    near = stash(_products(src, tgt, 1, block, back=True), "nearest")
    forth = _ranked(near.where("not back"), "idx", "tgt_idx", 1).select(F.col("idx").alias("src_idx"), "tgt_idx", "score")
    back = _ranked(near.where("back"), "tgt_idx", "idx", 1).select("tgt_idx", F.col("idx").alias("src_idx"))
    return forth.join(back, ["src_idx", "tgt_idx"])


# -- monotone alignment -----------------------------------------------------------------------


def _pooled_prefix(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros((1, x.shape[1])), np.cumsum(x, 0)])


def align_segment(x: np.ndarray, y: np.ndarray, x_len=None, y_len=None, max_align: int = 5, skip: float = -0.1, band=None, margin: bool = False, length_penalty: bool = False):
    """Beads (i, a, j, b, score) of the best monotone alignment of two vector sequences.

    Each bead takes a and b rows with a + b <= max_align; its value is the inner product of mean vectors,
    less the mean similarity to the rows just outside it (margin) and scaled by how even the lengths are
    (length_penalty), times a + b so that large beads gain nothing by taking in weak rows.
    ``band``: for each row of x the (low, high) cells of y to visit.  A row of cells is one step of array
    operations, and only the last ``max_align`` rows and two bytes a visited cell are held."""
    n, m = len(x), len(y)
    px, py = _pooled_prefix(x), _pooled_prefix(y)
    sx, sy = (np.concatenate([[0], np.cumsum(v if v is not None else np.ones(k))]) for v, k in ((x_len, n), (y_len, m)))
    kinds = sorted(((a, b) for a in range(1, max_align) for b in range(1, max_align) if a + b <= max_align), key=lambda t: (t != (1, 1), sum(t), t))
    rows: dict[int, tuple[int, np.ndarray]] = {}
    steps: list[tuple[int, np.ndarray]] = []

    def cells(i: int, low: int, high: int) -> np.ndarray:
        """Values of row i from column low to high; unvisited ones are -inf."""
        out = np.full(high - low + 1, -np.inf)
        if i in rows:
            at, v = rows[i]
            a, b = max(low, at), min(high, at + len(v) - 1)
            if a <= b:
                out[a - low : b - low + 1] = v[a - at : b - at + 1]
        return out

    def scores(i: int, a: int, j: np.ndarray, b: int) -> np.ndarray:
        """Bead values, for columns j >= b, of rows i - a to i."""
        u, v = (px[i] - px[i - a]) / a, (py[j] - py[j - b]) / b
        s = v @ u
        if margin:
            around, count = np.zeros(len(j)), np.zeros(len(j))
            for k in (i - a - 1, i):
                if 0 <= k < n:
                    around, count = around + v @ x[k], count + 1
            for k in (j - b - 1, j):
                there = (k >= 0) & (k < m)
                around, count = around + np.where(there, y[np.clip(k, 0, m - 1)] @ u, 0.0), count + there
            s = s - around / np.maximum(count, 1)
        if length_penalty:
            p, q = sx[i] - sx[i - a], sy[j] - sy[j - b]
            s = np.where(s > 0, s * np.log2(1 + np.minimum(p, q) / np.maximum(np.maximum(p, q), 1e-9)), s)
        return s

    for i in range(n + 1):
        low, high = band[i] if band is not None else (0, m)
        low, high = max(0, low), min(m, high)
        j = np.arange(low, high + 1)
        best, how = np.full(len(j), -np.inf), np.zeros((len(j), 2), np.int8)
        if i == 0:
            best[j == 0] = 0.0
        for a, b in kinds:
            if a > i:
                continue
            from_ = cells(i - a, low - b, high - b)
            at = np.flatnonzero((j >= b) & (from_ > -np.inf))
            if len(at):
                v = from_[at] + scores(i, a, j[at], b) * (a + b)
                won = at[v > best[at] + 1e-12]
                best[won], how[won] = v[v > best[at] + 1e-12], (a, b)
        if i:
            v = cells(i - 1, low, high) + skip
            won = v > best + 1e-12
            best[won], how[won] = v[won], (1, 0)
        # runs of skipped targets: the best cell to the left, less what the way from it costs
        free = best - skip * j
        left = np.concatenate([[-np.inf], np.maximum.accumulate(free)[:-1]]) + skip * j if len(j) else best
        won = left > best + 1e-12
        best[won], how[won] = left[won], (0, 1)
        rows[i] = (low, best)
        rows.pop(i - max_align, None)
        steps.append((low, how))
    out, i, j = [], n, m
    while i or j:
        low, how = steps[i]
        a, b = map(int, how[j - low]) if 0 <= j - low < len(how) else (0, 0)
        if not (a or b):  # outside the band: skip to it
            a, b = (1, 0) if i else (0, 1)
        similarity = float((px[i] - px[i - a]) / a @ ((py[j] - py[j - b]) / b)) if a and b else 0.0
        out.append((i - a, a, j - b, b, similarity))
        i, j = i - a, j - b
    return out[::-1]


def increasing_chain(pairs: list[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """The heaviest chain of (i, j, weight) with i and j both rising."""
    pairs = sorted(pairs, key=lambda t: (t[0], -t[1]))
    size = max((j for _, j, _ in pairs), default=-1) + 2
    tree: list[tuple[float, int]] = [(0.0, -1)] * (size + 1)
    before = []
    for k, (_, j, w) in enumerate(pairs):
        best, at = (0.0, -1), j
        while at > 0:
            best = max(best, tree[at])
            at -= at & -at
        before.append(best[1])
        mine, at = (best[0] + max(w, 1e-9), k), j + 1
        while at <= size:
            tree[at] = max(tree[at], mine)
            at += at & -at
    best, at = (0.0, -1), size
    while at > 0:
        best = max(best, tree[at])
        at -= at & -at
    chain, k = [], best[1]
    while k >= 0:
        chain.append(pairs[k][:2])
        k = before[k]
    return chain[::-1]


def chain_band(chain: list[tuple[int, int]], n: int, m: int, win: int) -> list[tuple[int, int]]:
    """Cells within ``win`` of the path through a chain's points."""
    points = [(0, 0), *((i + 1, j + 1) for i, j in chain), (n, m)]
    centre = np.interp(np.arange(n + 1), [p[0] for p in points], [p[1] for p in points])
    low = np.minimum(np.floor(centre) - win, np.concatenate([[0], centre[:-1]]) - win)
    high = np.maximum(np.ceil(centre) + win, np.concatenate([centre[1:], [m]]) + win)
    return [(int(a), int(b)) for a, b in zip(low, high, strict=True)]


BEADS = "segment long, bead long, src_idx array<bigint>, tgt_idx array<bigint>, score double"


def align(sentences: DataFrame, passes: int = 1, max_align: int = 5, top: int = 3, win: int = 5, skip: float = -0.1, margin: bool = False, length_penalty: bool = False) -> DataFrame:
    """Beads of each segment of (segment, side, idx, embedding, length) rows.

    A segment is one group, so long texts are cut into segments at headings or anchors first; with
    two passes the dynamic programme only visits a band around the chain of the nearest targets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = [pdf[pdf.side == s].sort_values("idx") for s in ("src", "tgt")]
        x, y = (np.stack(s.embedding.to_numpy()).astype(float) if len(s) else np.zeros((0, 1)) for s in sides)
        if not len(x) or not len(y):
            x = np.zeros((len(x), 1)) if not len(x) or not len(y) else x
            y = np.zeros((len(y), 1))
        band = None
        if passes > 1 and len(x) and len(y):
            anchors = []
            for at in range(0, len(x), 256):  # a strip of the product at a time
                d = x[at : at + 256] @ y.T
                best = np.argsort(-d, axis=1, kind="stable")[:, :top]
                anchors += [(at + i, int(j), float(d[i, j])) for i in range(len(d)) for j in best[i]]
            band = chain_band(increasing_chain(anchors), len(x), len(y), win)
        beads = align_segment(x, y, *(s.length.to_numpy(float) for s in sides), max_align, skip, band, margin, length_penalty)
        ids = [s.idx.tolist() for s in sides]
        return pd.DataFrame([(int(pdf.segment.iloc[0]), k, ids[0][i : i + a], ids[1][j : j + b], s) for k, (i, a, j, b, s) in enumerate(beads)], columns=["segment", "bead", "src_idx", "tgt_idx", "score"])

    return sentences.groupBy("segment").applyInPandas(run, BEADS)
