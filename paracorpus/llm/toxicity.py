r"""Toxicity by class-conditional Kneser-Ney models (operator 10).

Two models, one of toxic and one of ordinary texts, predict each letter of a word, and its end, from the letters of the
word before it.  Each discounts its own counts and gives what that frees to a backoff that both share: Kneser-Ney's counts of
types, here how many different words of all documents go on with a letter.  The discount is ``RARE`` occurrences at every
size of the tables, so only expressions that are rarer have the shared probability in both classes.
A text's measure compares its log-likelihoods: the sum of its words' differences above ``MARGIN``, normalised for length by the
square root of the number of words, as chance differences grow.  A logistic curve fitted on other training rows makes it a
score between 0 and 1.

Counts cover all documents and all training labels.  All beginnings of words that pass the discount in a class have
probabilities of their own.  Words are dealt by their first letters, so each task has the whole model of its words; what leaves
it are the words above ``MARGIN``.  The ``NEAR`` most frequent of them are broadcast.  Texts are joined with all the others: of a
text only the hashes of words that may be among them travel.  One in ``CURVE`` of the training rows, at most about ``SAMPLE``,
is kept for the curve; all others are counted.  Every text is scored whole.

Defined cases: null, empty and word-free texts score the training rows' share of toxic rows; very long texts and words are
taken whole; null labels are not learnt from, and of several labels of a document the highest counts; without labelled
rows of both classes every score is that share (0 if there are none); repeated rows give repeated rows, and a labelled
document counts as often as it comes; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import os.path
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, parts, slabs, stash, text_or_empty

RARE, MARGIN = 3, 1.0
#: Words above the margin that are broadcast; texts are joined with the rest.
NEAR = 1 << 19
#: Distinct words of one part of the model.
A_PART = 200_000
#: Rows that fit the curve, and of the training rows at most one in so many is kept for it.
SAMPLE, CURVE = 12_000, 4
#: Bits of the bitmap that keeps unlabelled texts from moving.
MARKS = 1 << 24
_WORDS = re.compile(r"[^\W\d_]+")
#: The same for texts of Latin-1 characters alone: what is no letter becomes a space.
_LATIN = bytes(c if _WORDS.fullmatch(chr(c)) else 32 for c in range(256))
#: Stands behind the last letter.
END = "\x03"
#: Letters that decide which task counts a beginning; shorter beginnings are summed over tasks.
SHORT = 3
#: Distinct words that a task holds before it passes them on.
HELD = 400_000
WORDS = "word string, ordinary long, toxic long"
BEGINNINGS = "beginning string, ordinary long, toxic long, words long"


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    low = text.lower()
    try:
        return low.encode("latin-1").translate(_LATIN).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORDS.findall(low)


def _first_keys(n: int) -> np.ndarray:
    return np.full(n, 0x9AE16A3B2F90404F, np.uint64)


def _next_keys(keys: np.ndarray, letters: np.ndarray) -> np.ndarray:
    h = (keys ^ (letters.astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All letters, and each word's first place and length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4"), np.cumsum(sizes) - sizes, sizes


def _keys(words: list[str]) -> np.ndarray:
    """A hash of each word."""
    letters, first, sizes = _letters(words)
    keys, active, j = _first_keys(len(words)), np.flatnonzero(sizes > 0), 0
    while len(active):
        keys[active] = _next_keys(keys[active], letters[first[active] + j])
        j += 1
        active = active[sizes[active] > j]
    return keys


class Scorer:
    """Scores of texts from the excess of their words over the margin."""

    slope, middle, share = 0.0, 0.0, 0.0

    def excess(self, words: list[str]) -> np.ndarray:
        raise NotImplementedError

    def far(self, words: list[str]) -> np.ndarray | None:
        """The hash of each word whose excess may have to be joined, 0 for the others; None if there are no such words."""
        return None

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list | None]:
        """The excess and the number of words of each text, and the hashes of those that are to be joined."""
        known: dict[str, int] = {}
        lists = [[known.setdefault(w, len(known)) for w in words_of(t)] for t in texts]
        words, sizes = list(known), np.array([len(x) for x in lists], np.int64)
        excess, far = self.excess(words), self.far(words)
        ids = np.fromiter((i for x in lists for i in x), np.int64, int(sizes.sum()))
        of = np.repeat(np.arange(len(texts)), sizes)
        total = np.bincount(of, excess[ids], len(texts)) if len(ids) else np.zeros(len(texts))
        if far is None:
            return total, sizes, None
        asked = far[ids]
        counts = np.bincount(of[asked != 0], minlength=len(texts))
        return total, sizes, np.split(asked[asked != 0], np.cumsum(counts)[:-1]) if len(texts) else []

    def measures(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The measure and the number of words of each text."""
        total, sizes, _ = self.sums(texts)
        return total / np.sqrt(np.maximum(sizes, 1)), sizes

    def score(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        if not self.slope:
            return np.full(len(x), self.share)
        return np.where(n > 0, 1 / (1 + np.exp(-np.clip(self.slope * (x - self.middle), -30, 30))), self.share)

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.score(*self.measures(texts))


class Model(Scorer):
    """For each kept beginning, by a hash of it: the difference of the classes' log-probabilities of its last letter, and that
    of a next letter that no class has kept."""

    def __init__(self, counts, discounts: tuple[float, float]):
        """``counts`` has the columns of BEGINNINGS: those that pass a discount, and the empty one."""
        names = counts["beginning"].tolist()
        at = {x: i for i, x in enumerate(names)}
        c = np.stack([counts["ordinary"].to_numpy(float), counts["toxic"].to_numpy(float)])
        types = counts["words"].to_numpy(float)
        last = np.array([i for i, x in enumerate(names) if x], np.int64)
        before = np.array([at[names[i][:-1]] for i in last.tolist()], np.int64)
        over = np.maximum(c - np.array(discounts)[:, None], 0)
        own, total = over[:, last], c[:, before]
        kept = np.stack([np.bincount(before, x, len(names)) for x in own])
        left = np.where(c > 0, 1 - kept / np.maximum(c, 1), 1.0)
        p = np.where(total > 0, own / np.maximum(total, 1), 0.0) + left[:, before] * (types[last] / types[before])
        self.gain, self.rest = np.zeros(len(names)), np.log(np.maximum(left[1], 1e-12)) - np.log(np.maximum(left[0], 1e-12))
        self.gain[last] = np.log(np.maximum(p[1], 1e-30)) - np.log(np.maximum(p[0], 1e-30))
        keys = _keys(names)
        order = np.argsort(keys)
        self.keys, self.gain, self.rest = keys[order], self.gain[order], self.rest[order]

    def ratios(self, words: list[str]) -> np.ndarray:
        """Difference of the log-likelihoods of each word."""
        out = np.zeros(len(words))
        if not len(self.keys):
            return out
        find = lambda k: np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        letters, first, sizes = _letters([w + END for w in words])
        active, keys = np.arange(len(words)), _first_keys(len(words))
        before = find(keys)
        active, j = active[self.keys[before] == keys], 0
        while len(active):  # what follows a beginning that is not kept has the shared probability
            keys[active] = _next_keys(keys[active], letters[first[active] + j])
            at = find(keys[active])
            known = self.keys[at] == keys[active]
            out[active] += np.where(known, self.gain[at], self.rest[before[active]])
            before[active] = at
            j += 1
            active = active[known & (sizes[active] > j)]
        return out

    def excess(self, words: list[str]) -> np.ndarray:
        return np.maximum(self.ratios(words) - MARGIN, 0)


class Words(Scorer):
    """The words above the margin: the most frequent ones here, a frame of the rest and a bitmap of their hashes."""

    def __init__(self, keys: np.ndarray, excess: np.ndarray, rest: DataFrame | None = None, marks: np.ndarray | None = None):
        order = np.argsort(keys)
        self.keys, self.values, self.rest, self.marks = keys[order], excess[order], rest, marks

    def __getstate__(self):  # a frame stays on the driver
        return self.__dict__ | {"rest": None}

    def _found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, self.values[at]

    def excess(self, words: list[str]) -> np.ndarray:
        known, values = self._found(_keys(words).view(np.int64))
        return np.where(known, values, 0.0)

    def far(self, words: list[str]) -> np.ndarray | None:
        if self.marks is None:
            return None
        keys = _keys(words).view(np.int64)
        place = keys & (8 * len(self.marks) - 1)
        marked = self.marks[place >> 3] >> (place & 7) & 1 == 1
        return np.where(marked & ~self._found(keys)[0], keys, 0)


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def training_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic boolean, curve) of the labelled documents that are not held out; about ``sample`` at most are for the curve."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    each = usable.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    quarter = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(CURVE)) == 0
    some = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < (1 << 20) * min(1.0, sample / max(1, each.where(quarter).count()))
    return each.withColumn("curve", quarter & some)


def _perhaps(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id ``ids`` may have: a bitmap of hashes, of fixed size, tells before texts move."""
    place = (F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)) + 1).alias("h")
    marks = ids.select(place).groupBy(F.expr("bitmap_bucket_number(h)").alias("_bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("_bits"))
    near = docs.withColumn("_h", place).withColumn("_bucket", F.expr("bitmap_bucket_number(_h)")).join(F.broadcast(marks), "_bucket")
    byte = "cast(conv(hex(substring(_bits, cast(bitmap_bit_position(_h) div 8 as int) + 1, 1)), 16, 10) as int)"
    return near.where(F.expr(f"{byte} & shiftleft(1, cast(bitmap_bit_position(_h) % 8 as int)) <> 0")).select(*docs.columns)


def word_counts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """WORDS of every task, to be summed: occurrences by class in the documents that ``known`` has for counting; words of
    other documents have none, but are there."""

    def run(batches):
        held = (Counter(), Counter(), set())

        def passed():
            words = list(held[0].keys() | held[1].keys() | held[2])
            columns = [words, [held[0][w] for w in words], [held[1][w] for w in words]]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["word", "ordinary", "toxic"])
            for x in held:
                x.clear()
            return batch

        for batch in batches:
            for text, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[kind].update(words_of(text))
                if sum(map(len, held)) > HELD:
                    yield passed()
        yield passed()

    counted = known.where("not curve").select("doc_id", F.col("toxic").cast("int").alias("kind"))
    labelled = _perhaps(docs.select("doc_id", text_or_empty().alias("text")), counted).hint("shuffle_merge").join(counted.hint("shuffle_merge"), "doc_id")
    rows = labelled.select("text", "kind").unionByName(docs.select(text_or_empty().alias("text"), F.lit(2).alias("kind")))
    return rows.mapInArrow(run, WORDS)


def beginnings(words: DataFrame, discounts: tuple[float, float]) -> DataFrame:
    """BEGINNINGS that pass a discount, and the empty one, with the occurrences and the number of the words that begin so.

    Words are sorted, so the beginnings of one word are a stack, and each is complete when the next word leaves it."""

    def run(batches):
        stack, before, out = [[0, 0, 0]], "", []

        def leave(depth: int) -> None:
            while len(stack) > depth + 1:
                counts = stack.pop()
                if len(stack) < SHORT or counts[0] > discounts[0] or counts[1] > discounts[1]:
                    out.append((before[: len(stack)], *counts))
                for i in range(3):
                    stack[-1][i] += counts[i]

        def batch_of():
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["beginning", "ordinary", "toxic", "words"])

        for batch in batches:
            for word, ordinary, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                word += END
                if word != before:
                    same = len(os.path.commonprefix((before, word)))
                    leave(same)
                    stack += [[0, 0, 0] for _ in range(len(word) - same)]
                    stack[-1][2] = 1
                    before = word
                stack[-1][0] += ordinary
                stack[-1][1] += toxic
            if len(out) > 20_000:
                yield batch_of()
                out = []
        leave(0)
        out.append(("", *stack[0]))
        yield batch_of()

    dealt = words.repartition(parts(words.sparkSession), F.substring("word", 1, SHORT)).sortWithinPartitions("word")
    every = dealt.mapInArrow(run, BEGINNINGS).groupBy("beginning").agg(*[F.sum(c).alias(c) for c in ("ordinary", "toxic", "words")])
    return every.where(f"beginning = '' or ordinary > {discounts[0]!r}D or toxic > {discounts[1]!r}D")


def excesses(words: DataFrame, discounts: tuple[float, float]) -> DataFrame:
    """key, excess and occurrences of every distinct word that is above the margin; ``words`` are distinct.

    A word's ratio needs its own beginnings, their nearest relatives and the beginnings of up to ``SHORT`` letters.  The last
    are few and go to all tasks; the others are dealt by their first letters, like the words."""
    begun = stash(beginnings(words, discounts), "beginnings")
    n_parts = max(parts(words.sparkSession), words.count() // A_PART + 1)
    dealt = lambda c: F.pmod(F.xxhash64(F.substring(c, 1, SHORT)), F.lit(n_parts)).alias("part")
    short = words.sparkSession.sparkContext.broadcast(begun.where(F.length("beginning") <= SHORT).toPandas())
    long = begun.where(F.length("beginning") > SHORT).select("*", dealt("beginning"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = left.column("word").to_pylist()
        model = Model(pd.concat([short.value, right.drop_columns(["part"]).to_pandas()], ignore_index=True), discounts)
        excess, counts = model.excess(names), left.column("c").to_numpy()
        at = np.flatnonzero(excess > 0)
        return pa.table([pa.array(_keys([names[i] for i in at.tolist()]).view(np.int64)), pa.array(excess[at], pa.float64()), pa.array(counts[at], pa.int64())], names=["key", "excess", "c"])

    each = words.select("word", (F.col("ordinary") + F.col("toxic")).alias("c"), dealt(F.concat("word", F.lit(END))))
    return each.groupBy("part").cogroup(long.groupBy("part")).applyInArrow(run, "key long, excess double, c long")


def nearest_and_rest(above: DataFrame, near: int) -> Words:
    """The ``near`` most frequent words to broadcast, and all others as a frame with a bitmap."""
    above = stash(above, "above")
    n = above.count()
    top = above.orderBy(F.desc("c"), "key").limit(near).toPandas() if n > near else above.select("key", "excess").toPandas()
    keys, excess = top["key"].to_numpy(np.int64), top["excess"].to_numpy(float)
    if n <= near:
        return Words(keys, excess)
    rest = above
    if len(top):
        c, key = (int(top[x].iloc[-1]) for x in ("c", "key"))
        rest = above.where(f"c < {c} or c = {c} and key > {key}")
    # some 16 bits a word; at the largest size more words are asked for in vain, but none is missed
    size = 1 << min(28, max(20, (16 * n).bit_length()))
    place = F.col("key").bitwiseAND(F.lit(size - 1)) + 1
    marks = rest.select(place.alias("h")).groupBy(F.expr("bitmap_bucket_number(h)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("bits"))
    held = np.zeros(size // 8, np.uint8)
    for r in marks.toLocalIterator():
        held[4096 * (r.b - 1) : 4096 * r.b] = np.frombuffer(r.bits, np.uint8)
    return Words(keys, excess, rest.select("key", "excess"), held)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rare: float = RARE, near: int | None = None) -> Words:
    known = stash(training_labels(labels, sample), "known")
    words = stash(word_counts(docs, known).groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "words")
    model = nearest_and_rest(excesses(words, (float(rare), float(rare))), NEAR if near is None else near)
    model.share = float(known.agg(F.avg(F.col("toxic").cast("int"))).first()[0] or 0)
    _fit(model, docs, known)
    return model


def measured(rows: DataFrame, model: Scorer) -> DataFrame:
    """``rows``, whose last column is a text, with measure x and number of words n in place of it."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = rows.columns[:-1]
    joined = isinstance(model, Words) and model.rest is not None

    def run(batches):
        for batch in batches:
            for a, b in slabs(texts := batch.column(len(kept)).to_pylist()):
                total, n, far = shared.value.sums(texts[a:b])
                x = total if joined else total / np.sqrt(np.maximum(n, 1))
                more = [pa.array(far, pa.list_(pa.int64()))] if joined else []
                yield pa.RecordBatch.from_arrays([*(batch.column(i)[a:b] for i in range(len(kept))), pa.array(x, pa.float64()), pa.array(n, pa.int64()), *more], [*kept, "x", "n", *["far"] * joined])

    schema = ", ".join([*(f"{c} {k}" for c, k in rows.dtypes[:-1]), "x double", "n long", *["far array<long>"] * joined])
    found = rows.mapInArrow(run, schema)
    if not joined:
        return found
    found = stash(found.withColumn("row", F.monotonically_increasing_id()), "measured")
    more = found.select("row", F.explode("far").alias("key")).join(model.rest, "key").groupBy("row").agg(F.sum("excess").alias("more"))
    x = (F.col("x") + F.coalesce("more", F.lit(0.0))) / F.sqrt(F.greatest("n", F.lit(1)))
    return found.drop("far").join(more, "row", "left").select(*kept, x.alias("x"), "n")


def _fit(model: Scorer, docs: DataFrame, known: DataFrame) -> None:
    """Slope and middle of the logistic curve, from rows that were not counted."""
    # the sample's size is bounded, so its keys may be broadcast
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(known.where("curve").select("doc_id", "toxic")), "doc_id").select("toxic", "text")
    got = measured(rows, model).where("n > 0").toPandas()
    x, y = got["x"].to_numpy(float), got["toxic"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return
    mean, scale = x.mean(), x.std() or 1.0
    z = np.stack([(x - mean) / scale, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (q * (1 - q))[:, None]).T @ z + 1e-3 * np.eye(2)
        w += np.linalg.solve(hessian, z.T @ (y - q) - 1e-3 * w)
    w[0] = max(w[0], 1e-6)
    model.slope, model.middle = w[0] / scale, mean - w[1] / w[0] * scale


def scored(docs: DataFrame, model: Scorer) -> DataFrame:
    """doc_id, held_out, score and predicted of every text."""
    rows = measured(docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), text_or_empty().alias("text")), model)
    if model.slope:
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(float(model.slope)) * (F.col("x") - F.lit(float(model.middle)))))
        score = F.when(F.col("n") > 0, 1 / (1 + F.exp(-z))).otherwise(F.lit(float(model.share)))
    else:
        score = F.lit(float(model.share))
    return rows.withColumn("score", score).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
