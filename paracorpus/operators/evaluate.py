"""Evaluation: score summaries, samples, agreement, overlap and error rates, entities."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS_CHARS
from .distance import distances

#: Upper edges of the score bins.
EDGES = (0.2, 0.5, 0.7, 0.9)


def score_bin(score) -> Column:
    out = F.lit(len(EDGES))
    for i in reversed(range(len(EDGES))):
        out = F.when(score < EDGES[i], i).otherwise(out)
    return out


def score_summary(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count("*").alias("n_pairs"), F.avg("score").alias("mean"), F.expr("percentile(score, 0.5)").alias("median"), F.stddev_samp("score").alias("stdev"))


def stratified(pairs: DataFrame, key: str, sizes: dict[str, int]) -> DataFrame:
    """A fixed number of rows a stratum (low under 0.5, mid under 0.7, high), chosen by hash, the same each time."""
    stratum = F.when(F.col("score") < 0.5, "low").when(F.col("score") < 0.7, "mid").otherwise("high")
    rank = F.row_number().over(Window.partitionBy("stratum").orderBy(F.md5(F.col(key).cast("string")), key))
    most = F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(v))])
    # the literal bound lets each task keep no more than the largest stratum before rows move
    ranked = pairs.withColumn("stratum", stratum).withColumn("_r", rank).where(F.col("_r") <= max(sizes.values()))
    return ranked.where(F.col("_r") <= most[F.col("stratum")]).drop("_r")


def holdout(pairs: DataFrame, key: str, seed: int = 42, tests: int = 20) -> DataFrame:
    """part: test for the rows whose seeded hash falls under ``tests`` per cent, train for the rest."""
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long") % 100
    return pairs.withColumn("part", F.when(place < tests, "test").otherwise("train"))


def krippendorff_ordinal(ratings: DataFrame) -> DataFrame:
    """criterion, alpha of (criterion, unit, rater, value) rows; null if no unit has two ratings.

    Coincidences are counted by value within each unit, so units of many raters need no pairs; ordinal
    distances come from the marginal counts of the values in between."""
    per = ratings.where("value is not null").groupBy("criterion", "unit", "value").agg(F.count("*").alias("n"))
    m = Window.partitionBy("criterion", "unit")
    per = per.withColumn("m", F.sum("n").over(m)).where("m > 1")
    a, b = per.alias("a"), per.alias("b")
    same = (F.col("a.criterion") == F.col("b.criterion")) & (F.col("a.unit") == F.col("b.unit"))
    pairs = a.join(b, same).select(F.col("a.criterion").alias("criterion"), F.col("a.value").alias("c"), F.col("b.value").alias("k"), (F.col("a.n") * (F.col("b.n") - F.when(F.col("a.value") == F.col("b.value"), 1).otherwise(0)) / (F.col("a.m") - 1)).alias("o"))
    seen = pairs.groupBy("criterion", "c", "k").agg(F.sum("o").alias("o"))
    marginal = per.groupBy("criterion", "value").agg(F.sum("n").cast("double").alias("n"))
    total = marginal.groupBy("criterion").agg(F.sum("n").alias("total"))
    up = marginal.withColumn("upto", F.sum("n").over(Window.partitionBy("criterion").orderBy("value")))
    x, y = up.alias("x"), up.alias("y")
    both = x.join(y, F.col("x.criterion") == F.col("y.criterion")).select(
        F.col("x.criterion").alias("criterion"), F.col("x.value").alias("c"), F.col("y.value").alias("k"), (F.col("x.n") * F.col("y.n")).alias("nn"),
        # counts from the lower value to the higher, each end half
        (F.abs(F.col("x.upto") - F.col("y.upto")) + F.signum(F.col("y.value") - F.col("x.value")) * (F.col("x.n") - F.col("y.n")) / 2).alias("span"))
    both = both.withColumn("d", F.pow("span", F.lit(2)))
    sums = both.join(seen, ["criterion", "c", "k"], "left").groupBy("criterion").agg(F.sum(F.coalesce("o", F.lit(0.0)) * F.col("d")).alias("do"), F.sum(F.col("nn") * F.col("d")).alias("de"))
    got = sums.join(total, "criterion").select("criterion", F.when(F.col("de") == 0, 1.0).otherwise(1 - (F.col("total") - 1) * F.col("do") / F.col("de")).alias("alpha"))
    return ratings.select("criterion").distinct().join(got, "criterion", "left")


def _items(hypothesis, reference) -> tuple[np.ndarray, int]:
    """Numbers of the items of both sides, one behind the other, and how many different ones there are; sides are texts,
    arrays of numbers or lists."""
    if isinstance(hypothesis, str) and isinstance(reference, str):
        item = np.frombuffer((hypothesis + reference).encode("utf-32-le", "surrogatepass"), np.uint32)
        most = int(item.max(initial=0)) + 1
        if most <= 1 << 16:  # numbered by a table
            seen = np.zeros(most, bool)
            seen[item] = True
            return (np.cumsum(seen) - 1)[item], int(np.count_nonzero(seen))
    elif isinstance(hypothesis, np.ndarray):
        item = np.concatenate([hypothesis, reference])
    else:
        known: dict = {}
        item = np.fromiter((known.setdefault(x, len(known)) for side in (hypothesis, reference) for x in side), np.int64, len(hypothesis) + len(reference))
        return item, len(known)
    distinct, item = np.unique(item, return_inverse=True)
    return item, len(distinct)


def _clipped(h: np.ndarray, r: np.ndarray) -> int:
    """The sum over all numbers of how often they are in both: a run of equal numbers, sides in turn, in one sorted array."""
    both = np.concatenate([h << 1, (r << 1) | 1])
    both.sort()
    first = np.flatnonzero(np.concatenate([[True], (both[1:] ^ both[:-1]) > 1])) if len(both) else np.zeros(0, np.int64)
    if not len(first):
        return 0
    of_r = np.add.reduceat(both & 1, first)
    return int(np.minimum(np.diff(first, append=len(both)) - of_r, of_r).sum())


def clipped_matches(hypothesis, reference, orders) -> list[tuple[int, int, int, int]]:
    """(order, clipped matches, hypothesis and reference n-grams) of two sequences.

    An n-gram is named by the digits of its items while they fit 62 bits, then by the rank of (the (n-1)-gram before it, its
    last item), so names are exact."""
    item, distinct = _items(hypothesis, reference)
    item, cut, out = item.astype(np.int64), len(hypothesis), []
    bits = max(1, int(distinct - 1).bit_length()) if distinct else 1
    name, held = [item[:cut], item[cut:]], bits  # element i stands for the n-gram that begins there
    for n in range(1, max(orders) + 1):
        if n > 1:
            if held + bits > 62:
                ranks = np.unique(np.concatenate(name), return_inverse=True)[1]
                name, held = [ranks[: len(name[0])], ranks[len(name[0]) :]], max(1, len(ranks).bit_length())
            name = [(x[:-1] << bits) | side[n - 1 :] for x, side in zip(name, (item[:cut], item[cut:]), strict=True)]
            held += bits
        if n in orders:
            out.append((n, _clipped(*name), len(name[0]), len(name[1])))
    return out


def _sides(hypothesis: pa.Array, reference: pa.Array):
    """The rows of both columns: texts as they are, lists as arrays of numbers of their items."""
    if not pa.types.is_list(hypothesis.type) or not pa.types.is_list(reference.type):
        return ([x or "" for x in c.to_pylist()] for c in (hypothesis, reference))
    numbers = pa.concat_arrays([hypothesis.flatten(), reference.flatten()]).dictionary_encode("encode").indices.to_numpy()
    ends = np.cumsum(np.concatenate([c.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for c in (hypothesis, reference)]), dtype=np.int64)
    rows = np.split(numbers, ends[:-1]) if len(ends) else []
    return rows[: len(hypothesis)], rows[len(hypothesis) :]


def ngram_matches(pairs: DataFrame, hypothesis, reference, orders) -> DataFrame:
    """order, matched (clipped), hyp and ref n-gram counts over the corpus.  Both sides of a pair lie in one row, so n-grams
    are counted there and only four numbers an order leave a task."""
    orders = tuple(orders)

    def run(batches):
        total = {n: [0, 0, 0] for n in orders}
        for batch in batches:
            for h, r in zip(*_sides(batch.column(0), batch.column(1)), strict=True):
                for n, *counts in clipped_matches(h, r, orders):
                    total[n] = [x + y for x, y in zip(total[n], counts, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), *(pa.array(c, pa.int64()) for c in zip(*total.values(), strict=True))], ["order", "matched", "hyp", "ref"])

    each = pairs.select(hypothesis.alias("h"), reference.alias("r")).mapInArrow(run, "order int, matched long, hyp long, ref long")
    return each.groupBy("order").agg(*[F.sum(c).alias(c) for c in ("matched", "hyp", "ref")])


def bleu(pairs: DataFrame, hypothesis, reference, most: int = 4) -> DataFrame:
    """Corpus BLEU (0 to 100) of arrays of words, with the brevity penalty; 0 if an order has no match."""
    m = ngram_matches(pairs, hypothesis, reference, range(1, most + 1))
    logs = m.agg(F.sum(F.when(F.col("matched") > 0, F.log(F.col("matched") / F.col("hyp")))).alias("l"), F.count_if(F.col("matched") > 0).alias("n"), F.sum(F.when(F.col("order") == 1, F.col("hyp"))).alias("c"), F.sum(F.when(F.col("order") == 1, F.col("ref"))).alias("r"))
    return logs.select(F.when(F.col("n") < most, 0.0).otherwise(100 * F.exp(F.col("l") / most) * F.when(F.col("c") >= F.col("r"), 1.0).otherwise(F.exp(1 - F.col("r") / F.col("c")))).alias("bleu"))


def chrf(pairs: DataFrame, hypothesis, reference, most: int = 6, beta: float = 2.0) -> DataFrame:
    """Corpus chrF (0 to 100) of texts without white space: F score of mean character n-gram precision and recall."""
    chars = lambda c: F.translate(c, WS_CHARS, "")
    m = ngram_matches(pairs, chars(hypothesis), chars(reference), range(1, most + 1)).where("hyp > 0 and ref > 0")
    means = m.agg(F.avg(F.col("matched") / F.col("hyp")).alias("p"), F.avg(F.col("matched") / F.col("ref")).alias("r"))
    b = beta * beta
    return means.select(F.when(F.col("p") + F.col("r") > 0, 100 * (1 + b) * F.col("p") * F.col("r") / (b * F.col("p") + F.col("r"))).otherwise(0.0).alias("chrf"))


def cer(pages: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """Character errors, characters and rate of (keys, text) pages that have a gold page of the same keys.  The distances are
    exact; their cost follows the errors of a page, not the square of its length."""
    both = pages.select(*keys, F.coalesce("text", F.lit("")).alias("h")).join(gold.select(*keys, F.coalesce("text", F.lit("")).alias("g")), keys)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                h, g = (batch.column(i).to_pylist() for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array([int(distances(h, g).sum())], pa.int64()), pa.array([sum(map(len, g))], pa.int64())], ["errors", "chars"])

    got = both.select("h", "g").mapInArrow(run, "errors long, chars long").agg(F.sum("errors").alias("errors"), F.sum("chars").alias("chars"))
    return got.withColumn("cer", F.when(F.col("chars") > 0, F.col("errors") / F.col("chars")))


def model_scores(ratings: DataFrame) -> DataFrame:
    """model, n_criteria and mean_alpha: the mean agreement over the criteria of each judged model's ratings, which have a
    column ``model`` beside those of ``krippendorff_ordinal``."""
    named = ratings.withColumn("criterion", F.struct("model", "criterion"))
    alpha = krippendorff_ordinal(named).select("criterion.model", "alpha")
    return alpha.groupBy("model").agg(F.count("*").alias("n_criteria"), F.avg("alpha").alias("mean_alpha"))


def markdown_report(facts: DataFrame) -> DataFrame:
    """report: one-row ``facts`` as a table of names and values."""
    line = lambda c: F.concat(F.lit(f"| {c} | "), F.coalesce(F.col(c).cast("string"), F.lit("–")), F.lit(" |"))
    return facts.select(F.concat_ws("\n", F.lit("| metric | value |"), F.lit("|-|-|"), *[line(c) for c in facts.columns]).alias("report"))


def spell_fix(words: DataFrame, lexicon: DataFrame, most: int = 2) -> DataFrame:
    """word, fixed: the nearest lexicon word within ``most`` edits, ties to the more frequent and then the smaller.

    Two words within d edits share one of d + 1 pieces of the longer's even cut only up to shifts, so
    blocks are all strings left by deleting up to ``most`` letters from a short prefix; these keys meet
    for every pair in reach, and the distance is then checked."""
    def deletions(c):
        prefix = F.substring(c, 1, 7)
        drop = lambda arr: F.array_distinct(F.concat(arr, F.flatten(F.transform(arr, lambda s: F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: F.concat(F.left(s, i - 1), F.substr(s, i + 1)))).otherwise(F.array().cast("array<string>"))))))
        out = F.array(prefix)
        for _ in range(most):
            out = drop(out)
        return out

    left = words.select("word", F.explode(deletions(F.col("word"))).alias("k"))
    right = lexicon.select(F.col("word").alias("fixed"), "n", F.explode(deletions(F.col("word"))).alias("k"))
    near = left.join(right, "k").select("word", "fixed", "n").distinct().withColumn("d", F.levenshtein("word", "fixed")).where(F.col("d") <= most)
    rank = F.row_number().over(Window.partitionBy("word").orderBy("d", F.desc("n"), "fixed"))
    return near.withColumn("_r", rank).where("_r = 1").select("word", "fixed")


def transliterate(c, table: dict[str, str]) -> Column:
    """Characters through a small table, joined by spaces; others stay."""
    m = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])
    return F.array_join(F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.coalesce(m[x], x)), " ")


def entity_matches(han, viet) -> Column:
    """Structs (han, viet) of entities whose transliteration and text contain each other, case aside.
    ``han`` has (text, sound) structs, ``viet`` strings."""
    met = lambda h, v: F.lower(v).contains(F.lower(h["sound"])) | F.lower(h["sound"]).contains(F.lower(v))
    return F.flatten(F.transform(han, lambda h: F.transform(F.filter(viet, lambda v: met(h, v)), lambda v: F.struct(h["text"].alias("han"), v.alias("viet")))))
