"""The deliverable: flattened, filtered and numbered pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import flatten_ws
from ..sources.files import stash
from .ids import RANGE, dense_index

MAX_PAIR_CHARS = 2000


def verdict(most: int = MAX_PAIR_CHARS) -> Column:
    """empty, long or kept; the empty test comes first, and ``most`` = 0 switches the other off."""
    return _verdict(F.col("src"), F.col("tgt"), most)


def _verdict(src: Column, tgt: Column, most: int) -> Column:
    out = F.when((src == "") | (tgt == ""), "empty")
    if most:
        out = out.when((F.length(src) > most) | (F.length(tgt) > most), "long")
    return out.otherwise("kept")


def flattened(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({c: flatten_ws(F.coalesce(F.col(c), F.lit(""))) for c in ("src", "tgt")})


def deliverable(pairs: DataFrame, order: str, most: int = MAX_PAIR_CHARS, span: int = RANGE) -> DataFrame:
    """pair_id from 1, han_sentence, viet_sentence of the kept pairs in ``order``."""
    # written once: the verdict would else repeat the cleaning wherever the optimiser puts it
    kept = stash(flattened(pairs).select(order, "src", "tgt"), "flattened").where(verdict(most) == "kept")
    return dense_index(kept, order, [order], "pair_id", 1, written=True, span=span).select("pair_id", F.col("src").alias("han_sentence"), F.col("tgt").alias("viet_sentence"))


def drop_counts(pairs: DataFrame, most: int = MAX_PAIR_CHARS) -> DataFrame:
    """Counts of all outcomes in one pass."""
    # bound once a row, so that the verdict does not repeat the cleaning
    bound = F.transform(F.array(F.struct(*[flatten_ws(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("src", "tgt")])), lambda p: _verdict(p["src"], p["tgt"], most))[0]
    seen = pairs.select(bound.alias("v"))
    return seen.agg(F.count("*").alias("n_pairs"), *[F.count_if(F.col("v") == v).alias(f"n_{v}") for v in ("empty", "long", "kept")])
