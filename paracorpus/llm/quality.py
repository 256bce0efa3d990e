r"""Quality rules (operator 5): a threshold table compiled into one Spark projection.

All measures are SQL expressions over the text column; no user function, no shuffle.  Arrays that several
expressions need are bound once with a one-element ``transform``, so the optimiser cannot repeat them.
Repeated five-word windows are found with a hash set; only texts that have some sort their windows.

Defined cases: a null or empty text has no words, fails the base rule and is not kept; very long texts are measured
whole; repeated rows give repeated rows; an empty table gives no rows; ``quality_filter`` returns all columns of its input, whatever
their names, and ``op5`` only its own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the be to of and that have with in is it for on as was by at this from not are or he they which "
    "le la les de des du et un une est que qui dans pour par sur il elle ne pas au se en ce "
    "der die das und ist von zu mit den dem ein eine auf im nicht sich als ich er sie es wie "
    "el los las y una con del no lo su al más como pero sus a"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if ``low <= measure <= high``."""

    name: str
    measure: str
    low: float
    high: float


#: Ratios are by word unless named otherwise.  Shortness alone never fails here: few words make ratios coarse.
RULES = (
    Rule("mean_word_length", "word_chars / greatest(n_words, 1)", 2.0, 12.0),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", 0.0, 0.1),
    Rule("exclamations", "n_exclaims / greatest(n_words, 1)", 0.0, 0.3),
    Rule("alphabetic_words", "1.0 - n_unlettered / greatest(n_words, 1)", 0.6, 1.0),
    Rule("stop_words", "n_stop / greatest(n_words, 1)", 0.04, 1.0),
    Rule("capitals", "n_upper / greatest(word_chars, 1)", 0.0, 0.4),
    Rule("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", 0.0, 0.5),
)


def _literal(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_WORDS = r"array_remove(split(translate(t, '\t\n\u000b\u000c\r', '     '), ' ', -1), '')"
#: Starts of the windows of ``s``, sorted (window, place) structs, whose window occurs twice or more.
_STARTS = "sort_array(filter(transform(s, (e, i) -> if(get(s, i - 1).w = e.w or get(s, i + 1).w = e.w, e.i, null)), x -> x is not null))"
_COVERED = f"aggregate({_STARTS}, named_struct('n', 0, 'end', 0), (a, x) -> named_struct('n', a.n + 5 - greatest(0, a.end - x), 'end', x + 5), a -> a.n)"
_WINDOWS = "transform(slice(w, 1, greatest(size(w) - 4, 0)), (x, i) -> concat_ws(' ', slice(w, i + 1, 5)))"
#: Equal windows have equal hashes, so a text without equal hashes has no equal windows; the others build them.
_HASHES = "transform(slice(w, 1, greatest(size(w) - 4, 0)), (x, i) -> xxhash64(x, get(w, i + 1), get(w, i + 2), get(w, i + 3), get(w, i + 4)))"
_SORTED = f"transform(array(sort_array(transform({_WINDOWS}, (x, i) -> named_struct('w', x, 'i', i)))), s -> {_COVERED})[0]"
_REPEATED = f"transform(array({_HASHES}), v -> if(size(array_distinct(v)) = size(v), 0, {_SORTED}))[0]"
_LINES = r"filter(split(t, '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')"
_MEASURES = f"""transform(array({_WORDS}), w -> named_struct(
    'n_words', cast(size(w) as bigint),
    'n_repeat_words', cast({_REPEATED} as bigint),
    'n_stop', size(filter(w, x -> lower(x) in ({_literal(STOP_WORDS)}))),
    'n_unlettered', size(filter(w, x -> not x rlike '\\\\p{{L}}'))))[0]"""
_LINE_COUNTS = f"transform(array({_LINES}), x -> named_struct('n', size(x), 'd', cast(size(x) - size(array_distinct(x)) as bigint)))[0]"


def _measures_sql(column: str) -> str:
    """One struct of all measures of a text column, which is bound once."""
    return f"""transform(array(coalesce(cast({column} as string), '')), t -> named_struct(
        'words', {_MEASURES}, 'lines', {_LINE_COUNTS},
        'word_chars', cast(length(translate(t, ' \\t\\n\\u000b\\u000c\\r', '')) as bigint),
        'n_symbols', cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint),
        'n_exclaims', length(t) - length(translate(t, '!', '')),
        'n_upper', length(t) - length(regexp_replace(t, '\\\\p{{Lu}}', ''))))[0]"""


def measures() -> Column:
    """All measures of the text in column ``_t``."""
    return F.expr(_measures_sql("_t"))


def compiled(rules=RULES) -> Column:
    """The threshold table as one boolean expression over the measures' columns."""
    tests = " and ".join(f"(cast({r.measure} as double) between {float(r.low)!r}D and {float(r.high)!r}D)" for r in rules)
    return F.expr(f"n_words > 0 and not base_failed and {tests}" if tests else "n_words > 0 and not base_failed")


def _measured(df: DataFrame, keep: str, rules) -> DataFrame:
    flat = df.select(keep, measures().alias("m")).select(
        keep, "m.words.*", F.col("m.lines.n").alias("n_lines"), F.col("m.lines.d").alias("n_dup_lines"), "m.word_chars", "m.n_symbols", "m.n_exclaims", "m.n_upper"
    )
    flat = flat.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    return flat.withColumn("kept", F.coalesce(compiled(rules), F.lit(False)))


def scored(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id and all measures, ``base_failed`` and ``kept``."""
    return _measured(docs.select("doc_id", F.col("text").alias("_t")), "doc_id", rules)


_PLACES = {"n_lines": "m.lines.n", "n_dup_lines": "m.lines.d"} | {k: f"m.words.{k}" for k in ("n_words", "n_repeat_words", "n_stop", "n_unlettered")} | {k: f"m.{k}" for k in ("word_chars", "n_symbols", "n_exclaims", "n_upper")}


def quality_filter(docs: DataFrame, rules=RULES) -> DataFrame:
    """Rows of ``docs`` whose text the rules keep, with the input's columns.

    The measures are bound inside the predicate: as columns, each rule would repeat them once the optimiser
    pushes the predicate below their projection."""
    tests = "".join(f" and (cast({r.measure} as double) between {float(r.low)!r}D and {float(r.high)!r}D)" for r in rules)
    verdict = f"n_words >= 10 and 100 * n_repeat_words <= 20 * n_words{tests}"
    verdict = re.sub(r"\b(" + "|".join(_PLACES) + r")\b", lambda x: _PLACES[x[1]], verdict)
    return docs.where(F.expr(f"coalesce(transform(array({_measures_sql('text')}), m -> {verdict})[0], false)"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_ORACLE_RULES = " and ".join(f"(cast({r.measure} as double) between {float(r.low)!r} and {float(r.high)!r})" for r in RULES)
ORACLE_SQL = f"""
with d as (select doc_id, coalesce(text, '') as t,
        list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
    from documents),
win as (select doc_id, i, list_aggregate(w[i : i + 4], 'string_agg', ' ') as v
    from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d where len(w) >= 5)),
dup as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, v) as n from win) where n > 1),
cov as (select doc_id, sum(least(5, coalesce(nxt - i, 5))) as n from
    (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from dup) group by doc_id),
m as (select d.doc_id, cast(len(w) as bigint) as n_words,
        cast(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) as bigint) as word_chars,
        cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        len(l) as n_lines, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
        cast(coalesce(cov.n, 0) as bigint) as n_repeat_words,
        length(t) - length(replace(t, '!', '')) as n_exclaims,
        length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) as n_upper,
        len(list_filter(w, lambda x: lower(x) in ({_literal(STOP_WORDS)}))) as n_stop,
        len(list_filter(w, lambda x: not regexp_matches(x, '\\p{{L}}'))) as n_unlettered
    from d left join cov on cov.doc_id = d.doc_id),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    coalesce(case when n_words > 0 and not base_failed then {_ORACLE_RULES} else false end, false) as kept
from b"""
