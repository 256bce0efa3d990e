"""Sentence and chunk generators: text columns to arrays, in expressions except for nested annotations."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.text import TERMINATORS, WS, strip

MAX_LENGTH, CHUNK_TARGET, MAX_CHARS = 2000, 200, 500
#: Annotation brackets by opener.
BRACKETS = {"〈": "〉", "「": "」", "『": "』", "（": "）"}


def _stripped(parts) -> Column:
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def paragraphs(c) -> Column:
    return _stripped(F.split(c, r"\n{2,}"))


def split_terminators(c) -> Column:
    """Sentences of a text without annotations; a terminator on its own is a sentence."""
    return _stripped(F.split(c, f"(?<=[{TERMINATORS}])"))


def greedy_merge(c, target: int = CHUNK_TARGET) -> Column:
    """Lines glued together until ``target`` characters are reached."""
    state = lambda out, buf: F.struct(out.alias("out"), buf.alias("buf"))
    none = F.array().cast("array<string>")
    return F.aggregate(
        _stripped(F.split(c, "\n")),
        state(none, F.lit("")),
        lambda a, x: F.when(F.length(a["buf"]) + F.length(x) >= target, state(F.concat(a["out"], F.array(F.concat(a["buf"], x))), F.lit(""))).otherwise(state(a["out"], F.concat(a["buf"], x))),
        lambda a: F.when(a["buf"] != "", F.concat(a["out"], F.array(a["buf"]))).otherwise(a["out"]),
    )


def chunk_text(c, most: int = MAX_CHARS) -> Column:
    """Blank-line paragraphs packed into chunks of at most ``most`` characters; longer ones stay whole."""
    state = lambda out, cur: F.struct(out.alias("out"), cur.alias("cur"))
    none = F.array().cast("array<string>")
    full = lambda a, p: (a["cur"] != "") & (F.length(a["cur"]) + F.length(p) + 2 > most)
    return F.aggregate(
        F.split(c, "\n\n"),
        state(none, F.lit("")),
        lambda a, p: F.when(full(a, p), state(F.concat(a["out"], F.array(a["cur"])), p)).otherwise(state(a["out"], F.when(a["cur"] == "", p).otherwise(F.concat(a["cur"], F.lit("\n\n"), p)))),
        lambda a: F.when(a["cur"] != "", F.concat(a["out"], F.array(a["cur"]))).otherwise(a["out"]),
    )


def split_viet(c) -> Column:
    """Modern-language sentences of two characters or more, by full-width marks and then by ASCII marks."""
    outer = F.split(strip(c), rf"(?<=[。；！？]){WS}+")
    inner = F.flatten(F.transform(outer, lambda x: F.split(x, rf"(?<=[.!?:\n]){WS}+")))
    return F.filter(F.transform(inner, strip), lambda x: F.length(x) >= 2)


def _flat_atoms() -> str:
    openers = "".join(BRACKETS)
    spans = "|".join(rf"{a}[^{b}]*(?:{b}|\z)" for a, b in BRACKETS.items())
    atom = rf"(?:{spans}|[^{TERMINATORS}{openers}])"
    return rf"{atom}*+[{TERMINATORS}]|{atom}++"


_NESTED = "|".join(rf"{a}[^{b}]*{a}" for a, b in BRACKETS.items())
_SPACE = re.compile(WS)
_LEADING, _TRAILING = re.compile(rf"\A{WS}+"), re.compile(rf"{WS}+\Z")


def bracket_sentences(text: str) -> list[str]:
    """Sentences of a text whose annotations may nest: terminators count at depth zero only.

    Depth follows one kind of bracket at a time; an annotation that is never closed runs to the end."""
    out, begin, i, n = [], 0, 0, len(text)
    while i < n:
        close = BRACKETS.get(text[i])
        if close:
            opener, depth = text[i], 0
            while i < n:
                depth += (text[i] == opener) - (text[i] == close)
                i += 1
                if not depth:
                    break
            continue
        i += 1
        if text[i - 1] in TERMINATORS:
            out.append(text[begin:i])
            begin = i
    out.append(text[begin:])
    stripped = (_TRAILING.sub("", _LEADING.sub("", s)) for s in out)
    return [s for s in stripped if s]


def _nested_sentences(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else bracket_sentences(t))


def protect_ascii_parens(c) -> Column:
    """ASCII parentheses as full-width ones, which are protected as annotations; cleaning folds them to ASCII before."""
    return F.translate(c, "()", "（）")


def split_classical(c, protect_parens: bool = False) -> Column:
    """Sentences with annotations protected, on request ASCII parentheses, too; the latter come out as ASCII again.  Texts whose brackets do not nest stay in expressions; only
    nested ones go to Python.  Long sentences without any terminator fall back to glued lines."""
    if protect_parens:
        parts = split_classical(protect_ascii_parens(c))
        return F.transform(parts, lambda s: F.translate(s, "（）", "()"))
    flat = _stripped(F.regexp_extract_all(c, F.lit(_flat_atoms()), F.lit(0)))
    nested = F.pandas_udf(_nested_sentences, ArrayType(StringType()))
    sentences = F.when(F.coalesce(c, F.lit("")).rlike(_NESTED), nested(F.when(c.rlike(_NESTED), c))).otherwise(flat)
    plain = lambda s: (F.length(s) > MAX_LENGTH) & s.contains("\n") & ~s.rlike(f"[{TERMINATORS}]")
    return F.flatten(F.transform(sentences, lambda s: F.when(plain(s), greedy_merge(s)).otherwise(F.array(s))))


def chapter_segments(lines: DataFrame, doc: str, pos: str, line: str, shorter: int = 60) -> DataFrame:
    """``lines`` with ``segment``: lines of fewer than ``shorter`` characters are headings, and a running count of them within
    the document numbers its segments."""
    so_far = Window.partitionBy(doc).orderBy(pos)
    return lines.withColumn("segment", F.sum((F.length(line) < shorter).cast("long")).over(so_far))
