"""Cleaning and splitting against hand-written cases and plain-Python statements of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from paracorpus.functions import text as T
from paracorpus.operators import split

WHITE = [c for c in map(chr, range(0x3001)) if c.isspace()]


def one(spark, values, f):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "i int, t string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("t"))).collect()]


def test_strip_knows_python_white_space(spark):
    values = [w + "x" + w for w in WHITE] + ["​x", "", " \n"]
    assert one(spark, values, T.strip) == [v.strip() for v in values]
    assert one(spark, values, T.flatten_ws) == [" ".join(v.split()) for v in values]


def test_normalize_cases(spark):
    values = ["a\n# h\nb", "x【y\nz】w【open", "ＡＢ　！", "a\r\nb", "　a  \n\n\n\n b ", "", "---\n\n姊妹计划 : 数据项\nx", "ｘ\n＃h"]
    assert one(spark, values, T.normalize) == ["a\n\nb\n", "xw【open\n", "AB　!\n", "a\nb\n", "a\n\nb\n", "\n", "x\n", "x\n#h\n"]


def test_names(spark):
    assert one(spark, ["Sách TẬP 5", "tap 6 x", "a b" * 20], T.volume_key) == ["tap5", "tap6", ("a_b" * 20)[:32]]
    assert one(spark, ["a_b_7", "a_b", "a_b_x"], lambda c: T.page_of_text(c)[1]) == [7, -1, -1]
    assert one(spark, ["Tập4", "x"], T.volume_of_pdf) == ["tap4", None]
    assert one(spark, ["a_12_res.json", "a.json"], T.page_of_layout) == [12, None]


def test_clean_grounding(spark):
    values = ["<|ref|>a<|/ref|><|det|>[1]\n</tag><|/det|>  \nb ", None, ""]
    assert one(spark, values, T.clean_grounding) == ["a\nb", "", ""]


@pytest.mark.parametrize(("text", "want"), [
    ("甲！？", ["甲！", "？"]), ("甲〈乙。丙〉丁。", ["甲〈乙。丙〉丁。"]), ("甲〈乙。", ["甲〈乙。"]), ("〈a〈b。〉c。〉d。e", ["〈a〈b。〉c。〉d。", "e"]), ("", []), (" 。 ", ["。"]), ("a(b.c)d;e", ["a(b.c)d;", "e"])])
def test_split_classical(spark, text, want):
    assert one(spark, [text], split.split_classical) == [want]


def test_flat_and_nested_paths_agree(spark):
    rnd = random.Random(3)
    values = ["".join(rnd.choice("甲乙。！；〈〉「」 \n") for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    assert one(spark, values, split.split_classical) == [split.bracket_sentences(v) for v in values]


def test_long_block_without_terminators_falls_back(spark):
    block = "\n".join(["甲" * 150] * 15)
    got = one(spark, [block], split.split_classical)[0]
    assert [len(x) for x in got] == [300] * 7 + [150]


def test_greedy_merge_and_chunks(spark):
    assert one(spark, ["a" * 200 + "\nb\n\nc", "", "x\ny"], split.greedy_merge) == [["a" * 200, "bc"], [], ["xy"]]
    assert one(spark, ["\n\na\n\nb", "p" * 600 + "\n\nq", "a" * 498 + "\n\nb"], split.chunk_text) == [["a\n\nb"], ["p" * 600, "q"], ["a" * 498, "b"]]


def test_split_viet(spark):
    assert one(spark, ["A b. C d! x\ny？ z"], split.split_viet) == [["A b.", "C d!", "x\ny？"]]
