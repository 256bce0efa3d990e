"""Cases that only larger tables have, made small."""

import numpy as np
import pytest

from paracorpus import catalog

duckdb = pytest.importorskip("duckdb")


def test_small_negative_numbers_round_to_negative_zeros(spark, tmp_path):
    rows = [(0, [3.0, -1e-9, 1e-9, -0.0, -4.0], "a"), (1, [-1e-8, 1e-8, 2.0, 0.0, 1e-7], "b")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    frame.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    for name, key in (("l2_norm", "vec_id"), ("mean_pool", "label")):
        got = dict(catalog.queries()[name](spark, str(tmp_path)).select(key, "v").collect())
        want = dict(db.execute(f"select {key}, v from ({catalog.oracle_sql()[name]})").fetchall())
        assert {k: list(map(repr, v)) for k, v in got.items()} == {k: list(map(repr, v)) for k, v in want.items()}
    got = catalog.queries()["dot_score"](spark, str(tmp_path)).first()["score"]
    assert np.signbit(got) and got == db.execute(catalog.oracle_sql()["dot_score"]).fetchone()[1]


def test_edit_distances_of_long_lines():
    import random
    import time

    from paracorpus.operators.distance import by_bits, distances

    def table(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    some = random.Random(7)
    word = lambda letters, n: "".join(some.choice(letters) for _ in range(n))
    for letters in ("ab", "abcdef ", "ab\u00ff\u00fe\u00e9", "a\u6f22\U0001f600"):
        left = [word(letters, some.randrange(70)) for _ in range(80)]
        right = [a.replace("a", "", 2) if some.random() < 0.6 else word(letters, some.randrange(70)) for a in left]
        want = [table(a, b) for a, b in zip(left, right, strict=True)]
        assert distances(left, right).tolist() == want == [by_bits(a, b) for a, b in zip(left, right, strict=True)]
    long = word("abcdefgh", 60_000)
    began = time.time()
    assert distances([long], [long[:100] + long[200:]]).tolist() == [100]
    assert distances([long], [long[::-1]])[0] == by_bits(long, long[::-1])
    assert time.time() - began < 60


def test_error_rates_do_not_square_a_page(spark):
    import time

    from paracorpus.operators import evaluate

    text = "".join(chr(97 + i * i % 23) for i in range(200_000))
    gold = spark.createDataFrame([(0, text), (1, None), (2, "abc")], "page int, text string")
    pages = spark.createDataFrame([(0, text.replace("ab", "b", 500)), (1, "xy"), (3, "abc")], "page int, text string")
    began = time.time()
    got = evaluate.cer(pages, gold, ["page"]).first()
    assert got["chars"] == 200_000 and got["errors"] == 2 + 200_000 - len(text.replace("ab", "b", 500)) and time.time() - began < 20
    none = evaluate.cer(pages.where("page > 5"), gold, ["page"]).first()
    assert none["errors"] is None and none["cer"] is None


def test_ngrams_of_texts_and_lists_are_the_same_and_quick():
    import collections
    import random
    import time

    import pyarrow as pa

    from paracorpus.operators import evaluate

    some = random.Random(3)

    def counted(h, r, n):
        a, b = (collections.Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (h, r))
        return n, sum((a & b).values()), a.total(), b.total()

    for letters in ("ab", "a漢\U0001f600b", "".join(map(chr, range(100, 3000)))):
        h, r = ("".join(some.choice(letters) for _ in range(some.randrange(150))) for _ in range(2))
        for a, b in ((h, r), (list(h), list(r)), (h, h[3:] + "ab"), ("", r), (h, "")):
            assert evaluate.clipped_matches(a, b, range(1, 9)) == [counted(a, b, n) for n in range(1, 9)]
    kind = pa.list_(pa.string())
    left, right = pa.array([["z"], ["a", "b", None, "a"], None, []], kind).slice(1), pa.array([["a", None], ["q"], None], kind)
    got = [evaluate.clipped_matches(h, r, (1, 2)) for h, r in zip(*evaluate._sides(left, right), strict=True)]
    assert got == [[counted(h or [], r or [], n) for n in (1, 2)] for h, r in zip(left.to_pylist(), right.to_pylist(), strict=True)]
    text = "".join(some.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000))
    began = time.time()
    evaluate.clipped_matches(text, text[1:], range(1, 7))
    assert time.time() - began < 0.6


def test_best_places_without_a_full_order():
    import time

    from paracorpus.operators import align

    some = np.random.default_rng(5)
    for d in (np.round(some.standard_normal((300, 40)), 1), np.zeros((3, 2)), some.standard_normal((2, 1)), np.ones((1, 5)) + 1e-14 * np.arange(5), np.array([[np.nan, 1, -np.inf, 2.0]])):
        for k in (1, 3, 11):
            place, score = align._best(d, k)
            want = np.argsort(-np.round(d, 12), axis=1, kind="stable")[:, :k]
            assert (place == want).all() and np.array_equal(score, np.take_along_axis(d, want, 1), equal_nan=True)
    d = some.standard_normal((2048, 2048))
    began = time.time()
    np.argsort(-np.round(d, 12), axis=1, kind="stable")
    full, began = time.time() - began, time.time()
    align._best(d, 1)
    assert time.time() - began < full / 2
