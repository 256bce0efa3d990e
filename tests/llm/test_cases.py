"""Defined cases of every operator and stage: nulls, empty tables, repeated rows, clashing columns, very long texts."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from paracorpus.llm import bpe_codec, nn_descent, packing, quality, secrets, simhash, substring_dedup, suffix_dedup, token_counts, toxicity

#: Columns whose names the operators use inside.
CLASHING = "doc_id long, text string, lang string, source string, key string, h int, fp string, row int, root int, node int, _row int, doc string"


def rows(texts, twice=()):
    made = [(i, t, "en", None, "k", 1, "f", 2, 3, 4, 5, "d") for i, t in texts]
    return made + [made[i] for i in twice]


@pytest.fixture(scope="module")
def docs(spark):
    text = " ".join(f"word{i} the" for i in range(90))
    long = " ".join(f"l{i % 9973} of" for i in range(60_000))
    return spark.createDataFrame(rows([(0, None), (1, ""), (2, text), (3, text), (4, long), (5, "password = abcdefghijkl"), (None, text), (2, text + " more")], (2, 5)), CLASHING)


EACH = {
    "op1": token_counts.token_counts, "op2": suffix_dedup.dedup, "op3": substring_dedup.dedup, "op4": secrets.report, "op5": quality.scored, "op8": simhash.near_duplicates, "op9": bpe_codec.digests,
    "op10": lambda d: toxicity.scored(d, toxicity.train(d, d.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))),
}


@pytest.mark.parametrize("name", EACH)
def test_one_row_out_for_each_row_in(docs, name):
    got, want = EACH[name](docs).select("doc_id").collect(), docs.select("doc_id").collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in want)
    assert EACH[name](docs.limit(0)).count() == 0


def test_packing_of_any_rows(docs):
    got = packing.pack(docs).collect()
    assert len({(r.doc_id, r.piece, r.start) for r in got}) >= 7 and sum(r.length for r in got if r.doc_id == 0) == 1
    assert packing.pack(docs.limit(0)).count() == 0


def test_repeated_rows_of_rules_and_secrets(docs):
    twice = [r for r in quality.scored(docs).where("doc_id = 5").collect()]
    assert len(twice) == 2 and twice[0] == twice[1]
    found = secrets.report(docs).where("doc_id = 5").collect()
    assert len(found) == 2 and found[0] == found[1] and found[0].frequency == "assign:0:1/1"


def test_pipeline_stages_keep_columns_and_take_any_rows(spark, docs):
    import corpus_pipeline

    held, none = docs, docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held, none = (corpus_pipeline.stash(stage(spark, d, ""), name) for d in (held, none))
        assert held.columns == docs.columns and none.count() == 0, name
    kept = [r.doc_id for r in held.collect()]
    assert 5 not in kept and 4 not in kept and None in kept  # three words; windows that all come again
    assert held.where("doc_id is null").first().text != ""
    assert corpus_pipeline.STAGES[-1][1](spark, held, "").count() >= len(kept) and corpus_pipeline.STAGES[-1][1](spark, none, "").count() == 0


def test_the_first_three_stages_against_brute_force(spark):
    import corpus_pipeline

    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 8)))
    passage = " ".join(word() for _ in range(55))
    texts = []
    for i in range(60):
        body = [x for _ in range(int(rng.integers(8, 90))) for x in ("the", word())]
        if i % 6 == 0:
            body.insert(9, passage)
        texts.append(" ".join(body))
        if i % 5 == 0:
            texts += [texts[-1], texts[-1].replace(body[11], "changed", 1)]
    texts += ["too short", "#### " * 40, None]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in quality.scored(docs).collect() if r.kept}
    assert {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, "").collect()} == kept and len(kept) > 60

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}

    sets = {i: shingles(texts[i]) for i in kept}
    root = {i: i for i in kept}
    for _ in range(5):
        root = {i: min(root[j] for j in kept if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])) for i in kept}
    first = corpus_pipeline.simhash_near_dedup(spark, docs.where(docs.doc_id.isin(sorted(kept))), "")
    assert sorted(r.doc_id for r in first.collect()) == sorted(set(root.values()))
    left = sorted(set(root.values()))
    seen: dict = {}
    for i in left:
        w = texts[i].split()
        for j in range(len(w) - 50):
            seen[tuple(w[j : j + 51])] = seen.get(tuple(w[j : j + 51]), 0) + 1
    got = {r.doc_id: r.text for r in corpus_pipeline.suffix_array_dedup(spark, first, "").collect()}
    for i in left:
        w = texts[i].split()
        gone = {p for j in range(len(w) - 50) if seen[tuple(w[j : j + 51])] > 1 for p in range(j, j + 51)}
        assert got[i].split() == [x for p, x in enumerate(w) if p not in gone]
    assert sum(got[i] != texts[i] for i in left) >= 5


def test_the_queries_windows_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(3, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (49, 50, 75, 120)]
    texts = [None, "é" * 250, "é" * 250]
    for i in range(24):
        body = [word() for _ in range(int(rng.integers(5, 80)))]
        body.insert(len(body) // 2, passages[i % 4])
        texts.append(" ".join(body))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    blobs = [(t or "").encode() for t in texts]
    whole: dict = {}
    for b in blobs:
        for j in range(len(b) - 399):
            whole[b[j : j + 400]] = whole.get(b[j : j + 400], 0) + 1
    for r in suffix_dedup.op2_suffix_dedup(spark, str(tmp_path)).collect():
        b = blobs[r.doc_id]
        gone = {p for j in range(len(b) - 399) if whole[b[j : j + 400]] > 1 for p in range(j, j + 400)}
        kept = bytes(c for p, c in enumerate(b) if p not in gone)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), len(gone), sum(p - 1 not in gone for p in gone), hashlib.sha256(kept).hexdigest())
    first: dict = {}
    words = [re.findall(rb"[^\x20\x09-\x0D]+", b) for b in blobs]
    for i, w in enumerate(words):
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j : j + 50]), i)
    for r in substring_dedup.op3_substring_dedup(spark, str(tmp_path)).collect():
        w = words[r.doc_id]
        gone = {p for j in range(len(w) - 49) if first[tuple(w[j : j + 50])] < r.doc_id for p in range(j, j + 50)}
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), hashlib.sha256(b" ".join(x for p, x in enumerate(w) if p not in gone)).hexdigest())


def test_vectors_of_all_kinds(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((240, 6))
    x[7] = x[100] + 1e-12  # the same as float, not as double
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, x[100].tolist()), (300, [1.0] * 5), (400, [1e200] + [0.0] * 5), (500, [1.5e200] + [0.0] * 5)]
    got: dict = {}
    for r in nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200, 400, 500]  # 300 has another length
    best = sorted(got[100])[0]
    assert best[1] == 7 and 0 < best[2] < 1e-11
    assert abs(sorted(got[400])[0][2] / 5e199 - 1) < 1e-9 and sorted(got[400])[0][1] == 500 or np.isfinite(sorted(got[400])[0][2])


def test_toxicity_of_repeated_rows(spark):
    rows = [(i, "fine words here" if i % 3 else "vilest words here", 1) for i in range(300)]
    docs = spark.createDataFrame([*rows, *rows[:30]], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    got = toxicity.scored(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == 330 and all(r.predicted == (r.doc_id % 3 == 0) for r in got)
    assert {r.doc_id for r in got if r.held_out} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0}
