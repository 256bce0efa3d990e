"""Quality rules, secrets, toxicity, neighbours and the pipeline."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paracorpus.llm import nn_descent, quality, secrets, toxicity

TEXTS = [
    None, "", "   ", "one two", "a b c d e a b c d e f g h", "Der die das und ist von zu mit den dem ein eine.\nDer die\n\nDer die\n", "x" * 100_000, "the #$% and | of " * 40,
    "The cat and the dog went to the house, and it was good for them all.", "\t\n\x0b\x0c\r word\x85not ", "is the of and to a in it for on as was by at\n" * 3,
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", "k") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, kept string")


def test_quality_measures(spark):
    got = {r.doc_id: r for r in quality.scored(frame(spark, TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
        seen = collections.Counter(windows)
        repeat = len({p for j, x in enumerate(windows) if seen[x] > 1 for p in range(j, j + 5)})
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeat), t[:30]
        assert r.base_failed == (len(w) < 10 or 100 * repeat > 20 * len(w)) and not (r.base_failed and r.kept)
    assert got[8].kept and not got[7].kept and not got[0].kept
    kept = quality.quality_filter(frame(spark, TEXTS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "kept"] and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
SECRETS = [
    None, "", 'é token = "abcdefghijklmnop" x', "token = token = abcdefghijklmnop", "AKIA" + "Z" * 20 + " AKIASHORT", "deadbeef" * 4 + " 0123456789abcde", "PassWord:'0123456789abcdef0123'\U0001f600 secret=short",
    "key Zx9Qw8Er7Ty6Ui5Op4As3Df2 here", "key Shared9Qw8Er7Ty6Ui5Op4As3 here", "also Shared9Qw8Er7Ty6Ui5Op4As3", "tokens token:: aaaaaaaaaaaaa",
]


def test_secrets(spark):
    got = {r.doc_id: r for r in secrets.report(frame(spark, SECRETS)).collect()}
    assert len(got) == len(SECRETS)
    for i, t in enumerate(SECRETS):
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        r = got[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, k, _ in spans) for x in range(3)]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        if i != 7:
            assert r.spans == listed
    assert got[7].spans == "generic:4:28" and got[7].n_live == 1  # one owner
    assert got[8].spans == "" and got[8].n_example == 1  # two owners share it


def test_ownership_counts_against_brute_force(spark):
    rnd = np.random.default_rng(4)
    alphabet = list("abcdefghjkmnpqrstuvwxyzABCDEFGHJKMNPQRSTUVWXYZ23456789")
    values = ["".join(rnd.choice(alphabet, 30)) + "aB3" for _ in range(12)] + ["0123456789abcdef01"] + ["AKIA" + "Q" * 16]
    rows = []
    for i in range(120):
        some = rnd.choice(len(values), rnd.integers(0, 4))
        text = " ".join(rnd.choice(["x {}", "key={}", 'token = "{}"', "{}\n"]).format(values[v]) for v in some)
        rows.append((i, text, [None, "en", "fr", "de"][i % 4], f"s{min(int(v) for v in some) % 5 if len(some) else 0}"))
    rows += [(200 + i, f"x own{i}Own0123456789abcXYZ y", "en", f"s{i % 3}") for i in range(9)]
    rows += [*rows[:10], *rows[-4:]]  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kinds = [(ASSIGN, 2, lambda v: len(v) >= 12), (re.compile("AKIA[A-Z0-9]+"), 0, lambda v: len(v) >= 18), (re.compile("[0-9a-f]+"), 0, lambda v: len(v) >= 16)]
    generic = re.compile("[A-Za-z0-9+/_-]{20,}")
    found, owners, repositories = [], collections.defaultdict(set), collections.defaultdict(set)
    for _, t, lang, source in rows:
        base = [(m.start(), k, m.end(), m[g]) for k, (p, g, ok) in enumerate(kinds) for m in p.finditer(t) if ok(m[g])]
        mixed = lambda v: all(re.search(c, v) for c in ("[0-9]", "[a-z]", "[A-Z]"))
        more = [(m.start(), 3, m.end(), m[0]) for m in generic.finditer(t) if mixed(m[0]) and not any(b[0] < m.end() and m.start() < b[2] for b in base)]
        found.append((base, more))
        for *_, v in base + more:
            owners[v].add(source)
            repositories[v].add((source, lang))
    live = lambda v: len(owners[v]) <= 1 and len(repositories[v]) <= 2
    names = ("assign", "access", "hex", "generic")
    want = []
    for (i, *_), (base, more) in zip(rows, found, strict=True):
        listed = sorted(base + [x for x in more if live(x[3])])
        counted = ",".join(f"{names[k]}:{s}:{len(owners[v])}/{len(repositories[v])}" for s, k, _, v in sorted(base + more))
        want.append((i, ",".join(f"{names[k]}:{s}:{e}" for s, k, e, _ in listed), sum(live(x[3]) for x in base + more), sum(not live(x[3]) for x in base + more), counted))
    got = [(r.doc_id, r.spans, r.n_live, r.n_example, r.frequency) for r in secrets.report(docs).collect()]
    assert sorted(got) == sorted(want) and any(x[2] for x in want) and any(x[3] for x in want)
    none = docs.limit(0)
    assert secrets.report(none).count() == secrets.masked(none).count() == 0


def test_masking_keeps_columns_of_any_name(spark):
    rows = [(1, "password: abcdefghijkl", "en", "s", 1, 2, "3"), (1, None, None, None, 4, 5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _row int, row int, doc string")
    out = secrets.masked(df)
    assert out.columns == df.columns and sorted(map(tuple, out.collect()), key=str) == sorted([(1, "[SECRET]", "en", "s", 1, 2, "3"), rows[1]], key=str)


def test_masking(spark):
    out = secrets.masked(frame(spark, SECRETS))
    got = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == ["doc_id", "text", "lang", "source", "kept"]
    assert got[0] is None and got[1] == "" and got[2] == 'é [SECRET]" x' and got[7] == "key [SECRET] here" and got[8] == SECRETS[8]
    assert got[6] == "[SECRET]'\U0001f600 secret=short"


def test_toxicity_learns_and_ignores_held_out_labels(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    rows, labels = [], []
    for i in range(900):
        words = list(rng.choice(vocabulary, 40))
        toxic = int(i % 4 == 0)
        if toxic:
            words[5] = words[20] = "vilest"
        rows.append((i, " ".join(words), "en"))
        held = zlib.crc32(str(i).encode()) % 5 == 0
        labels.append((i, 1 - toxic if held else toxic))  # held-out labels lie
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "!!!", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in toxicity.scored(docs, toxicity.train(docs, spark.createDataFrame([*labels, (5000, None)], "doc_id long, toxic int"))).collect()}
    assert len(got) == len(rows)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(900))
    assert np.mean([got[i].predicted == (i % 4 == 0) for i in range(900)]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values()) and got[1000].score == got[1001].score == got[1002].score


def test_words_of_every_character():
    for i in [*range(0x500), 0x2019, 0x4E2D, 0x1F600]:
        for t in (f"aB{chr(i)}cD 1_é", f"{chr(i)}\u0153 x"):
            assert toxicity.words_of(t) == re.findall(r"[^\W\d_]+", t.lower()), hex(i)


def test_toxicity_against_kneser_ney_by_hand(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcé"), rng.integers(1, 6)))
    rows = [(i, " ".join(word() for _ in range(30)) + (" vilestab vile" if i % 4 == 0 else ""), "x") for i in range(120)] + [(500, None, "x"), (0, "vile again", "x")]
    labels = [(i, int(i % 4 == 0)) for i in range(100)] + [(3, 1), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cell string")
    known = toxicity.training_labels(spark.createDataFrame(labels, "doc_id long, toxic int"))
    kinds = {r.doc_id: int(r.toxic) if not r.curve else 2 for r in known.collect()}
    assert kinds[3] in (1, 2) and not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in kinds) and {0, 1, 2} <= set(kinds.values())
    counted = known.where("not curve")
    kept = {r.doc_id for r in toxicity._perhaps(docs, counted).collect()}
    assert kept >= {i for i, k in kinds.items() if k < 2} and len(kept) < 100
    discounts = (3.0, 2.0)
    model = toxicity.Model(toxicity.beginnings(toxicity.word_counts(docs, known), discounts).toPandas(), discounts)
    times, types = [collections.Counter(), collections.Counter()], set()
    for i, t, _ in rows:
        for w in re.findall(r"[^\W\d_]+", (t or "").lower()):
            types.add(w + toxicity.END)
            if kinds.get(i, 2) < 2:
                times[kinds[i]][w + toxicity.END] += 1
    count = [lambda g, c=c: sum(n for w, n in c.items() if w.startswith(g)) for c in times]

    def p(k, g):
        letters = {w[: len(g)] for w in types if w[: len(g) - 1] == g[:-1] and len(w) >= len(g)}
        shared = sum(w.startswith(g) for w in types) / sum(w.startswith(g[:-1]) for w in types)
        total = count[k](g[:-1])
        return max(0, count[k](g) - discounts[k]) / total + sum(min(count[k](x), discounts[k]) for x in letters) / total * shared if total else shared

    for w in ("vilest", "ab", "écab", "vile", "a"):
        s = w + toxicity.END
        # a letter that no word has there has no shared probability either, and tells nothing
        want = sum(np.log(p(1, s[:j])) - np.log(p(0, s[:j])) for j in range(1, len(s) + 1) if p(0, s[:j]) and p(1, s[:j]))
        if s in types:
            assert abs(model.ratios([w])[0] - want) < 1e-9, w
    assert model.ratios(["vilest"])[0] > 1 and "vilest" + toxicity.END in types or "vile" + toxicity.END in types
    x, n = model.measures(["ab vilest ab", "", "!"])
    assert n.tolist() == [3, 0, 0] and abs(x[0] - np.maximum(model.ratios(["ab", "ab", "vilest"]) - 1, 0).sum() / 3**0.5) < 1e-9
    assert toxicity.scored(docs.limit(0), model).count() == 0 and toxicity.train(docs.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int")).slope == 0
    long = "vile " * 100_000 + "x" * 300_000
    assert model.scores([long, ""]).shape == (2,) and model.measures([long])[1][0] == 100_001


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.scored(docs, toxicity.train(docs, none)).collect()] == [0]


def test_toxicity_keeps_all_beginnings_at_any_size_and_joins_the_rest(spark):
    rng = np.random.default_rng(7)
    common = [f"w{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    vile = [f"vile{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]  # each is rare
    rows = [(i, " ".join([*rng.choice(common, 30), *(rng.choice(vile, 2) if i % 5 == 0 else [])])) for i in range(3000)] + [(4000, "vileaa!"), (4000, "vileaa!"), (4001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(3000)], "doc_id long, toxic int")
    known = toxicity.training_labels(labels)
    words = toxicity.word_counts(docs, known).groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    d = (3.0, 3.0)
    whole = toxicity.Model(toxicity.beginnings(words, d).toPandas(), d)
    names = sorted({w for _, t in rows for w in toxicity.words_of(t or "")})
    want = dict(zip(toxicity._keys(names).view(np.int64).tolist(), whole.excess(names), strict=True))
    got = {r.key: r.excess for r in toxicity.excesses(words, d).collect()}
    assert set(got) == {k for k, x in want.items() if x > 0} and all(abs(x - want[k]) < 1e-9 for k, x in got.items())
    scores = []
    for near in (1 << 20, 5, 0):  # all are broadcast, some, none
        model = toxicity.train(docs, labels, near=near)
        assert (model.rest is None) == (near > 5) and len(model.keys) == min(near, len(got)) and (model.rest is None or model.rest.count() == len(got) - near)
        scores.append(sorted((r.doc_id, round(r.score, 9), r.predicted) for r in toxicity.scored(docs, model).collect()))
    assert scores[0] == scores[1] == scores[2] and len(scores[0]) == len(rows)
    assert np.mean([p == (i % 5 == 0) for i, _, p in scores[0] if i < 3000]) > 0.99
    curve = toxicity.training_labels(labels, 100)
    n = curve.where("curve").count()
    assert 0 < n < 200 and curve.where("not curve").count() == curve.count() - n  # what does not fit the curve is counted


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((900, 12)).astype("f4")
    x[300:500] = x[300]  # many equal vectors
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(2000, None, 0), (2100, [], 0), (2200, [0.0] * 12, 0), (2300, [float("nan")] * 12, 0), (2400, [None] + [1.0] * 11, 0), (2500, [float("inf")] + [0.0] * 11, 0)]
    return x, spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank int")


def test_neighbours(vectors):
    x, df = vectors
    x = x.astype(float)
    rows = nn_descent.nearest(df).collect()
    by = {}
    for r in rows:
        by.setdefault(r.query_id, []).append(r)
    assert sorted(by) == list(range(0, 900, 100))
    hit = 0
    for q, found in by.items():
        found.sort(key=lambda r: r.rank)
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        assert [r.rank for r in found] == list(range(1, 11)) and all(abs(r.score - d[r.vec_id]) < 1e-12 for r in found)
        hit += len({r.vec_id for r in found} & set(np.lexsort((np.arange(900), d))[:10].tolist()))
    assert hit / (10 * len(by)) >= 0.9
    assert [r.vec_id for r in by[400]] == list(range(300, 310))  # ties go to the smaller id


def test_neighbours_both_ways_come_once_and_go_to_spark_s_blocks(spark):
    rng, n, k, blocks = np.random.default_rng(2), 60, 4, 3
    ids = np.concatenate([np.arange(-30, n - 32), [2**62, -(2**63)]])
    at = dict(enumerate(ids.tolist()))
    lists = [[(float(abs(i - j)), at[j], bool(rng.integers(0, 8) == 0)) for j in sorted(rng.choice([x for x in range(n) if x != i], 5, replace=False), key=lambda j, i=i: (abs(i - j), at[j]))] for i in range(n)]
    rows = [(at[i], [(d, w) for d, w, _ in x], [f for *_, f in x]) for i, x in enumerate(lists)]
    graph = spark.createDataFrame(rows, "node long, found array<struct<d:double,w:long>>, fresh array<boolean>").withColumn("block", nn_descent._block("node", blocks)).select("block", "node", "found", "fresh")
    home = {r.node: r.block for r in graph.collect()}
    assert nn_descent._homes(ids, blocks).tolist() == [home[i] for i in ids.tolist()]
    want = {i: {} for i in at.values()}
    for v in at.values():
        back = sorted((d, at[i], f) for i, x in enumerate(lists) for d, w, f in x if w == v)[:k]
        for _, w, f in [*next(x for i, x in enumerate(lists) if at[i] == v), *back]:
            want[v][w] = want[v].get(w, False) or f
    pointed = graph.groupBy("block").applyInArrow(nn_descent._pointed(k, blocks), "home int, to array<long>, of array<long>, d array<double>, new array<boolean>")
    around = graph.groupBy("block").cogroup(pointed.groupBy("home")).applyInArrow(nn_descent._around(k, blocks), "block int, node long, around array<struct<w:long,new:boolean,home:int>>").collect()
    assert {r.node: sorted((x.w, x.new) for x in r.around) for r in around} == {i: sorted(x.items()) for i, x in want.items() if any(x.values())}
    assert all(r.block == home[r.node] and x.home == home[x.w] for r in around for x in r.around)


def test_search_goes_on_until_all_of_the_beam_is_expanded(spark):
    chain = spark.createDataFrame([(i, [(1.0, j) for j in (i - 1, i + 1) if 0 <= j < 18]) for i in range(18)], nn_descent.LIST)
    vectors = spark.createDataFrame([(i, [float(i)]) for i in range(18)], "node long, vec array<float>")
    found = nn_descent.search(chain, vectors, spark.createDataFrame([(0,)], "node long"), 50).first().found
    assert [x.w for x in found] == list(range(18))


def test_beam_widens_until_recall_is_reached(spark):
    x = np.random.default_rng(5).standard_normal((3000, 48)).astype("f4")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    vectors = df.select(F.col("vec_id").alias("node"), F.col("embedding").alias("vec"))
    asked = vectors.where("node % 100 = 0").select("node")
    true = nn_descent.scan(vectors, asked, 11)
    exact = {q: np.argsort(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))[:11].tolist() for q in range(0, 3000, 100)}
    assert {r.node: [w.w for w in r.found] for r in true.collect()} == exact
    graph = nn_descent.stash(nn_descent.build(vectors, k=6, rounds=1), "graph")
    assert nn_descent.recall(nn_descent.search(graph, vectors, asked, 12), true, 11) < 0.8
    assert nn_descent.recall(nn_descent.reached(graph, vectors, asked, 10, 3000, 12), true, 11) >= nn_descent.TARGET


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in nn_descent.nearest(df).collect())
    assert got == [(0, 1, 100), (0, 2, 1), (100, 1, 0), (100, 2, 1)]
    assert nn_descent.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "suffix_array_dedup", "secret_scans", "best_fit_packing"]
    sentence = "The cat and the dog went to the house, and it was good for them all."
    line = lambda k: " ".join(f"the {x}x {x}y" for x in (f"{chr(97 + k)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)))
    passage = " ".join(f"of {x}q {x}r {x}s" for x in (f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)))
    texts = [line(0), line(0), line(1) + " " + passage, line(2) + " " + passage, "#### $$$$ " * 20, line(3) + " token = abcdefghijklmnop", sentence, None]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r.doc_id: r.text for r in docs.collect()})
    assert set(kept[0]) == {0, 1, 2, 3, 5, 6} and set(kept[1]) == {0, 2, 3, 5, 6}
    assert len(kept[2][2]) < len(texts[2]) - 400 and kept[2][0] == texts[0]
    assert kept[3][5].endswith("[SECRET]") and kept[3][6] == sentence
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").select("doc_id").distinct().count() == 5
