"""Beads, alignment, export, evaluation, files, streaming and the stage runner on small inputs."""

import csv
import io
import itertools
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from paracorpus import plugins
from paracorpus.operators import align, evaluate, export, ids, pages
from paracorpus.plans import stages
from paracorpus.sources import files
from paracorpus.streaming import ingest


def test_parse_beads_and_ranges(spark):
    lines = ["[3]:[4--5]:0.71", "[]:[7]:-0.1", "[1, 2]:[3]:1e-05", "noise", "[5--4]:[1]:0.5"]
    got = align.parse_beads(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert [(r.src_idx, r.tgt_idx, r.score) for r in got] == [([3], [4, 5], 0.71), ([], [7], -0.1), ([1, 2], [3], 1e-05), ([], [1], 0.5)]
    assert align.above(spark.createDataFrame([(0.5,), (0.4999,)], "score double")).count() == 1


def test_top_k_and_chain(spark):
    rng = np.random.default_rng(1)
    x, y = rng.standard_normal((30, 4)), rng.standard_normal((25, 4))
    frame = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "idx long, embedding array<double>")
    got = {(r.idx, r["rank"]): r.tgt_idx for r in align.top_k(frame(x), frame(y), 3, block=8).collect()}
    want = np.argsort(-(x @ y.T), 1)[:, :3]
    assert got == {(i, k + 1): int(want[i, k]) for i in range(30) for k in range(3)}
    assert align.increasing_chain([(0, 5, 1.0), (1, 1, 0.9), (2, 2, 0.9), (3, 0, 0.5)]) == [(1, 1), (2, 2)]


def brute_alignment(x, y, skip=-0.1, most=5):
    best = {(0, 0): 0.0}
    kinds = [(a, b) for a in range(1, most) for b in range(1, most) if a + b <= most]
    for i, j in itertools.product(range(len(x) + 1), range(len(y) + 1)):
        for a, b in kinds:
            if i >= a and j >= b:
                v = best[i - a, j - b] + float(x[i - a : i].mean(0) @ y[j - b : j].mean(0)) * (a + b)
                best[i, j] = max(best.get((i, j), -9e9), v)
        for a, b in ((1, 0), (0, 1)):
            if i >= a and j >= b:
                best[i, j] = max(best.get((i, j), -9e9), best[i - a, j - b] + skip)
    return best[len(x), len(y)]


def test_alignment_is_optimal_and_monotone():
    rng = np.random.default_rng(2)
    for n, m in ((1, 1), (4, 6), (7, 5), (0, 3)):
        x, y = rng.standard_normal((n, 3)), rng.standard_normal((m, 3))
        beads = align.align_segment(x, y)
        value = sum(s * (a + b) if a and b else -0.1 for _, a, _, b, s in beads)
        assert abs(value - brute_alignment(x, y)) < 1e-9
        assert [i for i, a, *_ in beads for i in range(i, i + a)] == list(range(n)) and [k for *_, j, b, _ in beads for k in range(j, j + b)] == list(range(m))


def test_two_pass_finds_the_diagonal(spark):
    x = np.eye(30)
    rows = [(0, s, i, x[i].tolist(), 1.0) for s in ("src", "tgt") for i in range(30) if not (s == "tgt" and i == 9)]
    df = spark.createDataFrame(rows, "segment long, side string, idx long, embedding array<double>, length double")
    got = align.align(df, passes=2).collect()
    assert {(r.src_idx[0], r.tgt_idx[0]) for r in got if len(r.src_idx) == len(r.tgt_idx) == 1} >= {(i, i) for i in range(30) if abs(i - 9) > 1}


def test_dense_index(spark):
    df = spark.createDataFrame([(d, p) for d in (5, 1, 9000) for p in range(d % 4 + 1)], "d long, p long")
    got = [(r.d, r.p, r.idx) for r in ids.dense_index(df, "d", ["p"]).orderBy("d", "p").collect()]
    assert [x[2] for x in got] == list(range(len(got)))


def test_export_counts_and_limits(spark):
    rows = [(1, " a\n b ", "x"), (2, "", "x"), (3, None, "x"), (4, "s" * 2001, "x"), (5, "s" * 2000, "x")]
    df = spark.createDataFrame(rows, "k long, src string, tgt string")
    assert export.drop_counts(df).first().asDict() == {"n_pairs": 5, "n_empty": 2, "n_long": 1, "n_kept": 2}
    assert export.drop_counts(df, 0).first().n_long == 0
    assert [(r.pair_id, r.han_sentence[:3]) for r in export.deliverable(df, "k").orderBy("pair_id").collect()] == [(1, "a b"), (2, "sss")]


def test_tsv_is_what_the_csv_module_writes(spark, tmp_path):
    rows = [(1, 'say "x"', "tab\there"), (2, " lead", ""), (3, "plain", "nl")]
    df = spark.createDataFrame(rows, "pair_id long, han_sentence string, viet_sentence string")
    files.write_tsv(df, str(tmp_path / "t"))
    out = io.StringIO()
    w = csv.writer(out, delimiter="\t")
    w.writerows([df.columns, *rows])
    assert next((tmp_path / "t").glob("part-*")).read_bytes() == out.getvalue().encode()
    book = zipfile.ZipFile(io.BytesIO(files.xlsx_bytes(rows, df.columns)))
    assert "say &quot;x&quot;" in (s := book.read("xl/worksheets/sheet1.xml").decode()) or 'say "x"' in s


def test_pages(spark):
    df = spark.createDataFrame([("b", 2, "two\n"), ("b", 1, "one\n"), ("b", 3, ""), ("a", 1, "x")], "volume string, page int, text string")
    assert {r.volume: r.text for r in pages.combine(df).collect()} == {"b": "one\n\ntwo\n\n\n", "a": "x\n"}
    assert {r.volume: r.text for r in pages.combine(df, "\n", False).collect()} == {"b": "one\ntwo\n", "a": "x\n"}
    assert sorted(r.shard for r in pages.shard(df.drop("text"), 3, ["volume", "page"]).collect()) == [0, 0, 1, 2]


def test_krippendorff_known_value(spark):
    # two raters, complete agreement but for one unit
    rows = [("c", u, r, v) for u, (a, b) in enumerate([(1, 1), (2, 2), (3, 3), (3, 4), (4, 4)]) for r, v in ((0, a), (1, b))] + [("solo", 0, 0, 1)]
    got = {r.criterion: r.alpha for r in evaluate.krippendorff_ordinal(spark.createDataFrame(rows, "criterion string, unit int, rater int, value int")).collect()}
    values = [v for c, _, _, v in rows if c == "c"]
    n = {v: values.count(v) for v in values}
    d = lambda c, k: (sum(n[g] for g in n if min(c, k) <= g <= max(c, k)) - (n[c] + n[k]) / 2) ** 2
    do = 2 * d(3, 4)
    de = sum(n[c] * n[k] * d(c, k) for c in n for k in n) / (len(values) - 1)
    assert abs(got["c"] - (1 - do / de)) < 1e-9 and got["solo"] is None


def test_perfect_overlap(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat")], "k long, t string")
    words = F.split("t", " ")
    assert abs(evaluate.bleu(df, words, words).first().bleu - 100) < 1e-9
    assert abs(evaluate.chrf(df, F.col("t"), F.col("t")).first().chrf - 100) < 1e-9


def test_correction_keeps_failed_chunks(spark):
    df = spark.createDataFrame([("a", "x\n\ny")], "volume string, text string")

    def broken(prompt):
        raise ValueError

    got = plugins.correct(df, broken).first()
    assert (got.text, got.failed) == ("x\n\ny", 1)


def test_endpoints_take_over_and_answers_are_guarded(spark):
    def dead(content):
        raise ConnectionError("down")

    pool = plugins.Endpoints([dead, lambda c: f"b{c}", lambda c: f"c{c}"])
    assert {pool(i)[0] for i in range(6)} == {"b", "c"} and pool.load[0][0] >= 1
    with pytest.raises(RuntimeError):
        plugins.Endpoints([dead, dead])(1)
    with pytest.raises(ValueError):
        plugins.Endpoints([])
    assert plugins.repeats_itself("a b c d " * 100) and not plugins.repeats_itself(" ".join(map(str, range(400))))
    images = spark.createDataFrame([("tap4", i, f"page {i}".encode()) for i in range(1, 8)] + [("tap4", 9, b"loop " * 200)], "volume string, page int, content binary")
    got = {r.page: (r.text, r.error) for r in plugins.recognise(images, [dead, lambda c: [c.decode()]], concurrency=3).collect()}
    assert all(got[i] == (f"page {i}", None) for i in range(1, 8)) and got[9][0] is None and "failed" in got[9][1]
    assert plugins.reachable(["http://127.0.0.1:9"])["http://127.0.0.1:9"] != ""


def test_rasterised_pages(spark):
    files = spark.createDataFrame([("tap4", b"12345"), ("tap5", b"1")], "volume string, content binary")
    draw = lambda content, page, dpi: f"{page}@{dpi}".encode()
    got = plugins.rasterise(files, draw, len, 200, first=2, offset=1).collect()
    assert sorted((r.volume, r.page, bytes(r.content)) for r in got) == [("tap4", 2, b"2@200"), ("tap4", 3, b"3@200")]
    assert plugins.rasterise(files, draw, len).count() == 6


def test_margin_prefers_what_stands_out():
    x = np.eye(4)[[0, 1, 2, 3]]
    y = x + 0.6  # everything is a little like everything
    plain, local = (align.align_segment(x, y, margin=m) for m in (False, True))
    assert [(a, b) for _, a, _, b, _ in local] == [(1, 1)] * 4 and all(abs(s - 1.6) < 1e-9 for *_, s in local)
    assert sum(a for _, a, *_ in plain) == 4
    assert align.align_segment(np.zeros((0, 2)), np.ones((2, 2))) == [(0, 0, 0, 1, 0.0), (0, 0, 1, 1, 0.0)]


def test_ocr_by_backend(spark):
    files_ = spark.createDataFrame([("tap4", b"abc")], "volume string, content binary")
    config = stages.CorpusConfig.from_env({"CORPUS_OCR_BACKEND": "documents", "CORPUS_DPI": "200", "CORPUS_CORRECT": "1", "CORPUS_SUBSET": "2"})

    def engine(content):
        if content.startswith(b"2"):
            raise ValueError("unreadable")
        return [content.decode()]

    good, bad = stages.ocr(files_, config, engine, lambda c, p, dpi: f"{p}@{dpi}".encode(), len, lambda prompt: prompt.split("---")[1].strip() + "!")
    assert [(r.volume, r.page, r.text) for r in good.collect()] == [("tap4", 1, "1@200!")]
    assert [(r.page, "unreadable" in r.error) for r in bad.collect()] == [(2, True)]
    with pytest.raises(ValueError):
        stages.ocr(files_, stages.CorpusConfig(), engine)
    with pytest.raises(ValueError):
        stages.CorpusConfig.from_env({"CORPUS_OCR_BACKEND": "other"})


def test_layout_import(spark, tmp_path):
    import json

    from paracorpus.plans import import_layout

    (tmp_path / "tập 5").mkdir()
    (tmp_path / "tập 5" / "b_3_res.json").write_text(json.dumps({"parsing_res_list": [{"block_label": "text", "block_content": "one", "block_order": 1, "block_id": 0}]}))
    assert import_layout.main(["--source", str(tmp_path), "--target", str(tmp_path / "out")]) == 0
    assert (tmp_path / "out/tap5_page_0003.txt").read_text() == "one"


def test_judges_and_round_trips(spark):
    pairs = spark.createDataFrame([(1, "a", "b"), (2, None, "d")], "k long, src string, tgt string")
    raters = {"good": lambda s, t: '{"fluency": 4, "accuracy": 9}', "broken": lambda s, t: "no idea"}
    got = sorted((r.unit, r.rater, r.criterion, r.value) for r in plugins.judge(pairs, "k", raters, ("fluency", "accuracy")).where("value is not null").collect())
    assert got == [(1, "good", "fluency", 4), (2, "good", "fluency", 4)] and plugins.judge(pairs, "k", raters, ("fluency", "accuracy")).count() == 8

    def failing(texts):
        raise TimeoutError

    up = lambda xs: [x.upper() for x in xs]
    assert sorted(r.hyp for r in plugins.round_trip(pairs, up, lambda xs: [x + "!" for x in xs]).collect()) == ["!", "A!"]
    assert [r.hyp for r in plugins.round_trip(pairs, up, failing).collect()] == [None, None]


def test_ngram_counts_against_brute_force():
    import collections
    import random

    rnd = random.Random(1)
    for _ in range(50):
        h, r = ([rnd.choice("abc") for _ in range(rnd.randint(0, 12))] for _ in "hr")
        for n, matched, nh, nr in evaluate.clipped_matches(h, r, range(1, 5)):
            a, b = (collections.Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (h, r))
            assert (matched, nh, nr) == (sum((a & b).values()), sum(a.values()), sum(b.values()))


def test_lineage_and_places(spark):
    s = spark.createDataFrame([(0, "one two"), (1, "two two"), (2, "one two")], "idx long, text string")
    v = s.where("idx < 2").select("idx", align.text_hash(F.expr("if(idx = 1, 'old', text)")).alias("text_hash"), F.array(F.lit(1.0)).alias("embedding"))
    assert [r.idx for r in align.with_embeddings(s, v).collect()] == [0]
    assert sorted(r.idx for r in align.stale(s, v).collect()) == [1, 2]
    assert align.dedup_keep_first(s).count() == 2 and align.dedup_keep_first(s, dedup=False).count() == 3
    with pytest.raises(Exception, match="no index or range"):
        spark.createDataFrame([("1,x",)], "t string").select(align.expand_range(F.col("t"))).collect()
    assert spark.createDataFrame([("1,x",)], "t string").select(align.expand_range(F.col("t"), strict=False).alias("r")).first().r == [1]


def test_mean_agreement_of_models(spark):
    rows = [(m, "c", u, r, (u + (r if m == "b" else 0)) % 3) for m in "ab" for u in range(6) for r in range(2)]
    got = {r.model: (r.n_criteria, r.mean_alpha) for r in evaluate.model_scores(spark.createDataFrame(rows, "model string, criterion string, unit int, rater int, value int")).collect()}
    assert got["a"] == (1, 1.0) and got["b"][1] < 0.5


def test_resumable_ingest(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "tap4_0001.png").write_bytes(b"one")
    run = lambda: ingest.ingest_images(spark, str(source), str(tmp_path / "out"), str(tmp_path / "ck"), lambda d: plugins.recognise(d, lambda c: [c.decode()]))
    run()
    (source / "tap4_0002.png").write_bytes(b"\xff")
    (source / "tap4_0003.png").write_bytes(b"three")
    run()
    done = spark.read.parquet(str(tmp_path / "out")).orderBy("page").collect()
    assert [(r.page, r.text) for r in done] == [(1, "one"), (3, "three")]
    assert [r.page for r in ingest.failed_pages(spark, str(tmp_path / "out")).collect()] == [2]


def test_stage_runner(spark, tmp_path):
    text = "甲子年。乙丑月！丙寅日？"
    docs = spark.createDataFrame([(0, "src", text), (0, "tgt", text.replace("。", "。 ").replace("！", "！ "))], "doc long, side string, text string")
    config = stages.CorpusConfig(out=str(tmp_path / "c"))
    got = stages.run(spark, docs, config).orderBy("pair_id").collect()
    assert [(r.han_sentence, r.viet_sentence) for r in got] == [("甲子年。", "甲子年。"), ("乙丑月!", "乙丑月！"), ("丙寅日?", "丙寅日？")]
    assert stages.Manifest(spark, config.base).done("export")
    assert stages.run(spark, docs, config, "resume").count() == 3
    lines = spark.createDataFrame([(0, "src", "a b。c\n\n d "), (0, "tgt", "x")], "doc long, side string, text string")
    assert [(r.side, r.idx, r.text) for r in stages.sentences(lines, True).orderBy("side", "idx").collect()] == [("src", 0, "a b。c"), ("src", 1, "d"), ("tgt", 0, "x")]
    manifest = stages.Manifest(spark, config.base)
    assert manifest.snapshot("_old", dry_run=True) == [f"{n} -> {n}_old" for n in stages.ORDER] and manifest.done("export")
    assert manifest.snapshot("_old", ("align", "export")) == ["align -> align_old", "export -> export_old"] and not manifest.done("export") and manifest.done("embed")
    assert manifest.snapshot("_old", ("export",)) == ["missing: export"]
    assert stages.CorpusConfig.from_env({"CORPUS_SUBSET": "2", "CORPUS_SUBSET_OFFSET": "1"}).base == "corpus-out_sub2_off1"
