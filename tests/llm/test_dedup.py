"""Substring, suffix and SimHash dedup against brute force, with small windows so that groups get large."""

import collections
import hashlib
import random
import re

import pytest
import xxhash

from paracorpus.llm import components, near_copies, repeats, simhash, substring_dedup, suffix_dedup
from paracorpus.llm.suffix_merge import LoserTree, common_prefix, common_suffix, front_code

ROWS = "doc_id long, text string, lang string, h string, s int"


def corpus():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 3)))
    passage = " ".join(word() for _ in range(30))
    out = [None, "", "  ", "x", "a " * 200, "ab" * 150, passage]
    for i in range(60):
        body = [word() for _ in range(rnd.randint(0, 40))]
        if i % 3 == 0:
            body.insert(len(body) // 2, passage)
        out.append(rnd.choice(["\t", " ", "\n"]).join(body))
    base = " ".join(word() for _ in range(60)).split()
    for i in range(40):  # near copies
        copy = list(base)
        copy[i] = "zz"
        out.append(" ".join(copy))
    out += [" ".join(base)] * 20
    return out


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "x", 0) for i, t in enumerate(texts)], ROWS)


@pytest.mark.parametrize("hot", [1_000_000, 5])
@pytest.mark.parametrize("few", [12, 1])
def test_suffix_dedup(spark, monkeypatch, hot, few):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "FEW", few)
    texts, w = corpus(), 40
    seen = {}
    blobs = [(t or "").encode() for t in texts]
    for i, b in enumerate(blobs):
        for j in range(len(b) - w + 1):
            seen[b[j : j + w]] = seen.get(b[j : j + w], 0) + 1
    got = {r.doc_id: r for r in suffix_dedup.dedup(frame(spark, texts), w, 8).collect()}
    assert len(got) == len(texts)
    for i, b in enumerate(blobs):
        gone = {p for j in range(len(b) - w + 1) if seen[b[j : j + w]] > 1 for p in range(j, j + w)}
        kept = bytes(c for p, c in enumerate(b) if p not in gone)
        spans = sum(p - 1 not in gone for p in gone)
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.kept_sha256) == (len(b), len(gone), spans, kept, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("hot", [1_000_000, 5])
def test_substring_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    texts, w = corpus(), 12
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    first = {}
    for i, ws in enumerate(words):
        for j in range(len(ws) - w + 1):
            first.setdefault(tuple(ws[j : j + w]), i)
    got = {r.doc_id: r for r in substring_dedup.dedup(frame(spark, texts), w, 4).collect()}
    for i, ws in enumerate(words):
        gone = {p for j in range(len(ws) - w + 1) if first[tuple(ws[j : j + w])] < i for p in range(j, j + w)}
        kept = b" ".join(x for p, x in enumerate(ws) if p not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept.encode()) == (len(ws), len(gone), kept)


def test_one_doc_id_with_two_texts_and_repeated_rows(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    a, b = (" ".join(word() for _ in range(90)) for _ in "ab")
    c = b[:200] + " own " + " ".join(word() for _ in range(70))
    rows = [(1, a), (1, b), (2, a), (2, a), (3, c), (3, c), (4, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = collections.Counter(r[1][i : i + 400] for r in rows for i in range(len(r[1]) - 399))
    want = [(d, len({p for i in range(len(t) - 399) if whole[t[i : i + 400]] > 1 for p in range(i, i + 400)})) for d, t in rows]
    assert sorted((r.doc_id, r.n_removed) for r in suffix_dedup.dedup(df).collect()) == sorted(want)
    first = {}
    for d, t in rows:
        w = t.split()
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(d, first.get(k, d))
    words = [(d, len({p for i in range(len(t.split()) - 49) if first[tuple(t.split()[i : i + 50])] < d for p in range(i, i + 50)})) for d, t in rows]
    assert sorted((r.doc_id, r.n_removed) for r in substring_dedup.dedup(df).collect()) == sorted(words)


@pytest.mark.parametrize("hot", [1_000_000, 5])
@pytest.mark.parametrize("few", [12, 1])
def test_suffix_dedup_by_words(spark, monkeypatch, hot, few):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "FEW", few)
    texts, w = corpus(), 12
    places = [[(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for t in texts]
    words = [[(t or "").encode()[s:e] for s, e in ps] for t, ps in zip(texts, places, strict=True)]
    seen = collections.Counter(tuple(ws[j : j + w]) for ws in words for j in range(len(ws) - w + 1))
    got = {r.doc_id: r.text for r in suffix_dedup.clean(frame(spark, texts), w, 4, words=True).collect()}
    for i, (t, ws, ps) in enumerate(zip(texts, words, places, strict=True)):
        gone = {p for j in range(len(ws) - w + 1) if seen[tuple(ws[j : j + w])] > 1 for p in range(j, j + w)}
        blob = (t or "").encode()
        drop = {x for p in gone for x in range(ps[p][0], ps[p + 1][0] if p + 1 in gone else ps[p][1])}
        assert (got[i] or "").encode() == bytes(c for x, c in enumerate(blob) if x not in drop), i


def test_long_texts_are_scanned_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_PIECE", 64)
    texts, w = corpus(), 40
    cut = [v for v in repeats.byte_units([(t or "").encode() for t in texts], w)]
    assert max(len(v) for _, _, v in cut) <= 64 + w
    whole = sum(max(0, len((t or "").encode()) - w + 1) for t in texts)
    assert sum(max(0, len(v) - w + 1) for _, _, v in cut) == whole


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_removed) for r in substring_dedup.dedup(df).collect()))
    assert got == [(0, 0), (1, 0), (1, 0), (2, 80)]
    kept = suffix_dedup.clean(spark.createDataFrame([(1, "é" * 300, 5), (2, "é" * 300, 6), (None, "é" * 300, 7)], "doc_id long, text string, doc int")).orderBy("doc").collect()
    assert [(r.doc, r.text) for r in kept] == [(5, ""), (6, ""), (7, "é" * 300)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.dedup(none).count() == suffix_dedup.dedup(none).count() == simhash.near_duplicates(none).count() == 0


def test_loser_tree_merges_and_knows_prefixes():
    rnd = random.Random(2)
    runs = [sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 30))) for _ in range(7)]
    tree = LoserTree([[(s, r, k) for s, r, k in zip(*front_code(run), run, strict=True)] for run in runs])
    out = list(tree)
    want = sorted(k for run in runs for k in run)
    assert [k for k, _, _ in out] == want == [v for _, _, v in out]
    assert [s for _, s, _ in out][1:] == [common_prefix(a, b) for a, b in zip(want, want[1:], strict=False)]
    assert list(LoserTree([])) == [] and common_suffix(b"xab", b"yab") == 2 and common_suffix(b"", b"a") == 0


@pytest.mark.parametrize("hot", [512, 2])
def test_simhash_links(spark, hot):
    rnd = random.Random(4)
    centres = [rnd.getrandbits(64) for _ in range(15)]
    fps = list({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for c in centres for _ in range(25)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {tuple(sorted(r)) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), hot).collect()}
    want = {tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert got == want
    tallied = {tuple(sorted(r)) for r in simhash.candidates(spark.createDataFrame([(f,) for f in signed], "fp long"), hot).collect()}
    shared = lambda a, b: sum((a >> 8 * i) & 255 == (b >> 8 * i) & 255 for i in range(8))
    assert tallied >= want and all(shared(a, b) >= 6 for a, b in tallied)
    if hot == 512:  # the tally decides what is verified: each pair of a list with six bytes in common, and no other
        meet = {tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[:i] if shared(a, b) >= 6 and sum((a ^ b) >> 16 * k & 0xFFFF == 0 for k in range(4)) >= 2}
        assert tallied == meet and len(tallied) > len(want)


def test_simhash_groups(spark):
    texts = [*corpus(), "Same THREE words here", "same three WORDS here", None]
    got = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, texts)).collect()}

    def fp(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(t) for t in texts]
    root = list(range(len(fps)))
    for _ in fps:
        root = [min(root[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 2) for i in range(len(fps))]
    assert [(got[i].fp & (1 << 64) - 1, got[i].component_id) for i in range(len(fps))] == list(zip(fps, root, strict=True))
    assert sorted(r.doc_id for r in simhash.one_of_each(frame(spark, texts)).collect()) == sorted(set(root))


@pytest.mark.parametrize("cells", [1 << 22, 1 << 10])
def test_near_copies_of_the_pipeline(spark, monkeypatch, cells):
    import corpus_pipeline

    real = near_copies.levels
    monkeypatch.setattr(near_copies, "levels", lambda docs, shingle: real(docs, shingle, cells))
    rnd = random.Random(6)
    common = [f"common{i}" for i in range(12)]
    texts = [None, "", "two words", "Two  WORDS", "two words"]
    for k in range(12):
        base = [f"w{k}x{rnd.randint(0, 400)}" for _ in range(rnd.randint(20, 160))] + common
        for edits in (0, 0, 1, 2, 3, 4, 6):
            copy = list(base)
            for i in range(edits):
                copy[rnd.randrange(len(copy))] = f"e{k}x{edits}x{i}"
            texts.append(" ".join(copy))
        chain = list(base)
        for i in range(6):  # each links to the one before, few to the first
            chain[7 * i % len(chain)] = f"c{i}"
            texts.append(" ".join(chain))
    rnd.shuffle(texts)

    def held(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [held(t) for t in texts]
    alike = lambda x, y: x == y or 5 * len(x & y) >= 4 * len(x | y)
    near = [[j for j in range(len(sets)) if alike(sets[i], sets[j])] for i in range(len(sets))]
    root = list(range(len(sets)))
    for _ in sets:
        root = [min(root[j] for j in near[i]) for i in range(len(sets))]
    # SimHash at two bits, the stage before, keeps more
    assert simhash.one_of_each(frame(spark, texts)).count() > len(set(root))
    assert sorted(r.doc_id for r in corpus_pipeline.simhash_near_dedup(spark, frame(spark, texts), "").collect()) == sorted(set(root))


def test_the_pipeline_cuts_passages_of_51_words(spark):
    import corpus_pipeline

    own = lambda k: " ".join(f"{k}own{i}" for i in range(40))
    passage = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 2)}cde" for i in range(51))
    letters = " ".join(chr(97 + i * i % 26) for i in range(51))  # 101 bytes
    fewer = " ".join(f"few{i}" for i in range(30))
    assert 295 <= len(passage) <= 310
    texts = [f"{own(2 * k + i)} {x} {own(20 + 2 * k + i)}" for k, x in enumerate((passage, letters, fewer)) for i in range(2)]
    got = {r.doc_id: r.text for r in corpus_pipeline.suffix_array_dedup(spark, frame(spark, texts), "").collect()}
    assert [x in got[2 * k + i] for k, x in enumerate((passage, letters, fewer)) for i in range(2)] == [False] * 4 + [True] * 2
    assert all(own(k).split()[5] in got[k] and own(20 + k).split()[5] in got[k] for k in range(6))
    assert len(got[0]) < len(texts[0]) - 290 and got[4] == texts[4]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 100)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in (100, 101, 102)}
