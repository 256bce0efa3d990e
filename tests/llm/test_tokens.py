"""Token counts, codec and packing against the tokenizers library."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paracorpus.llm import bpe, bpe_codec, packing, token_counts

ODD = [
    None, "", " ", "\n", "a  b", " a", " \n a", "x\n \ny  ", "trail ", "x\n ", "<|endoftext|>foo <|endoftext|>", "<|startoftext|>Hi", "ΑΣ ΌΣΟΣ Σ", "don't I'LL we've",
    "a\x1cb \x1d c", "½²³ 123", "é ́x", "a b　c", "日本語 テキスト!!", "x" * 3000, "ab" * 400 + " z", "a\x85b", "İI", "ﬁ ffi", "\U0001f600 ok", "a \x00b", "the " * 3000,
]


def texts():
    rnd = random.Random(5)
    alphabet = "ab 'sS\n\té中́Σ1½!\x1c\x85​　<|"
    return ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40))) for _ in range(300)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i}", 1) for i, t in enumerate(texts())] + [(None, "no id", "en", "s", 1), (3, ODD[3], "en", "s3", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens string, ids int")


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def test_counts_are_the_library_s(docs):
    t = library("byte_bpe_50k.json")
    got = token_counts.token_counts(docs, limit=50).collect()
    assert len(got) == len(texts()) + 2
    for r in got:
        text = "no id" if r.doc_id is None else texts()[r.doc_id] or ""
        n = len(t.encode(text).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 50), text[:40]
        if n <= 50:
            assert r.fitting_bytes == r.n_bytes


def test_every_code_point_is_read_as_the_library_reads_it():
    texts = [f"a{chr(i)}b" for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    words, counter = bpe.word_codec(public_tokenizers.path("word_bpe_49k.json")), bpe.byte_counter(public_tokenizers.path("byte_bpe_50k.json"))
    by_word, by_byte = library("word_bpe_49k.json"), library("byte_bpe_50k.json")
    for at in range(0, len(texts), 50_000):
        some = texts[at : at + 50_000]
        assert words.encode(some) == [np.array(e.ids, "<u4").tobytes() for e in by_word.encode_batch(some, add_special_tokens=False)]
        assert [sum(c) for c in counter.count_many(some)[1]] == [len(e.ids) for e in by_byte.encode_batch(some, add_special_tokens=False)]


def test_caches_are_bounded_and_dropped_when_idle(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50_000)
    monkeypatch.setattr(bpe, "IDLE", 0.1)
    codec = bpe.WordCodec(public_tokenizers.path("word_bpe_49k.json"))
    for k in range(20):
        some = [f"w{k}x{i} y{i}" for i in range(50)]
        assert codec.encode(some) == [np.array(e.ids, "<u4").tobytes() for e in library("word_bpe_49k.json").encode_batch(some, add_special_tokens=False)] if k % 7 == 0 else codec.encode(some)
        assert codec.chunks.taken < 50_000 + 30_000
    time.sleep(1)
    assert not codec.chunks and not codec.words and codec.encode(["a b"]) and codec.round_trip(["a b"])


def test_python_sees_each_word_once_however_it_is_written(monkeypatch):
    codec, lib, seen = bpe.WordCodec(public_tokenizers.path("word_bpe_49k.json")), library("word_bpe_49k.json"), []
    encode_words = codec.bpe.encode_words
    monkeypatch.setattr(codec.bpe, "encode_words", lambda words: seen.append(words) or encode_words(words))
    some = ["Qwat qwat, QWAT. qwat\tqwat", "", " ", "qwat.. ,qwat ., . , a.b É. é, İ, Σ. 1. \u0130x. K\u0130, J\u030c, \u01f0", "Ab\xa0Ab.\x1cAb, Ab\u3000", "A<|endoftext|>.A<|ENDOFTEXT|>, <|startoftext|>,", *ODD[1:]]
    assert codec.encode(some) == [np.array(e.ids, "<u4").tobytes() for e in lib.encode_batch(some, add_special_tokens=False)]
    assert {c for c in codec.chunks if c.lower().rstrip(".,") == "qwat"} == {"qwat", "qwat.."}
    assert len(seen) == 1 and len(seen[0]) == len(set(seen[0]))
    assert codec.encode([]) == [] and codec.encode([""]) == [b""]


@pytest.mark.parametrize("block", [1, 7, 16_384])
def test_words_of_all_lengths_in_blocks_are_merged_exactly(monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK", block)
    codec, rnd = bpe.Bpe(public_tokenizers.path("word_bpe_49k.json")), random.Random(3)
    words = ["".join(rnd.choice("abeinorst\xc3\xa9'1") for _ in range(n)) + bpe.END for n in range(1, 40) for _ in range(8)] + [""]
    assert codec.encode_words(words) == [np.array(codec.exact(w), "<u4").tobytes() if w else b"" for w in words]
    keys = np.array([k for k in codec.pairs if k >= 0])
    assert len(keys) and codec.compatible_many(keys).tolist() == [codec.exact(codec.texts[k >> 20] + codec.texts[k & 0xFFFFF]) == [k >> 20, k & 0xFFFFF] for k in keys.tolist()]


def test_prefix_counts_of_every_prefix():
    b = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(1)
    for _ in range(200):
        w = "".join(rnd.choice("theringonaed") for _ in range(rnd.randint(1, 14)))
        assert b.prefix_counts(w) == [0, *(len(b.exact(w[:i])) for i in range(1, len(w) + 1))]
        assert list(b.prefixes([w])[0]) == b.prefix_counts(w)[1:]


def test_counts_at_every_byte(docs):
    b = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    for r in token_counts.every_prefix(docs.where("doc_id is null or doc_id between 2 and 60")).collect():
        text = "no id" if r.doc_id is None else texts()[r.doc_id] or ""
        want, before = [], 0
        parts = [x for i, p in enumerate(re.split(r"(<\|endoftext\|>)", text)) for x in ([p] if i % 2 else bpe._BYTE.findall(p))]
        for w in parts:
            latin = w.encode().decode("latin-1")
            counts = [len(b.exact(latin[:i])) for i in range(1, len(latin) + 1)]
            if w in b.special:
                counts[-1] = 1
            want += [before + c for c in counts]
            before += counts[-1]
        assert list(r.counts) == want, text[:40]


def test_prefix_table_answers_budgets(docs):
    t = library("byte_bpe_50k.json")
    for r in token_counts.prefix_counts(docs.where("doc_id between 4 and 30")).collect():
        text = (texts()[r.doc_id] or "").encode()
        assert not r.counts or r.counts[-1] == len(t.encode(text.decode()).ids)


def test_codec_is_the_library_s(docs):
    t = library("word_bpe_49k.json")
    for r in bpe_codec.digests(docs).collect():
        text = "no id" if r.doc_id is None else texts()[r.doc_id] or ""
        ids = t.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), ascii(text[:40])
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe_codec.encode(docs.where("doc_id = 4")).first().ids == t.encode("a  b", add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [8, 4096])
def test_packing(docs, capacity):
    t = library("word_bpe_49k.json")
    rows = packing.pack(docs, capacity).collect()
    bins, total = {}, 0
    for r in rows:
        text = "no id" if r.doc_id is None else texts()[r.doc_id] or ""
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], "<u4")
        part = ids[r.piece * capacity : (r.piece + 1) * capacity]
        assert r.start == r.piece * capacity and r.length == len(part) and r.ids_crc32 == zlib.crc32(part.tobytes())
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total += r.length
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= -(-total // capacity) * 1.1 + 1


def test_open_bins_are_bounded_and_best_fit():
    bins = packing.OpenBins(10, 2)
    assert bins.put(6, "a") == [] and bins.put(7, "b") == []
    assert bins.put(3, "c") == [[(0, "b"), (7, "c")]]  # the fullest that takes it, and it is full
    assert bins.put(8, "d") == [] and bins.put(9, "e") == [[(0, "e")]]  # three are open: the fullest closes


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(none).count() == bpe_codec.digests(none).count() == packing.pack(none).count() == 0
