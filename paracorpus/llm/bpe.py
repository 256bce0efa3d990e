"""Byte-pair encoding on merge lists: exact merging, compatibility of neighbours, prefix counts.

A token's text is written with one Latin-1 character a byte; ``END`` follows the last byte of a
word in vocabularies that mark word ends.  The facts used: a sequence of tokens is the encoding
of its text if and only if every token encodes to itself and every adjacent pair encodes to
itself; so a prefix has exactly one last token, and its count is one more than the count of what
stands before that token.
"""

from __future__ import annotations

import array
import contextlib
import ctypes
import functools
import heapq
import json
import re
import threading

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

END = "Ā"
#: Bytes of a worker's caches by white-space chunk and by word before one is emptied, at ``ENTRY`` bytes for the objects of an entry.
CACHE, WORD_CACHE, ENTRY = 320_000_000, 96_000_000, 200
#: Seconds without a task after which a worker drops its caches, which would else lie beside the next stage's memory.
IDLE = 2.0
#: White space of the tokenizers' patterns (Unicode White_Space); ``str.split`` also takes U+001C..U+001F.
WHITE = "\t-\r \x85\xa0  -     　"
#: The pre-tokenizing patterns of the two vocabulary files.
BYTE_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"


@functools.lru_cache(maxsize=1)
def _byte_chars() -> dict[str, str]:
    """From the printable stand-in of a byte in vocabulary files to its Latin-1 character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): chr(b) for b in plain} | {chr(256 + i): chr(b) for i, b in enumerate(rest)}


#: Longest pre-token, in bytes, that goes through the vectorised code; longer ones are rare and go one by one.
WIDE = 32
#: Words of about one length that are encoded together, so that their matrices have little padding.
BLOCK = 16_384
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(1099511628211)
_POWERS = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(256, _BASE)]))
BIG = 1 << 40


class Table:
    """Open addressing from 64-bit keys to integers, looked up by whole arrays; -1 where a key is missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        bits = max(8, int(len(keys)).bit_length() + 3)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int64)
        self.probes, left = 0, np.arange(len(keys))
        at = self._slot(keys)
        while len(left):
            self.probes += 1
            free = left[self.values[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[at[placed]], self.values[at[placed]] = keys[placed], values[placed]
            left = np.setdiff1d(left, placed)
            at[left] = (at[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        same, held = self.keys[at] == keys, self.values[at]
        out = np.where(same, held, -1)
        # only occupied slots of another key can have sent this key further
        left = np.flatnonzero(~same & (held >= 0))
        for step in range(1, self.probes):
            if not len(left):
                break
            to = (at[left] + step) & self.mask
            hit = self.keys[to] == keys[left]
            out[left[hit]] = self.values[to[hit]]
            left = left[~hit & (self.values[to] >= 0)]
        return out


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Padded code matrix of Latin-1 (and END) words, and their lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-16-le"), np.uint16)
    out = np.zeros((len(words), int(sizes.max(initial=1))), np.uint64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat.astype(np.uint64) + np.uint64(1)
    return out, sizes


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + codes[:, i]
    return out


def hashed(words: list[str]) -> np.ndarray:
    """64-bit polynomial hashes of words of any length."""
    out = np.zeros(len(words), np.uint64)
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for at in range(0, len(order), 4096):
        some = order[at : at + 4096]
        codes, sizes = _codes([words[i] for i in some])
        out[some] = _prefix_hashes(codes)[np.arange(len(some)), sizes]
    return out


def _id_bytes(tokens: np.ndarray, count: np.ndarray) -> list[bytes]:
    """The first ``count`` tokens of each row as little-endian unsigned 32-bit bytes."""
    held, width = tokens.astype("<u4").tobytes(), 4 * tokens.shape[1]
    return [held[a : a + 4 * n] for a, n in zip(range(0, len(held), width), count.tolist(), strict=True)] if width else [b""] * len(tokens)


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, plain = spec["model"], _byte_chars()
        suffix = model.get("end_of_word_suffix") or ""

        def latin(token: str) -> str:
            ends = suffix and token.endswith(suffix) and token != suffix
            return "".join(plain[c] for c in (token[: -len(suffix)] if ends else token)) + END * bool(ends)

        self.suffix = suffix
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        known = {t: i for t, i in model["vocab"].items() if t not in self.special}
        self.names = {i: t for t, i in known.items()} | {i: t for t, i in self.special.items()}
        self.ids = {latin(t): i for t, i in known.items()}
        self.texts = {i: t for t, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = map(latin, pair.split(" ") if isinstance(pair, str) else pair)
            self.merges[self.ids[a] << 20 | self.ids[b]] = (rank, self.ids[a + b])
        self.pairs: dict[int, bool] = {}
        self.token_table = Table(hashed(list(self.ids)), np.fromiter(self.ids.values(), np.int64, len(self.ids)))
        keys = np.fromiter(self.merges, np.uint64, len(self.merges))
        self.merge_table = Table(keys, np.array([r for r, _ in self.merges.values()], np.int64))
        self.merged = np.zeros(1 + max(r for r, _ in self.merges.values()), np.int64)
        for rank, new in self.merges.values():
            self.merged[rank] = new
        base = [[self.ids.get(chr(b) + e, -1) for b in range(256)] for e in ("", END)]
        self.base = np.array(base, np.int64)
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    # -- exact merging ------------------------------------------------------------------------

    def symbols(self, text: str) -> list[int]:
        if text.endswith(END):
            return [self.ids[c] for c in text[:-2]] + [self.ids[text[-2:]]]
        return [self.ids[c] for c in text]

    def exact(self, text: str) -> list[int]:
        """Merge by rank, leftmost first among equals."""
        ids = self.symbols(text)
        if len(ids) > 40:
            return self._exact_long(ids)
        merges = self.merges
        while len(ids) > 1:
            best, at, new = 1 << 30, -1, 0
            for i in range(len(ids) - 1):
                found = merges.get(ids[i] << 20 | ids[i + 1])
                if found and found[0] < best:
                    (best, new), at = found, i
            if at < 0:
                break
            ids[at : at + 2] = [new]
        return ids

    def _exact_long(self, ids: list[int]) -> list[int]:
        n, merges = len(ids), self.merges
        left, right, heap = list(range(-1, n - 1)), [*range(1, n), -1], []

        def offer(i: int) -> None:
            j = right[i]
            if j >= 0 and (found := merges.get(ids[i] << 20 | ids[j])):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = right[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            right[j] = -1
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [x for x in ids if x >= 0]

    # -- compatibility ------------------------------------------------------------------------

    def alone(self, token: int) -> bool:
        """Does the token's text encode to the token?"""
        key = -1 - token
        if key not in self.pairs:
            self.pairs[key] = self.exact(self.texts[token]) == [token]
        return self.pairs[key]

    def compatible(self, a: int, b: int) -> bool:
        key = a << 20 | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) * ENTRY > CACHE:
                self.pairs.clear()
            found = self.pairs[key] = self.exact(self.texts[a] + self.texts[b]) == [a, b]
        return found

    # -- prefix dynamic programming -----------------------------------------------------------

    def prefix_counts(self, text: str) -> list[int]:
        """Exact token counts of all prefixes of one pre-token, by bytes: element i is for the first i."""
        ids, pairs, longest, n = self.ids, self.pairs, self.longest, len(text)
        last, count = [0] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            for j in range(max(0, i - longest), i):
                t = ids.get(text[j:i])
                if t is None:
                    continue
                if j:
                    ok = pairs.get(last[j] << 20 | t)
                    if ok is None:
                        ok = self.compatible(last[j], t)
                else:
                    ok = self.alone(t)
                if ok:
                    last[i], count[i] = t, count[j] + 1
                    break
        return count

    # -- speculate and verify -----------------------------------------------------------------

    def compatible_many(self, keys: np.ndarray) -> np.ndarray:
        """``compatible`` for pair keys ``a << 20 | b``: each distinct pair is settled once."""
        distinct, back = np.unique(keys, return_inverse=True)
        get, mask = self.pairs.get, (1 << 20) - 1
        listed = distinct.tolist()
        found = list(map(get, listed))
        new = [i for i, ok in enumerate(found) if ok is None]
        texts = [self.texts[listed[i] >> 20] + self.texts[listed[i] & mask] for i in new]
        short = [(i, t) for i, t in zip(new, texts, strict=True) if len(t) <= WIDE]
        if short:
            keys = distinct[[i for i, _ in short]]
            both = _id_bytes(np.stack([keys >> 20, keys & mask], 1), np.full(len(keys), 2))
            if len(self.pairs) * ENTRY > CACHE:
                self.pairs.clear()
            for (i, _), merged, two in zip(short, self.merge_many([t for _, t in short]), both, strict=True):
                found[i] = self.pairs[listed[i]] = merged == two
        for i, t in zip(new, texts, strict=True):
            if len(t) > WIDE:
                found[i] = self.compatible(listed[i] >> 20, listed[i] & mask)
        return np.array(found, bool)[back] if found else np.zeros(0, bool)

    def alone_many(self, tokens: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(tokens, return_inverse=True)
        return np.array([self.alone(t) for t in distinct.tolist()], bool)[back]

    def greedy_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Longest matches from the left: a matrix of tokens, -1 behind the last, and how many; 0 where stuck."""
        codes, sizes = _codes(words)
        prefix, rows = _prefix_hashes(codes), np.arange(len(words))
        out, count, at = np.full(codes.shape, -1, np.int64), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        while len(rows):
            stuck = rows
            for n in range(min(self.longest, codes.shape[1]), 0, -1):
                open_ = at[stuck] + n <= sizes[stuck]
                some = stuck[open_]
                if not len(some):
                    continue
                found = self.token_table.get(prefix[some, at[some] + n] - prefix[some, at[some]] * _POWERS[n])
                known = found >= 0
                hit = some[known]
                out[hit, count[hit]] = found[known]
                count[hit] += 1
                at[hit] += n
                open_[open_] = known
                stuck = stuck[~open_]
            count[stuck], at[stuck] = 0, sizes[stuck]
            rows = rows[at[rows] < sizes[rows]]
        return out, count

    def merge_many(self, words: list[str]) -> list[bytes]:
        """``exact`` for many words, as bytes: all rows of a matrix take their lowest-ranked merge in step."""
        out: list[bytes] = [b""] * len(words)
        texts = [w[:-1] if w.endswith(END) else w for w in words]
        codes, sizes = _codes(texts)
        ends = np.array([w.endswith(END) for w in words])
        raw = np.maximum(codes.astype(np.int64) - 1, 0)
        ids = np.where(np.arange(codes.shape[1]) < sizes[:, None], self.base[0][raw], -1)
        last = np.flatnonzero(ends)
        ids[last, sizes[last] - 1] = self.base[1][raw[last, sizes[last] - 1]]
        rows = np.arange(len(words))

        def ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            found = self.merge_table.get((np.maximum(a, 0) << 20 | np.maximum(b, 0)).astype(np.uint64))
            return np.where((found < 0) | (a < 0) | (b < 0), BIG, found)

        rank = ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while True:
            best = rank.argmin(1) if rank.shape[1] else np.zeros(len(ids), np.int64)
            low = rank[np.arange(len(ids)), best] if rank.shape[1] else np.full(len(ids), BIG)
            done = low >= BIG
            for r, x in zip(rows[done].tolist(), _id_bytes(ids[done], (ids[done] >= 0).sum(1)), strict=True):
                out[r] = x
            if done.all():
                return out
            ids, rank, rows, best, low = ids[~done], rank[~done], rows[~done], best[~done, None], low[~done]
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols > best), 1)
            here = np.arange(len(ids))
            at = best[:, 0]
            ids[here, at] = new = self.merged[low]
            cols = cols[:-1]
            rank = np.take_along_axis(rank, cols + (cols >= best), 1) if len(cols) else rank[:, :0]
            if len(cols):
                x = np.flatnonzero(at > 0)
                rank[x, at[x] - 1] = ranks(ids[x, at[x] - 1], new[x])
                x = np.flatnonzero(at < len(cols))
                rank[x, at[x]] = ranks(new[x], ids[x, at[x] + 1])

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Encodings of many words, as bytes: greedy proposals, all adjacent pairs checked at once, failing words merged."""
        out: list[bytes] = [b""] * len(words)
        wide = [i for i, w in enumerate(words) if len(w) > WIDE]
        for i in wide:
            out[i] = np.array(self.exact(words[i]), "<u4").tobytes()
        order = sorted((i for i, w in enumerate(words) if 0 < len(w) <= WIDE), key=lambda i: len(words[i]))
        for first in range(0, len(order), BLOCK):
            self._encode_block(words, order[first : first + BLOCK], out)
        return out

    def _encode_block(self, words: list[str], at: list[int], out: list[bytes]) -> None:
        some = [words[i] for i in at]
        tokens, count = self.greedy_many(some)
        bad = count == 0
        bad[count == 1] |= ~self.alone_many(tokens[count == 1, 0]) if (count == 1).any() else False
        pairs = (tokens[:, 1:] >= 0) & ~bad[:, None]
        keys = (tokens[:, :-1] << 20 | tokens[:, 1:])[pairs]
        failed = np.zeros(pairs.shape, bool)
        failed[pairs] = ~self.compatible_many(keys)
        bad |= failed.any(1)
        for i, x in zip(at, _id_bytes(tokens, count), strict=True):
            out[i] = x
        again = np.flatnonzero(bad).tolist()
        for i, x in zip(again, self.merge_many([some[i] for i in again]) if again else [], strict=True):
            out[at[i]] = x

    def prefixes(self, words: list[str]) -> list:
        """``prefix_counts`` of many pre-tokens, from the first byte on: the recurrence runs over all of them, position by
        position.  Element i is the count of the first i + 1 bytes."""
        out: list = [b""] * len(words)
        for i, w in enumerate(words):
            if len(w) > WIDE:
                out[i] = array.array("I", self.prefix_counts(w)[1:])
        order = sorted((i for i, w in enumerate(words) if 0 < len(w) <= WIDE), key=lambda i: -len(words[i]))
        if not order:
            return out
        codes, sizes = _codes([words[i] for i in order])
        prefix, n = _prefix_hashes(codes), codes.shape[1]
        last, count = np.full((n + 1, len(order)), -1, np.int64), np.zeros((n + 1, len(order)), np.int64)
        active = [int((sizes >= i).sum()) for i in range(n + 1)]
        columns = [np.ascontiguousarray(prefix[:, i]) for i in range(n + 1)]
        for i in range(1, n + 1):
            todo = np.arange(active[i])
            for j in range(max(0, i - self.longest), i):
                if not len(todo):
                    break
                t = self.token_table.get(columns[i][todo] - columns[j][todo] * _POWERS[i - j])
                hit, t = todo[t >= 0], t[t >= 0]
                if not len(hit):
                    continue
                ok = self.compatible_many(last[j][hit] << 20 | t) if j else self.alone_many(t)
                hit, t = hit[ok], t[ok]
                last[i, hit], count[i, hit] = t, count[j, hit] + 1
                todo = todo[last[i, todo] < 0]
        held = np.ascontiguousarray(count[1:].T).astype(np.uint8).tobytes()  # a short word has no more tokens than bytes
        for k, (i, size) in enumerate(zip(order, sizes.tolist(), strict=True)):
            out[i] = held[k * n : k * n + size]
        return out


class Cache(dict):
    """A dictionary that knows about how many bytes its entries take, ``most`` before it is emptied."""

    def __init__(self, most: int):
        super().__init__()
        self.taken, self.most = 0, most

    def add(self, keys, values) -> None:
        """New entries; values are bytes or numbers."""
        keys, values = list(keys), list(values)
        self.update(zip(keys, values, strict=True))
        self.taken += sum(map(len, keys)) + ENTRY * len(keys) + (sum(map(len, values)) if values and isinstance(values[0], bytes) else 0)

    def clear(self) -> None:
        super().clear()
        self.taken = 0

    def bound(self) -> None:
        if self.taken > self.most:
            self.clear()


class Caches:
    """Caches of a worker that outlive its tasks, but not a pause between them."""

    def __init__(self):
        self.words, self.chunks, self.decoded = Cache(WORD_CACHE), Cache(CACHE), Cache(CACHE // 2)
        self.lock, self.timer = threading.Lock(), None

    def forget(self) -> None:
        with self.lock:
            for x in (self.words, self.chunks, self.decoded):
                x.clear()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
                ctypes.CDLL(None).malloc_trim(0)

    @contextlib.contextmanager
    def at_work(self):
        """Around what a task does with the caches."""
        with self.lock:
            if self.timer:
                self.timer.cancel()
            yield
        self.timer = threading.Timer(IDLE, self.forget)
        self.timer.daemon = True
        self.timer.start()


@functools.lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """One a worker: its caches serve all tasks that the worker runs."""
    return Bpe(path)


# -- the byte-level vocabulary ----------------------------------------------------------------

_BYTE = regex.compile(BYTE_PATTERN)
#: A space before white space, or a white-space run that ends the text in a space: chunks at spaces would then cut runs.
_UNSAFE = re.compile(f" [{WHITE}]|[{WHITE}] $")


class ByteCounter(Caches):
    """Token counts of texts for a byte-level vocabulary, each distinct pre-token by prefix counts."""

    def __init__(self, path: str):
        super().__init__()
        self.bpe = load(path)

    def learn(self, chunks: set[str]) -> None:
        """Fill the caches for these chunks; their distinct pre-tokens are counted together."""
        self.words.bound()
        split = {c: [c] if c[1:].isalpha() and c[0] == " " or c.isalpha() else _BYTE.findall(c) for c in chunks if c not in self.chunks}
        words = list({w for ws in split.values() for w in ws}.difference(self.words))
        self.words.add(words, self.bpe.prefixes([w.encode("utf-8", "replace").decode("latin-1") for w in words]))
        get = self.words.__getitem__
        self.chunks.add(split, [get(ws[0])[-1] if len(ws) == 1 else sum(get(w)[-1] for w in ws) for ws in split.values()])

    def cut(self, text: str) -> list[str]:
        """Consecutive chunks of a text; chunk borders are pre-token borders."""
        out: list[str] = []
        for i, part in enumerate(self.bpe.split_special.split(text) if "<|" in text else [text]):
            if i % 2:
                out.append(part)
            elif part:
                if _UNSAFE.search(part):
                    out += _BYTE.findall(part)
                else:
                    first, *rest = part.replace(" ", "\0 ").split("\0") if "\0" not in part else _BYTE.findall(part)
                    out += [first, *rest] if first else rest
        return out

    def count_many(self, texts: list[str]) -> tuple[list[list[str]], list[list[int]]]:
        """Chunks and chunk counts of each text."""
        lists = [self.cut(t) for t in texts]
        with self.at_work():
            self.chunks.bound()
            special = dict.fromkeys(self.bpe.special, 1)
            self.chunks.update(special)
            self.learn(set().union(*lists).difference(self.chunks))
            get = self.chunks.__getitem__
            return lists, [list(map(get, cs)) for cs in lists]

    def count(self, text: str) -> int:
        return sum(self.count_many([text])[1][0])

    def prefixes(self, chunk: str) -> list:
        """Counts at every byte of a chunk that was counted, from the stored counts of its pre-tokens."""
        if chunk in self.bpe.special:  # part of a special string is ordinary text
            return [*self.bpe.prefix_counts(chunk)[1:-1], 1]
        with self.lock:
            missing = [w for w in _BYTE.findall(chunk) if w not in self.words]
            self.words.add(missing, self.bpe.prefixes([w.encode("utf-8", "replace").decode("latin-1") for w in missing]))
            held = [self.words[w] for w in _BYTE.findall(chunk)]
        out, total = [], 0
        for counts in held:
            out += [total + c for c in counts]
            total += counts[-1]
        return out

    def fitting(self, pieces: list[str], counts: list[int], limit: int) -> int:
        """Bytes of the longest prefix of at most ``limit`` tokens, inside pre-tokens by their stored prefix counts."""
        total = n = 0
        for p, c in zip(pieces, counts, strict=True):
            if total + c > limit:
                fits = [i for i, k in enumerate(self.prefixes(p)) if total + k <= limit]
                return n + (fits[-1] + 1 if fits else 0)
            total += c
            n += len(p.encode("utf-8", "replace"))
        return n


# -- the vocabulary with word ends ------------------------------------------------------------

_WORD = regex.compile(WORD_PATTERN)
_WHITE_RUN = re.compile(f"[{WHITE}]+")
_ODD = re.compile("[\x1c-\x1f]")


class WordCodec(Caches):
    """Encoder of the lower-casing vocabulary whose white space is dropped: works by white-space chunks,
    each distinct chunk once; ids are kept as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        super().__init__()
        self.bpe = load(path)
        self.library = Tokenizer.from_file(path)
        self.latin = str.maketrans(_byte_chars())
        self.special = {t: np.uint32(i).tobytes() for t, i in self.bpe.special.items()}
        self.names = [self.bpe.names.get(i, "").encode() for i in range(max(self.bpe.names) + 1)]

    def normal(self, chunk: str) -> list[str]:
        """Pre-tokens of a chunk, by the library's own Unicode tables, which are of another version than Python's."""
        if chunk.isascii():
            return _WORD.findall(chunk.lower())
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return [x.translate(self.latin).encode("latin-1").decode() for x, _ in parts]

    def chunked(self, text: str) -> list[str]:
        """Chunks of a text; special tokens stand alone."""
        if "<|" in text:
            parts = self.bpe.split_special.split(text)
            if len(parts) > 1:
                return [c for i, p in enumerate(parts) for c in ([p] if i % 2 else self.chunked(p))]
        if _ODD.search(text):
            return [c for c in _WHITE_RUN.split(text) if c]
        return text.split()

    def pre_tokens(self, chunk: str) -> list[str]:
        """Pre-tokens of a chunk that may hold special tokens or white space beyond ASCII; special tokens stay whole."""
        return [w for c in self.chunked(chunk) for w in ([c] if c in self.special else self.normal(c))]

    def learn(self, chunks: set[str]) -> None:
        """Fill the caches for these chunks."""
        self.chunks.bound()
        self.words.bound()
        self.words.update(self.special)
        missing = chunks.difference(self.chunks)
        single: dict[str, str] = {}
        ended: dict[str, tuple[str, str]] = {}
        other: dict[str, list[str]] = {}
        for c in missing:
            if c.isascii() or max(c) < "\u0300":  # below U+0300 text is its own NFC form
                low = c.lower()
                if low.isalpha():
                    single[c] = c if c == low else low
                    continue
                if low[-1:] in ".," and low[:-1].isalpha():
                    ended[c] = (low[:-1], low[-1])
                    continue
            other[c] = self.pre_tokens(c)
        words = set(single.values())
        words.update(w for w, _ in ended.values())
        words.update(p for _, p in ended.values())
        words.update(w for ws in other.values() for w in ws)
        new = list(words.difference(self.words))
        self.words.add(new, self.bpe.encode_words([w.encode("utf-8", "replace").decode("latin-1") + END for w in new]))
        get = self.words.__getitem__
        self.chunks.add(single, map(get, single.values()))
        self.chunks.add(ended, (get(w) + get(p) for w, p in ended.values()))
        self.chunks.add(other, (b"".join(map(get, ws)) for ws in other.values()))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes.  Arrow cuts at ASCII white space and numbers the distinct chunks, lower-cased and
        without one full stop or comma at the end where the rest is ASCII letters, so that Python sees each once; what
        else cuts a chunk is seen to when it is learnt."""
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        whole = coded.dictionary
        bare = pc.ascii_rtrim(whole, ".,")
        cut = pc.subtract(pc.binary_length(whole), pc.binary_length(bare))
        plain = pc.and_(pc.ascii_is_alpha(bare), pc.less_equal(cut, 1))
        bare = pc.if_else(plain, pc.ascii_lower(bare), whole).dictionary_encode()
        end = pc.if_else(pc.and_(plain, pc.equal(cut, 1)), pc.if_else(pc.ends_with(whole, "."), 1, 2), 0)
        chunks = bare.dictionary.to_pylist()
        with self.at_work():
            self.learn({*chunks, ".", ","})
            get = self.chunks.__getitem__
            ids = pa.array(map(get, chunks), pa.large_binary(), size=len(chunks))
            ends = pa.array([b"", get("."), get(",")], pa.large_binary())
        ids = pc.binary_join_element_wise(ids.take(bare.indices), ends.take(end), pa.scalar(b"", pa.large_binary()))
        flat = ids.take(coded.indices)
        places = np.frombuffer(flat.buffers()[1], np.int64)[: len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
        at, held = places[lists.offsets.to_numpy()].tolist(), memoryview(flat.buffers()[2] or b"")
        return [bytes(held[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]

    def decode(self, ids: bytes) -> bytes:
        """What the library gives without a decoder: token names joined by spaces, in UTF-8."""
        names = self.names
        return b" ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def round_trip(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of each text, and what they decode to; each distinct chunk is decoded once."""
        lists = [self.chunked(t) for t in texts]
        with self.at_work():
            distinct = set().union(*lists)
            self.learn(distinct)
            self.decoded.bound()
            code, decode = self.chunks.__getitem__, self.decode
            new = list(distinct.difference(self.decoded))
            self.decoded.add(new, [decode(code(c)) for c in new])
            name = self.decoded.__getitem__
            return [(b"".join(map(code, cs)), b" ".join(map(name, cs))) for cs in lists]


@functools.lru_cache(maxsize=4)
def byte_counter(path: str) -> ByteCounter:
    return ByteCounter(path)


@functools.lru_cache(maxsize=4)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)
