"""Exact edit distances of many pairs of texts at once."""

from __future__ import annotations

import numpy as np

#: Characters of both sides that are compared together.
SLAB = 4_000_000
#: Seconds of one diagonal, and of one column of bits and one 64-bit word of it: where the second method is cheaper.
_DIAGONAL, _COLUMN, _WORD = 1.5e-7, 1e-6, 4e-9


def by_bits(a: str, b: str) -> int:
    """Edit distance by columns of bits (Myers), each a whole number as long as the shorter text."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    places: dict[str, bytearray] = {}
    for i, c in enumerate(a):
        places.setdefault(c, bytearray(len(a) // 8 + 1))[i >> 3] |= 1 << (i & 7)
    masks = {c: int.from_bytes(v, "little") for c, v in places.items()}
    full, top, up, down, distance = (1 << len(a)) - 1, 1 << (len(a) - 1), (1 << len(a)) - 1, 0, len(a)
    for c in b:
        same = masks.get(c, 0)
        vertical = same | down
        across = (((same & up) + up) ^ up) | same
        more, less = down | (full & ~(across | up)), up & across
        if more & top:
            distance += 1
        elif less & top:
            distance -= 1
        more, less = (more << 1) | 1, less << 1
        up, down = (less | ~(vertical | more)) & full, more & vertical & full
    return distance


def _words(texts: list[str], end: int, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eight bytes from each character on, where each text starts, and its length; each text is followed by ``end``."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    codes = np.full(int(sizes.sum()) + len(texts) + 8, end, kind)
    whole = np.ones(len(codes), bool)
    whole[starts + sizes], whole[-8:] = False, False
    raw = "".join(texts)
    codes[whole] = np.frombuffer(raw.encode("latin-1"), np.uint8) if kind == np.uint8 else np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    held, width = codes.astype(np.uint64), 8 * codes.itemsize
    while width < 64:
        held[: -(width // (8 * codes.itemsize))] |= held[width // (8 * codes.itemsize) :] << np.uint64(width)
        width *= 2
    return held, starts, sizes


def _slab(left: list[str], right: list[str]) -> np.ndarray:
    """Distances of pairs that are neither equal nor empty: on each diagonal the furthest place that so many edits reach
    (Ukkonen), for all pairs in step.  Pairs with so many edits that columns of bits are cheaper go there."""
    small = max(max(map(max, left)), max(map(max, right))) < "\xfe"
    kind, step = (np.uint8, 8) if small else (np.uint32, 2)
    top = np.iinfo(kind).max
    (x_words, x_at, x_len), (y_words, y_at, y_len) = _words(left, top, kind), _words(right, top - 1, kind)
    shift = np.uint64(3 if small else 5)
    n = np.minimum(x_len, y_len)
    most = np.sqrt((np.maximum(x_len, y_len) * (_COLUMN + _WORD * n / 64)) / _DIAGONAL).astype(np.int64) + 4
    out, row, none = np.full(len(left), -1, np.int64), np.arange(len(left)), np.int64(-(1 << 40))
    far = np.zeros((len(left), 1), np.int64)
    for edits in range(int(most.max()) + 1):
        if edits:
            wide = np.full((len(row), 2 * edits + 3), none)
            wide[:, 2:-2] = far
            far = np.maximum(np.maximum(wide[:, 1:-1] + 1, wide[:, :-2]), wide[:, 2:] + 1)
        diagonal = np.arange(-edits, edits + 1)
        far = np.minimum(np.minimum(far, x_len[row, None]), y_len[row, None] - diagonal)
        far[(far < 0) | (far + diagonal < 0)] = none
        flat = far.reshape(-1)
        live = np.flatnonzero(flat >= 0)
        r, k = live // len(diagonal), live % len(diagonal) - edits
        x = flat[live]
        i, j = x_at[row[r]] + x, y_at[row[r]] + x + k
        while len(live):
            differ = x_words[i] ^ y_words[j]
            same = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.uint64) >> shift
            same = np.where(differ == 0, step, same.astype(np.int64))
            flat[live] += same
            on = np.flatnonzero(same == step)
            live, i, j = live[on], i[on] + step, j[on] + step
        end = y_len[row] - x_len[row]
        seen = np.abs(end) <= edits
        done = seen & (far[np.arange(len(row)), np.where(seen, end + edits, 0)] == x_len[row])
        out[row[done]] = edits
        keep = ~done & (most[row] > edits)
        if not keep.any():
            break
        if not keep.all():
            row, far = row[keep], far[keep]
    for i in np.flatnonzero(out < 0):
        out[i] = by_bits(left[i], right[i])
    return out


def distances(left: list[str], right: list[str]) -> np.ndarray:
    """The edit distance, in code points, of each text to the one at its place on the right."""
    out = np.zeros(len(left), np.int64)
    some: list[int] = []
    held = 0
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        if a == b:
            continue
        if not a or not b:
            out[i] = len(a) + len(b)
            continue
        some.append(i)
        held += len(a) + len(b)
        if held >= SLAB:
            out[some] = _slab([left[k] for k in some], [right[k] for k in some])
            some, held = [], 0
    if some:
        out[some] = _slab([left[k] for k in some], [right[k] for k in some])
    return out
