"""Front-coded sorted suffix runs and their merge by a loser tree that never compares known prefixes."""

from __future__ import annotations


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that agree in the first ``known`` bytes."""
    m = min(len(a), len(b))
    x, y = a[known:m], b[known:m]
    if x == y:
        return m
    return m - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) // 8


def common_suffix(a: bytes, b: bytes) -> int:
    m = min(len(a), len(b))
    if not m:
        return 0
    x = int.from_bytes(a[-m:], "big") ^ int.from_bytes(b[-m:], "big")
    return m if not x else ((x & -x).bit_length() - 1) // 8


def front_code(keys: list[bytes]) -> tuple[list[int], list[bytes]]:
    """What each sorted key shares with the one before it, and its rest."""
    shared = [0, *(common_prefix(a, b) for a, b in zip(keys, keys[1:], strict=False))] if keys else []
    return shared, [k[s:] for k, s in zip(keys, shared, strict=True)]


class LoserTree:
    """Merges front-coded runs; each run is an iterator of (shared, rest, value) in key order.

    Every waiting run knows how many bytes its key shares with the key that last beat it.  A larger
    number wins without looking at a byte, and at equal numbers the comparison starts behind them."""

    def __init__(self, runs: list):
        self.runs = [iter(r) for r in runs]
        n = len(self.runs)
        self.key: list[bytes | None] = [b""] * n
        self.value: list = [None] * n
        self.shared = [0] * n
        self.loser = [0] * max(1, n)
        for i in range(n):
            self._advance(i)
        self.winner = self._build(1) if n else -1

    def _advance(self, i: int) -> None:
        found = next(self.runs[i], None)
        if found is None:
            self.key[i], self.shared[i] = None, -1
        else:
            shared, rest, self.value[i] = found
            self.key[i], self.shared[i] = self.key[i][:shared] + rest, shared

    def _build(self, node: int) -> int:
        n = len(self.runs)
        if node >= n:
            return node - n
        winner, self.loser[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def _play(self, a: int, b: int) -> tuple[int, int]:
        x, y = self.shared[a], self.shared[b]
        if x != y:  # an ended run shares -1 with everything
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        p, q = self.key[a], self.key[b]
        n = common_prefix(p, q, x)
        if n == len(p) or (n < len(q) and p[n] < q[n]):
            self.shared[b] = n
            return a, b
        self.shared[a] = n
        return b, a

    def __iter__(self):
        """(key, bytes shared with the key before it, value) in order."""
        if not self.runs:
            return
        n = len(self.runs)
        while self.key[self.winner] is not None:
            i = self.winner
            yield self.key[i], self.shared[i], self.value[i]
            self._advance(i)
            node = (i + n) // 2
            while node:
                i, self.loser[node] = self._play(i, self.loser[node])
                node //= 2
            self.winner = i
