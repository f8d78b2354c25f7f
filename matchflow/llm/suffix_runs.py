"""Sorted runs of suffixes: front-coded for the exchange, merged by a loser tree that knows common prefixes."""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

#: Position of an entry whose suffix stands more than once in its run.
REPEATED = -1
Owner = tuple[int, int, int]
MANY: Owner = (0, 0, REPEATED)


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no comparison."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) // 8


def pack_run(keys: list[bytes], owners: list[Owner]) -> bytes:
    """A sorted run as bytes: of every key the length of the prefix shared with the one before, and the rest."""
    shared, rest, last = [], [], b""
    for key in keys:
        n = common_prefix(last, key)
        shared.append(n)
        rest.append(key[n:])
        last = key
    head = struct.pack("<I", len(keys)) + np.array(shared, "<u4").tobytes() + np.array([len(r) for r in rest], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + np.array(owners, "<i8").reshape(-1, 3).T.tobytes() + b"".join(rest))


def read_run(blob: bytes) -> Iterator[tuple[bytes, int, Owner]]:
    """Keys in order with the length shared with the key before, and owners."""
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = struct.unpack_from("<I", data)[0]
    shared = np.frombuffer(data, "<u4", n, 4).tolist()
    lengths = np.frombuffer(data, "<u4", n, 4 + 4 * n).tolist()
    columns = np.frombuffer(data, "<i8", 3 * n, 4 + 8 * n).reshape(3, n).tolist()
    at, key = 4 + 32 * n, b""
    for i in range(n):
        key = key[: shared[i]] + data[at : at + lengths[i]]
        at += lengths[i]
        yield key, shared[i], (columns[0][i], columns[1][i], columns[2][i])


def cut_run(entries: dict[bytes, Owner], splitters: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """Sort the entries and cut them at the splitters: number of the range and packed run."""
    keys = sorted(entries)
    start = 0
    for number in range(len(splitters) + 1):
        end = bisect_left(keys, splitters[number], start) if number < len(splitters) else len(keys)
        if end > start:
            part = keys[start:end]
            yield number, pack_run(part, [entries[k] for k in part])
        start = end


class LoserTree:
    """Merge of sorted runs.

    Every run's head carries the length of the prefix that it shares with the last key given out. Of two heads the one that
    shares more is smaller, without a look at the bytes; only if they share equally much are bytes compared, from there on.
    The loser keeps the length that it shares with the winner, which is what it needs when the winner has gone out.
    """

    def __init__(self, runs: list[Iterator[tuple[bytes, int, Owner]]]):
        self.runs, self.k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.shared = [0 if h is not None else -1 for h in self.heads]
        self.losers = [-1] * self.k
        self.winner = self._build()

    def _beats(self, i: int, j: int) -> int:
        """The smaller of two heads."""
        a, b = self.shared[i], self.shared[j]
        if a != b:
            return i if a > b else j
        if a < 0:
            return i
        x, y = self.heads[i][0], self.heads[j][0]
        n = common_prefix(x, y, a)
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            self.shared[j] = n
            return i
        self.shared[i] = n
        return j

    def _build(self) -> int:
        winners = [-1] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            won = self._beats(a, b)
            winners[node], self.losers[node] = won, b if won == a else a
        return winners[1] if self.k > 1 else 0

    def __iter__(self) -> Iterator[tuple[bytes, int, Owner]]:
        """Keys in order, the length that each shares with the one before, and owners."""
        if not self.k:
            return
        runs, heads, shared, losers = self.runs, self.heads, self.shared, self.losers
        while (head := heads[w := self.winner]) is not None:
            yield head[0], shared[w], head[2]
            heads[w] = head = next(runs[w], None)
            shared[w] = head[1] if head is not None else -1
            node = (w + self.k) // 2
            while node:
                rival = losers[node]
                won = self._beats(w, rival)
                if won != w:
                    losers[node], w = w, rival
                node //= 2
            self.winner = w


def merge(blobs: Iterable[bytes]) -> Iterator[tuple[bytes, int, list[Owner]]]:
    """Distinct keys of several runs in order, the length shared with the one before, and the owners of each."""
    key, common, owners = None, 0, []
    for next_key, shared, owner in LoserTree([read_run(b) for b in blobs]):
        if key is not None and shared == len(key) == len(next_key):
            owners.append(owner)
            continue
        if key is not None:
            yield key, common, owners
        key, common, owners = next_key, shared, [owner]
    if key is not None:
        yield key, common, owners
