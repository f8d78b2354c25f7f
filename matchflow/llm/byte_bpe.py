"""Byte-level BPE in two tiers: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest.

A pre-token that is in the vocabulary is its own token, whatever merges lead there; the first tier finds it with one
hash and one comparison. A pre-token that is not is merged pair by pair: its bytes form a linked list, a heap holds the
ranks of neighbouring pairs, and a merge only touches the two pairs beside it, so n bytes take O(n log n).

The results of recently seen words are kept per worker, up to CACHE_WORDS; that changes no result. They are kept in two
generations: when the younger is full it takes the place of the older, and a word found in the older goes to the younger.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import uuid
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import regex
import xxhash
from pyspark.sql import DataFrame

from matchflow.llm.common import map_columns, once_per_worker

CACHE_WORDS = 800_000
CACHE_LENGTH = 64
KEYS_PER_BUCKET = 4
WORD = (1 << 64) - 1
SPREAD, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd 64-bit multipliers
BREAK = re.compile(r" (?=\S)")
SPACE_RUN = re.compile(r" (?!\S)")
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")  # letters in every version of Unicode


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from a file of base64 token and rank per line."""
    ranks: dict[int, bytes] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    return [ranks[i] for i in range(len(ranks))]


def is_latin(word: str) -> bool:
    """Whether a word is made of Latin letters alone, and not empty."""
    return word.isalpha() and (word.isascii() or LATIN.fullmatch(word) is not None)


class PerfectHash:
    """Minimal perfect hash of distinct byte strings by hash and displace.

    Keys fall into buckets by one half of a 64-bit hash; each bucket, largest first, gets the smallest displacement that
    sends its keys to free and different slots. n keys fill exactly n slots.
    """

    def __init__(self, keys: list[bytes], seed: int = 0):
        self.size, self.seed = len(keys), seed
        self.buckets = max(1, -(-self.size // KEYS_PER_BUCKET))
        hashes = np.array([xxhash.xxh3_64_intdigest(k, seed) for k in keys], dtype=np.uint64)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        counts = np.diff(starts)
        self.displacement = np.zeros(self.buckets, np.int64)
        self.slots = np.full(self.size, -1, np.int64)
        for b in np.argsort(-counts, kind="stable"):
            members = order[starts[b] : starts[b + 1]]
            if len(members) == 0:
                break
            self.displacement[b], places = self._displace(hashes[members])
            self.slots[places] = members

    def _displace(self, hashes: np.ndarray) -> tuple[int, np.ndarray]:
        first, step = 0, 64
        while first <= 64 * self.size + 4096:
            d = np.arange(first, first + step, dtype=np.uint64)[:, None]
            mixed = (hashes[None, :] ^ (d * np.uint64(SPREAD))) * np.uint64(MIX)
            places = ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(self.size)).astype(np.int64)
            free = (self.slots[places] < 0).all(axis=1)
            if places.shape[1] > 1:
                ordered = np.sort(places, axis=1)
                free &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if free.any():
                at = int(np.argmax(free))
                return first + at, places[at]
            first, step = first + step, min(step * 4, 65_536)
        raise ValueError("two keys have the same hash; choose another seed")

    def tables(self) -> tuple[list[int], list[int]]:
        """Displacements and, per slot, the number of the key that it belongs to."""
        return self.displacement.tolist(), self.slots.tolist()


class Encoder(dict):
    """Maps a word to the decimal ids of its tokens, joined by commas; itself the younger half of the bounded cache of words.

    Keys are the words after a space, which never begin with white space, and line breaks with what follows them up to the
    next space or break. The first word of a text goes through ``plain``.
    """

    def __init__(self, tokens: list[bytes], displacement: list[int], slots: list[int], seed: int, pattern: str):
        super().__init__()
        self.tokens, self.displacement, self.slots, self.seed = tokens, displacement, slots, seed
        self.split = regex.compile(pattern).findall
        self.text_of = {str(i): t for i, t in enumerate(tokens)}
        self.ranks: dict[bytes, int] | None = None
        self.pairs: list[int] = []
        self.older: dict[str, str] = {}
        # with this pattern letters after a space are one match, and a comma or full stop behind them another
        self.by_letters = pattern == public_tokenizers.PATTERN
        self.marks = {mark: "," + self.plain(mark) for mark in ",."} if self.by_letters else {}

    def lookup(self, piece: bytes) -> int:
        """Rank of a whole piece by the perfect hash, or -1."""
        h = xxhash.xxh3_64_intdigest(piece, self.seed)
        d = self.displacement[h % len(self.displacement)]
        mixed = ((h ^ (d * SPREAD & WORD)) * MIX) & WORD
        rank = self.slots[(mixed ^ (mixed >> 32)) % len(self.slots)]
        return rank if self.tokens[rank] == piece else -1

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece that is no token: merge the neighbouring pair of lowest rank, leftmost first."""
        if self.ranks is None:
            self.ranks = {t: i for i, t in enumerate(self.tokens)}
            self.pairs = [self.ranks.get(bytes(divmod(ab, 256)), -1) for ab in range(1 << 16)]
        rank, pairs, n = self.ranks.get, self.pairs, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n))  # links
        pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]  # rank of a part with the next one; -1: no token, or no start of a part
        pair.append(-1)
        heap = [r * n + i for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            r, i = divmod(pop(heap), n)
            if pair[i] != r:
                continue  # one of the two parts has been merged since
            j = after[i]
            end = after[i] = after[j]
            before[end], pair[j] = i, -1
            if end < n and (r := rank(piece[i : after[end]])) is not None:
                pair[i] = r
                push(heap, r * n + i)
            else:
                pair[i] = -1
            if (k := before[i]) >= 0:
                if (r := rank(piece[k:end])) is not None:
                    pair[k] = r
                    push(heap, r * n + k)
                else:
                    pair[k] = -1
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def ids_of(self, matches: list[str]) -> str:
        """Ids of matches without the cache."""
        ids: list[int] = []
        for match in matches:
            piece = match.encode()
            rank = self.lookup(piece)
            if rank >= 0:
                ids.append(rank)
            else:
                ids += self.merge(piece)
        return ",".join(map(str, ids))

    def plain(self, text: str) -> str:
        """Ids of a text without the cache."""
        return self.ids_of(self.split(text))

    def __missing__(self, word: str) -> str:
        if (mark := self.marks.get(word[-1])) and is_latin(bare := word[:-1]):
            return self[bare] + mark  # not kept, as the bare word is
        if "\n" in word:  # a line break between two words: its parts are more often known
            head, *lines = word.split("\n")
            if head and all(line and not line[0].isspace() and not line[-1].isspace() for line in lines) and not head[-1].isspace():
                return ",".join([self[head], *(self["\n" + line] for line in lines)])
        out = self.older.pop(word, None) or (self.after_break(word[1:]) if word[0] == "\n" else self.after_space(word))
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS // 2:
                self.older = {}  # let go before the copy
                self.older = dict(self)
                self.clear()
            self[word] = out
        return out

    def after_break(self, line: str) -> str:
        return self.plain("\n") + "," + self.plain(line)

    def after_space(self, word: str) -> str:
        """Ids of a word after a space; what is known of its first match, the word without marks behind it, say, is used."""
        if self.by_letters and is_latin(word):
            return self.ids_of([" " + word])
        head, *rest = self.split(" " + word)
        if rest and len(head) > 2 and self.split(head) == [head]:
            return ",".join([self[head[1:]], self.ids_of(rest)])
        return self.ids_of([head, *rest])

    def encode(self, text: str) -> str:
        """Decimal ids joined by commas.

        A space before another non-space character always begins a match, so words between such spaces can be taken one
        by one; where white space follows a space, only the spaces that begin a word split.
        """
        words = BREAK.split(text) if SPACE_RUN.search(text) else text.split(" ")
        if text and not words[0] and len(words) > 1:
            return ",".join(map(self.__getitem__, islice(words, 1, None)))
        head = self.plain(words[0])
        return ",".join([*([head] if head else []), *map(self.__getitem__, islice(words, 1, None))])

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.text_of.__getitem__, ids.split(","))) if ids else b""


def make_encoder(path: str, pattern: str = public_tokenizers.PATTERN) -> Encoder:
    tokens = read_ranks(path)
    table = PerfectHash(tokens)
    return Encoder(tokens, *table.tables(), table.seed, pattern)


def encode_digests(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Encode every text, decode the ids again, and return a digest of both.

    Columns: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded bytes).
    Null texts count as empty, which have no tokens. Repeated rows and null ids give a row each; columns other than
    doc_id and text are ignored. No shuffle; the vocabulary is broadcast, and its size is that of the file.
    """
    tokens = read_ranks(path)
    table = PerfectHash(tokens)
    shared = docs.sparkSession.sparkContext.broadcast((tokens, *table.tables(), table.seed, pattern))

    call = uuid.uuid4().hex

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        encoder = once_per_worker(call, lambda: Encoder(*shared.value))
        for doc_ids, texts in batches:
            n, a, b = [], [], []
            for text in texts:
                ids = encoder.encode(text or "")
                n.append(ids.count(",") + 1 if ids else 0)
                a.append(hashlib.sha256(ids.encode()).hexdigest())
                b.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield {"doc_id": doc_ids, "n_tokens": n, "ids_sha256": a, "decoded_sha256": b}

    return map_columns(docs, ["doc_id", "text"], work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
