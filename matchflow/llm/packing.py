"""Best-two-fit packing of token sequences.

A bin is filled greedily, always with the longest piece that still fits. Then its smallest piece is taken out and two
pieces that are not packed yet take its place, if together they fill the widened gap more tightly than it did; of all such
pairs the fullest is taken. This repeats while it improves the bin.

Pieces are packed in shards of about SHARD_PIECES documents by a hash of the row, so that no task holds more than a shard;
every shard wastes one bin at most, and all bins below ``reopen`` are packed once more across shards.
"""

from __future__ import annotations

import string
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchflow.llm.common import map_columns, once_per_worker
from matchflow.session import materialise

CAPACITY = 2048
SEPARATOR = 0
SHARD_PIECES = 4096
REOPEN = 0.98
CACHE_WORDS = 800_000
CACHE_LENGTH = 64
CACHE_OTHERS = 4096
LATIN_END = "\u0250"  # letters below are letters in every version of Unicode
MARKS = string.punctuation.replace("'", "")  # an apostrophe may begin a piece of letters
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or the next unused from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Whole(Exception):
    """A text that has to go through the tokenizer whole."""


class WordIds(dict):
    """Ids of a word after a space, as little-endian unsigned 32-bit integers; itself the bounded cache of words."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.letters = byte_letters()
        self.model = tokenizer.model
        self.kept = lru_cache(CACHE_OTHERS)(self.plain)

    def letters_only(self, piece: str) -> bytes:
        """Ids of letters, maybe after a space, which the splitter leaves whole: the model alone is asked."""
        if piece.isascii():
            piece = piece.replace(" ", self.letters[32])
        else:
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return np.asarray([t.id for t in self.model.tokenize(piece)], "<u4").tobytes()

    def plain(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, before: str, word: str) -> bytes:
        """Ids of a word and of what stands before it: a space, or nothing where a text begins.

        The splitter takes the marks that follow letters as a piece of their own.
        """
        stem = word.rstrip(MARKS)
        if stem.isalpha() and (stem.isascii() or max(stem) < LATIN_END):
            out = self.letters_only(before + stem)
            return out + self.kept(word[len(stem) :]) if len(stem) < len(word) else out
        return self.plain(before + word)

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or "<|" in word:
            raise Whole
        if "\n" in word:
            lines = word.split("\n")
            if all(line and not line[0].isspace() and not line[-1].isspace() for line in lines):
                return self.kept("\n").join([self[lines[0]], *map(self.plain, lines[1:])])
        out = self.word(" ", word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text.

        The byte-level splitter never joins across a space that begins a word, so words are encoded one by one; a text
        in which white space follows a space, or that may hold a special token, goes through the tokenizer whole.
        """
        if not text:
            return b""
        if text[-1] == " " or "  " in text:
            return self.plain(text)
        words = text.split(" ")
        if "<|" in words[0]:
            return self.plain(text)
        try:
            return (self.word("", words[0]) if words[0] else b"") + b"".join(map(self.__getitem__, islice(words, 1, None)))
        except Whole:
            return self.plain(text)


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Rows of pieces: a document's ids and the separator, cut at ``capacity`` if longer.

    Of a long document the first piece takes the remainder and the others are full. Null texts count as empty: one piece
    with the separator alone.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.asarray([SEPARATOR], "<u4").tobytes()

    call = uuid.uuid4().hex

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        words = once_per_worker(call, lambda: WordIds(Tokenizer.from_str(shared.value)))
        for doc_ids, texts in batches:
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc_id, text in zip(doc_ids, texts):
                ids = words.encode(text or "") + end
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n - start - 1) % capacity + 1 if piece == 0 else capacity
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(ids[4 * start : 4 * (start + length)]))
                    start, piece = start + length, piece + 1
            yield out

    return map_columns(docs, ["doc_id", "text"], work, PIECES)


def best_pair(left: np.ndarray, below: np.ndarray, room: int, more_than: int) -> tuple[int, int] | None:
    """Two lengths left whose sum is as large as possible, at most ``room`` and above ``more_than``."""
    larger = np.flatnonzero(left[:room])
    smaller = below[np.minimum(room - larger, larger)]
    smaller = np.where((smaller == larger) & (left[larger] < 2), below[np.maximum(larger - 1, 0)], smaller)
    total = np.where(smaller > 0, larger + smaller, 0)
    if len(total) == 0 or total[at := int(np.argmax(total))] <= more_than:
        return None
    return int(larger[at]), int(smaller[at])


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece, given lengths from 1 to ``capacity``.

    Only the number of pieces of each length matters, so the search runs over the lengths that are left, not over pieces.
    """
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(lengths, kind="stable")
    left = np.bincount(lengths, minlength=capacity + 1)
    place = np.concatenate([[0], np.cumsum(left)[:-1]])  # where the next unused piece of a length stands in order
    below = np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0))  # longest length left up to the index

    def change(size: int, by: int) -> None:
        left[size] += by
        if left[size] == max(by, 0):  # it has run out, or is there again
            stop = size + int(np.searchsorted(below[size:], size, side="right"))
            below[size:stop] = size if by > 0 else below[size - 1]

    number, remaining = 0, n
    while remaining:
        content: list[int] = []
        gap = capacity
        while gap and (size := int(below[gap])):
            content.append(size)
            change(size, -1)
            gap -= size
        while gap and (pair := best_pair(left, below, gap + content[-1], content[-1])):
            smallest = content.pop()
            for size in pair:
                change(size, -1)
            change(smallest, 1)
            gap += smallest - sum(pair)
            content = sorted([*content, *pair], reverse=True)
        offset = 0
        for size in content:
            piece = order[place[size]]
            place[size] += 1
            bins[piece], offsets[piece] = number, offset
            offset += size
        number += 1
        remaining -= len(content)
    return bins, offsets


def pack(pieces: DataFrame, rows: int, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, reopen: float = REOPEN) -> DataFrame:
    """Add sequence_id and offset to pieces; ``rows`` is about how many there are and only sets the number of shards.

    Bins filled to less than ``reopen`` in their shard are opened and packed again with those of other shards.
    """
    first = materialise(_pack_shards(pieces, -(-rows // shard_pieces), capacity, 0), "packed")
    few = F.col("fill") < int(reopen * capacity)
    loose = first.where(few).drop("sequence_id", "offset", "fill")
    again = _pack_shards(loose, -(-loose.count() // shard_pieces), capacity, 1)
    return first.where(~few).unionByName(again).drop("fill")


def _pack_shards(pieces: DataFrame, shards: int, capacity: int, turn: int) -> DataFrame:
    def pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32", "length"], na_position="first", ignore_index=True)
        bins, offsets = best_two_fit(pdf["length"].to_numpy(np.int64), capacity)
        fill = np.bincount(bins, weights=pdf["length"])[bins]
        shard = int(pdf["shard"].iloc[0])
        out = pdf.drop(columns="shard").assign(sequence_id=(shard * 2 + turn << 24) + bins, offset=offsets, fill=fill.astype(np.int64))
        return out.astype({"doc_id": "Int64"})

    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(max(shards, 1)))
    schema = f"{PIECES}, sequence_id bigint, offset bigint, fill bigint"
    return pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(pack_shard, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; the pieces of a sequence lie one after
    another from offset 0. Null and empty texts are packed as the separator alone. Repeated rows and null ids are packed
    row by row. An empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    return pack(tokenize_pieces(docs, path, capacity), docs.count(), capacity)
