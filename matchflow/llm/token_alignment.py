"""Alignment of two tokenizers over the same bytes, and how many documents link each pair of their tokens.

Documents are encoded once; the ids are written out. Both encodings of a document cover the same bytes, so an A and a B token
overlap exactly where a stretch between two neighbouring token ends lies in both: one link per stretch. The different pairs of
the corpus get a minimal perfect hash. A first pass adds up dense vectors of counts indexed by it, one vector per task and a
tree of sums over them; a second pass aligns the documents again and looks the counts up. Keys are verified at each lookup.

Pairs are looked up by slices of whole A ids with about SLICE_PAIRS pairs, so what is collected, added up and broadcast
is bounded; the sums of a document over all slices are added.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from array import array
from collections.abc import Callable, Iterator
from json import loads

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchflow.llm.common import map_columns, once_per_worker
from matchflow.session import fresh_path

SLICE_PAIRS = 2_000_000
BATCH_TOKENS = 1 << 18
OUT_BYTES = 4 << 20
PAIRS_HELD = 1 << 20
GAMMA = 2.0
DEPTH = 3
#: Characters that versions of Unicode may put in different classes, and runs of white space that could exhaust a regex.
RARE, BLANK = re.compile("[^\x00-ɏ‐-‧]"), re.compile(r"\s{2000}")
ENCODED = "doc_id bigint, ids_a binary, ids_b binary"
SCHEMA = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)  # fixed multipliers of a 64-bit mixer


class PairHash:
    """Minimal perfect hash of distinct whole numbers: n keys fill the slots from 0 to n - 1.

    A cascade of bit arrays: a key that falls alone on a bit of a level has its slot there, by rank; the others go on to the
    next. The slot's key is kept, so other numbers are told apart and get -1.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        left, first = keys.astype(np.int64), 0
        while len(left):
            size = max(64, int(GAMMA * len(left)))
            place = self._place(left, len(self.levels), size)
            alone = np.bincount(place, minlength=-(-size // 64) * 64) == 1
            words = np.packbits(alone, bitorder="little").view("<u8")
            counts = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.levels.append((size, words, np.concatenate([[0], counts[:-1]]) + first))
            first += int(counts[-1])
            left = left[~alone[place]]
        self.keys = np.full(len(keys), -1, np.int64)
        self.keys[self._slots(keys.astype(np.int64))] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        h = keys.astype(np.uint64) + np.uint64(MIX[2] * (level + 1) % (1 << 64))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[0])
        h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[1])
        return ((h ^ (h >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, words, before) in enumerate(self.levels):
            place = self._place(keys[open_], level, size)
            word, bit = words[place >> 6], np.uint64(1) << (place & 63).astype(np.uint64)
            hit = word & bit != 0
            found[open_[hit]] = before[place[hit] >> 6] + np.bitwise_count(word[hit] & (bit[hit] - np.uint64(1)))
            open_ = open_[~hit]
            if not len(open_):
                break
        return found

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        slots = self._slots(keys)
        there = slots >= 0
        there[there] = self.keys[slots[there]] == keys[there]
        return np.where(there, slots, -1)


class TokenizerA:
    """Byte-level BPE from a tokenizer file; plain text goes through the same ranks in a faster library."""

    def __init__(self, text: str, pattern: str):
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        letters = byte_of_letter()
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.lengths = np.array([len(t) for t in self.bytes])
        self.fast = self._ranks(loads(text), vocabulary, pattern)

    def _ranks(self, described: dict, vocabulary: dict[str, int], pattern: str) -> tiktoken.Encoding | None:
        """The vocabulary as ranks, if that must give the same ids.

        Merges have to be in the order of their ids, every token has to come out of its own bytes, and the splitter has to be
        the byte-level one, whose pattern ``pattern`` is.
        """
        model, splitter = described["model"], described.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [vocabulary.get("".join(m), -1) for m in merges]
        singles = {t: i for t, i in vocabulary.items() if len(t) == 1}
        byte_level = splitter.get("type") == "ByteLevel" and not splitter.get("add_prefix_space") and splitter.get("use_regex", True)
        in_order = -1 not in ids and all(x < y for x, y in zip(ids, ids[1:])) and len(singles) == 256
        if not (byte_level and in_order) or any(described.get(k) for k in ("normalizer", "truncation")) or any(model.get(k) for k in ("ignore_merges", "dropout")):
            return None
        if any(len(self.tokenizer.model.tokenize("".join(m))) > 1 for m in merges):
            return None
        ranks = {self.bytes[i]: i for i in [*singles.values(), *ids]}
        return tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str, whole: bytes) -> np.ndarray | None:
        """Ids, or nothing if their bytes are not those of the text.

        The faster library cuts the text at its matches and merges the bytes of each, so bytes can only be left out; with the
        right number of bytes they are the same.
        """
        if self.fast is None or RARE.search(text) or BLANK.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.asarray(ids, np.uint32) if b"".join(map(self.bytes.__getitem__, ids)) == whole else None
        ids = self.fast.encode_to_numpy(text, disallowed_special=())
        return ids if self.lengths[ids].sum() == len(whole) else None


def byte_of_letter() -> dict[str, int]:
    """The byte that a printable letter of byte-level vocabularies stands for: itself, or the next unused from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenizerB:
    """Pieces of a sentence model."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        piece = self.model.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace("▁", " ").encode()

    def encode(self, text: str, whole: bytes) -> np.ndarray | None:
        """Ids, or nothing if their bytes are not those of a space and the text."""
        ids = self.model.encode(text)
        return np.frombuffer(array("I", ids), np.uint32) if b"".join(map(self.bytes.__getitem__, ids)) == whole else None


class Encoders:
    """Both tokenizers and what their ids stand for."""

    def __init__(self, a: str, b: bytes, pattern: str):
        self.a, self.b = TokenizerA(a, pattern), TokenizerB(b)

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """Ids of both as little-endian 32-bit numbers; none if the text is empty or the bytes of one are not the text's."""
        if text:
            whole = (" " + text).encode()
            a = self.a.encode(" " + text, whole)
            b = None if a is None else self.b.encode(text, whole)
            if b is not None:
                return a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
        return b"", b""


class Alignment:
    """Links of a batch of documents, given by their ids one after another and how many each has."""

    def __init__(self, lengths_a: np.ndarray, lengths_b: np.ndarray, ids_a: list[np.ndarray], ids_b: list[np.ndarray]):
        self.n_a, self.n_b = np.array([len(i) for i in ids_a]), np.array([len(i) for i in ids_b])
        self.a, self.b = np.concatenate(ids_a).astype(np.int64), np.concatenate(ids_b).astype(np.int64)
        self.top = len(lengths_a) * len(lengths_b)
        self.ends_a, self.ends_b = np.cumsum(lengths_a[self.a]), np.cumsum(lengths_b[self.b])
        at_a, at_b = (np.zeros(int(self.ends_a[-1]) + 1 if len(self.a) else 1, bool) for _ in range(2))
        at_a[self.ends_a] = True
        at_b[self.ends_b] = True
        ends = np.flatnonzero(at_a | at_b)
        both = at_a[ends] & at_b[ends]
        link_a, link_b = (np.cumsum(at[ends]) - at[ends] for at in (at_a, at_b))  # the token that each stretch lies in
        self.pairs = self.a[link_a] * len(lengths_b) + self.b[link_b]
        self.document = np.repeat(np.arange(len(self.n_a)), self.n_a)[link_a]
        self.group_starts = both
        group = np.cumsum(both) - both
        self.group_a = np.zeros(len(self.a), np.int64)
        self.group_b = np.zeros(len(self.b), np.int64)
        self.group_a[link_a], self.group_b[link_b] = group, group

    def per_document(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.document, weights=values, minlength=len(self.n_a)).astype(np.int64)

    def distinct(self) -> np.ndarray:
        """Pairs, each once per document."""
        keys = np.sort(self.document * self.top + self.pairs)  # far below 2^63, as batches are small
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        return keys[new] % self.top

    def groups(self, written_a: list[str], written_b: list[str]) -> list[str]:
        """``a1,a2|b1;a3|b2`` per document; ``written`` has an id's text with a comma (even place) and with the end mark (odd)."""
        last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (self.group_a, self.group_b))
        order = np.argsort(np.concatenate([self.group_a * 2, self.group_b * 2 + 1]), kind="stable")
        codes = np.concatenate([self.a * 2 + last_a, self.b * 2 + last_b + len(written_a)])[order].tolist()
        written = written_a + written_b
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join([written[c] for c in codes[start:end]])[:-1] for start, end in zip([0, *ends], ends)]


def encoded(docs: DataFrame, make: Callable[[], Encoders]) -> DataFrame:
    """Documents with the ids of both tokenizers as bytes, and a number for each row; written out once."""
    call = uuid.uuid4().hex

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        encoders = once_per_worker(call, make)
        for doc_ids, texts in batches:
            start, size = 0, 0
            ids: list[tuple[bytes, bytes]] = []
            for i, text in enumerate(texts):
                ids.append(encoders.encode(text))
                size += len(ids[-1][0]) + len(ids[-1][1])
                if size >= OUT_BYTES or i == len(texts) - 1:
                    yield {"doc_id": doc_ids[start : i + 1], "ids_a": [a for a, _ in ids], "ids_b": [b for _, b in ids]}
                    start, size, ids = i + 1, 0, []

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = map_columns(chosen, ["doc_id", "text"], work, ENCODED).withColumn("row", F.monotonically_increasing_id())
    path = fresh_path(docs.sparkSession, "token-ids")
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def in_batches(batches: Iterator[list[list]], lengths: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[list[list], Alignment]]:
    """Rows of (others ..., ids_a, ids_b), aligned BATCH_TOKENS tokens or so at a time."""
    waiting: list[list] = []
    size = 0
    for columns in batches:
        for row in zip(*columns):
            waiting.append(list(row))
            size += (len(row[-1]) + len(row[-2])) // 4
            if size >= BATCH_TOKENS:
                yield waiting, _aligned(waiting, lengths)
                waiting, size = [], 0
    if waiting:
        yield waiting, _aligned(waiting, lengths)


def _aligned(rows: list[list], lengths: tuple[np.ndarray, np.ndarray]) -> Alignment:
    return Alignment(*lengths, [np.frombuffer(r[-2], "<u4") for r in rows], [np.frombuffer(r[-1], "<u4") for r in rows])


def distinct_pairs(rows: DataFrame, lengths: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """All pairs that some document links, each once."""

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        seen, more, size = np.zeros(0, np.int64), [], 0
        for _, links in in_batches(batches, lengths):
            more.append(np.unique(links.pairs))
            size += len(more[-1])
            if size >= PAIRS_HELD:
                seen, more, size = np.unique(np.concatenate([seen, *more])), [], 0
                if len(seen) >= PAIRS_HELD:
                    yield {"pair": seen}
                    seen = np.zeros(0, np.int64)
        yield {"pair": np.unique(np.concatenate([seen, *more]))}

    path = fresh_path(rows.sparkSession, "pairs")
    map_columns(rows, ["ids_a", "ids_b"], work, "pair bigint").distinct().write.parquet(path)
    return rows.sparkSession.read.schema("pair bigint").parquet(path)


def document_counts(rows: DataFrame, lengths: tuple[np.ndarray, np.ndarray], index: PairHash) -> np.ndarray:
    """How many documents hold each pair of the index: dense vectors of the tasks, added up in a tree."""
    shared = rows.sparkSession.sparkContext.broadcast(index)
    n = len(index.keys)

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        counts = np.zeros(n, np.int64)
        for _, links in in_batches(batches, lengths):
            slots = shared.value.lookup(links.distinct())
            counts += np.bincount(slots[slots >= 0], minlength=n)
        yield {"counts": [counts.astype("<i8").tobytes()]}

    vectors = map_columns(rows, ["ids_a", "ids_b"], work, "counts binary").rdd.map(lambda r: np.frombuffer(r["counts"], "<i8"))
    return vectors.treeReduce(np.add, DEPTH)


def most_for_a(index: PairHash, counts: np.ndarray, width: int) -> np.ndarray:
    """Whether a slot's count is the highest of its A id; a pair is the A id times ``width`` plus the B id."""
    a = index.keys // width
    numbers, place = np.unique(a, return_inverse=True)
    highest = np.zeros(len(numbers), np.int64)
    np.maximum.at(highest, place, counts)
    return counts == highest[place]


def looked_up(rows: DataFrame, lengths: tuple[np.ndarray, np.ndarray], index: PairHash, counts: np.ndarray, first: bool) -> DataFrame:
    """SCHEMA's columns from one slice of pairs; all that does not depend on counts comes from the first."""
    shared = rows.sparkSession.sparkContext.broadcast((index, counts, most_for_a(index, counts, len(lengths[1]))))
    call = uuid.uuid4().hex
    n_a, n_b = len(lengths[0]), len(lengths[1])

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        index, counts, best = shared.value
        written = once_per_worker(call, lambda: ([f"{i}{end}" for i in range(n_a) for end in ",|"], [f"{i}{end}" for i in range(n_b) for end in ",;"]))
        for held, links in in_batches(batches, lengths):
            slots = index.lookup(links.pairs)
            there = slots >= 0
            out = {"row": [r[0] for r in held], "doc_id": [r[1] for r in held]}
            if first:
                texts = links.groups(*written)
                out |= {"n_a": links.n_a, "n_b": links.n_b, "n_groups": links.per_document(links.group_starts), "n_links": links.per_document(np.ones(len(links.pairs)))}
                out["groups_sha256"] = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
            else:
                out |= {name: np.zeros(len(held), np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
                out["groups_sha256"] = [""] * len(held)
            out["n_best"] = links.per_document(np.where(there, best[slots], 0))
            out["count_sum"] = exact_sums(links, np.where(there, counts[slots], 0))
            yield out

    return map_columns(rows, ["row", "doc_id", "ids_a", "ids_b"], work, SCHEMA)


def exact_sums(links: Alignment, values: np.ndarray) -> np.ndarray:
    """Sums per document in whole numbers; the links of a document stand together."""
    before = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(np.bincount(links.document, minlength=len(links.n_a)))
    return before[ends] - before[np.concatenate([[0], ends[:-1]])]


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, pattern: str = public_tokenizers.PATTERN, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a space and the text, B the text, to which it puts a space itself; special tokens inside texts are plain text.
    A document whose text is null or empty, or whose joined bytes of A or B differ from the space and the text, has no tokens:
    zeros and an empty string. Repeated rows and null ids are documents of their own. An empty table gives no rows. Columns
    other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    with open(path_a or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(path_b or public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        files = (a.read(), b.read(), pattern)
    shared = spark.sparkContext.broadcast(files)
    rows = encoded(docs, lambda: Encoders(*shared.value))
    encoders = Encoders(*files)
    lengths = tuple(np.array([len(t) for t in side.bytes], np.int64) for side in (encoders.a, encoders.b))
    pairs = distinct_pairs(rows, lengths)
    slices = max(1, -(-pairs.count() // slice_pairs))
    mine = F.pmod(F.xxhash64(F.expr(f"pair div {len(lengths[1])}")), F.lit(slices))
    out = None
    for number in range(slices):
        keys = np.sort(np.array(pairs.where(mine == number).toArrow()["pair"], np.int64))
        index = PairHash(keys)
        part = looked_up(rows, lengths, index, document_counts(rows, lengths, index), number == 0)
        out = part if out is None else out.unionByName(part)
    if slices > 1:
        sums = [F.sum(c).cast("bigint").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
        out = out.groupBy("row").agg(F.min("doc_id").alias("doc_id"), *sums, F.max("groups_sha256").alias("groups_sha256"))
    return out.drop("row")
