"""Removal of byte strings that stand more than once, by a distributed merge sort of suffixes.

Every byte of a string of ``length`` bytes that also starts anywhere else is removed. Not all suffixes are sorted: of every
``length`` bytes at least one suffix is taken, chosen by content (the k-mers of least hash in a window), so two equal strings
have the same chosen suffix at the same place. Steps, each a shuffle:

1. Votes. Chosen suffixes whose k-mer stands nowhere else are dropped; tasks sum up their own repeats before the exchange.
2. Runs. Around every suffix left, the ``length`` bytes from it and the bytes before it, read backwards, form its key. Each
   task sorts its keys, keeps equal ones once, and sends front-coded pieces of the run to the ranges that own them.
3. Merge. A range merges its runs by a loser tree that never compares a known common prefix again. Equal keys are repeats
   as a whole. Among the different keys that share a k-mer, which follow each other, the neighbours by order, to the right
   and read backwards, bound how far a suffix can be repeated; a suffix that the bounds do not settle is compared with the
   others of its k-mer.
4. Windows. If a k-mer has so many different surroundings that it fills several ranges, or more than ``group_rows``, it is not
   held in one task: all strings of ``length`` bytes around it are sorted and merged in the same way, and equal ones count.

What has been found are spans of documents; they are joined with the texts once more to cut them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchflow.llm.common import map_columns
from matchflow.llm.linear import bounded_sample
from matchflow.llm.suffix_runs import MANY, REPEATED, Owner, common_prefix, cut_run, merge
from matchflow.session import materialise

LENGTH = 200
GROUP_ROWS = 100_000
SPLITTER_DOCUMENTS = 2000
SPLITTERS = 20_000
RUN_KEYS = 100_000
FLUSH_ANCHORS = 1_000_000
PIECE = 1 << 20
END = b"\xff"  # never part of UTF-8; ends a part of a key that the end of its document cuts short
FACTOR = 0x9E3779B97F4A7C15
ROUTED = "target int, kind int, blob binary"
FOUND = "kind int, k1 bigint, k2 bigint, a bigint, b bigint, blob binary"


def kmer_size(length: int) -> int:
    return max(1, length * 12 // 25)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(FACTOR, n, 1 << 64))


def kmer_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every k-mer, put together from those of lengths 1, 2, 4, ..."""
    if len(data) < k:
        return np.zeros(0, np.uint64)
    part = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    part ^= part >> np.uint64(32)
    whole, done, size = None, 0, 1
    while True:
        if k & size:
            if whole is None:
                whole = part
            else:
                n = len(data) - (done + size) + 1
                whole = whole[:n] * _power(size) + part[done : done + n]
            done += size
        if done == k:
            break
        n = len(part) - size
        part = part[:n] * _power(size) + part[size : size + n]
        size *= 2
    whole = (whole ^ (whole >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return whole ^ (whole >> np.uint64(32))


def _sliding(f: Callable, x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = f(x[:-size], x[size:])
        size *= 2
    n = len(x) - (width - size)
    return f(x[:n], x[width - size : width - size + n])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the chosen k-mers: those of least hash in any window of length - k + 1 k-mers."""
    k = kmer_size(length)
    width = length - k + 1
    found = []
    for start in range(0, max(len(data) - length + 1, 0), PIECE):
        h = kmer_hashes(data[start : start + PIECE + length - 1], k)
        pad = np.zeros(width - 1, np.uint64)
        least = np.concatenate([pad, _sliding(np.minimum, h, width), pad])
        at = np.flatnonzero(_sliding(np.maximum, least, width) == h)
        found.append((at + start, h[at]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, hashes = (np.concatenate(x) for x in zip(*found))
    place, first = np.unique(place, return_index=True)
    return place.astype(np.int64), hashes[first]


def context(data: bytes, place: int, length: int) -> tuple[bytes, bytes]:
    """The bytes from a place on, and those before it, backwards."""
    return data[place : place + length], data[max(0, place - length + kmer_size(length)) : place][::-1]


def key_of(right: bytes, left: bytes, length: int) -> bytes:
    return right + left if len(right) == length else right + END + left


def parts_of(key: bytes, length: int) -> tuple[bytes, bytes]:
    end = key.find(END, 0, length)
    return (key[:length], key[length:]) if end < 0 else (key[:end], key[end + 1 :])


def keyed(docs: DataFrame) -> DataFrame:
    """Add k1 and k2, by which a row is found again: the id, and a hash of text and whether the id is null."""
    return docs.withColumns({"k1": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), "k2": F.xxhash64(F.coalesce("text", F.lit("")), F.col("doc_id").isNull())})


def whole_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row as one column, so that no other column's name clashes with those of the work."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id"), F.col("text"))


def row_columns(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` out of whole_rows, the text as it has become."""
    return [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Rows (target, kind, blob) sorted by target: each target with its kinds and blobs."""
    rows = ((t, kind, blob) for batch in batches for t, kind, blob in zip(*(c.to_pylist() for c in batch.columns)))
    for target, members in groupby(rows, key=lambda r: r[0]):
        yield target, [(kind, blob) for _, kind, blob in members]


def _route(df: DataFrame, targets: int) -> DataFrame:
    return df.repartition(targets, "target").sortWithinPartitions("target")


def _pack(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.concatenate([np.ascontiguousarray(c).view(np.uint8) for c in (np.array([len(c) for c in columns], "<i8"), *columns)]).tobytes())


def _unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    sizes, at, out = np.frombuffer(data, "<i8", len(types)).tolist(), 8 * len(types), []
    for n, kind in zip(sizes, types):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def repeated_anchors(docs: DataFrame, length: int, targets: int) -> DataFrame:
    """Rows k1, k2, place: chosen suffixes whose k-mer (by 40 bits of its hash and its target) stands more than once."""

    def vote(batches: Iterator[list[list]]) -> Iterator[dict]:
        k1s, k2s, number, places, hashes, held = [], [], [], [], [], 0

        def flush() -> Iterator[dict]:
            k1, k2 = np.array(k1s, "<i8"), np.array(k2s, "<i8")
            doc, place, h = np.concatenate(number), np.concatenate(places), np.concatenate(hashes)
            _, first, where, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            often = count[where] > 1
            sent_doc, sent_place = doc.copy(), place.copy()
            sent_place[often] = REPEATED
            target = ((h & np.uint64(0xFFFFFF)) % np.uint64(targets)).astype(np.int64)
            first = first[np.argsort(target[first], kind="stable")]
            ends = np.searchsorted(target[first], np.arange(targets + 1))
            for t in range(targets):
                one = np.sort(first[ends[t] : ends[t + 1]])
                if len(one):
                    used, local = np.unique(sent_doc[one], return_inverse=True)
                    short = (h[one] >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]
                    yield {"target": [t], "kind": [0], "blob": [_pack(short.ravel(), k1[used], k2[used], local.astype("<u4"), sent_place[one].astype("<i8"))]}
            if often.any():
                yield {"target": [int(h[0] % np.uint64(targets))], "kind": [1], "blob": [_pack(k1[doc[often]], k2[doc[often]], place[often].astype("<i8"))]}

        for texts, a, b in batches:
            for text, x, y in zip(texts, a, b):
                place, h = anchors(np.frombuffer(text.encode(), np.uint8), length)
                k1s.append(x)
                k2s.append(y)
                number.append(np.full(len(place), len(k1s) - 1))
                places.append(place)
                hashes.append(h)
                held += len(place)
                if held >= FLUSH_ANCHORS:
                    yield from flush()
                    k1s, k2s, number, places, hashes, held = [], [], [], [], [], 0
        if held:
            yield from flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("place", pa.int64())])
        for _, members in _grouped(batches):
            short, k1, k2, place = [], [], [], []
            for kind, blob in members:
                if kind == 1:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _unpack(blob, "<i8", "<i8", "<i8")], schema=schema)
                else:
                    s, a, b, local, p = _unpack(blob, "u1", "<i8", "<i8", "<u4", "<i8")
                    wide = np.zeros((len(p), 8), np.uint8)
                    wide[:, :5] = s.reshape(-1, 5)
                    short.append(wide.view("<u8").ravel())
                    k1.append(a[local])
                    k2.append(b[local])
                    place.append(p)
            if short:
                h, a, b, p = (np.concatenate(x) for x in (short, k1, k2, place))
                _, where, votes = np.unique(h, return_inverse=True, return_counts=True)
                keep = (votes[where] > 1) & (p != REPEATED)
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (a, b, p)], schema=schema)

    long_enough = docs.where(F.octet_length("text") >= length)
    votes = map_columns(long_enough, ["text", "k1", "k2"], vote, ROUTED)
    return _route(votes, targets).mapInArrow(count, "k1 bigint, k2 bigint, place bigint")


def splitters_of(docs: DataFrame, length: int, ranges: int, documents: int = SPLITTER_DOCUMENTS) -> tuple[list[bytes], set[bytes]]:
    """Splitters of ``ranges`` ranges by a bounded sample of keys, and the k-mers that fill more than one range.

    A splitter is cut after its k-mer, so that a k-mer's keys stay in one range, unless the k-mer is one of those.
    """
    k = kmer_size(length)

    def keys(batches: Iterator[list[list]]) -> Iterator[dict]:
        for (texts,) in batches:
            out = []
            for text in texts:
                data = text.encode()
                place, h = anchors(np.frombuffer(data, np.uint8), length)
                out += [key_of(*context(data, p, length), length) for p in place[h % np.uint64(16) == 0].tolist()]
            yield {"key": out}

    long_enough = docs.where(F.octet_length("text") >= length)
    sample = bounded_sample(long_enough.select("k2", "text"), "k2", documents)
    found = sorted(bytes(r["key"]) for r in map_columns(sample, ["text"], keys, "key binary").limit(SPLITTERS).collect())
    return _cuts(found, ranges, k)


def _cuts(found: list[bytes], ranges: int, k: int) -> tuple[list[bytes], set[bytes]]:
    picked = [found[i * len(found) // ranges] for i in range(1, ranges)] if found else []
    counts: dict[bytes, int] = {}
    for key in picked:
        counts[key[:k]] = counts.get(key[:k], 0) + 1
    wide = {m for m, n in counts.items() if n > 2}
    return sorted({key if key[:k] in wide else key[:k] for key in picked}), wide


def _runs(joined: DataFrame, length: int, splitters: list[bytes]) -> DataFrame:
    """Routed rows: pieces of sorted runs (kind 0) and spans that are settled within a task (kind 1)."""
    shared = joined.sparkSession.sparkContext.broadcast(splitters)

    def sort(batches: Iterator[list[list]]) -> Iterator[dict]:
        entries: dict[bytes, Owner] = {}
        settled: list[Owner] = []

        def flush() -> Iterator[dict]:
            for number, blob in cut_run(entries, shared.value):
                yield {"target": [number], "kind": [0], "blob": [blob]}
            if settled:
                spans = np.array(settled, "<i8").reshape(-1, 4)
                yield {"target": [int(spans[0, 1] % (len(shared.value) + 1))], "kind": [1], "blob": [_pack(*spans.T)]}

        for texts, k1s, k2s, all_places in batches:
            for text, k1, k2, places in zip(texts, k1s, k2s, all_places):
                data = text.encode()
                for place in places:
                    right, left = context(data, place, length)
                    key = key_of(right, left, length)
                    before = entries.get(key)
                    if before is None:
                        entries[key] = (k1, k2, place)
                        continue
                    if before[2] != REPEATED:
                        settled.append((before[0], before[1], before[2] - len(left), before[2] + len(right)))
                        entries[key] = MANY
                    settled.append((k1, k2, place - len(left), place + len(right)))
                if len(entries) >= RUN_KEYS or len(settled) >= 5 * RUN_KEYS:
                    yield from flush()
                    entries, settled = {}, []
        yield from flush()

    return map_columns(joined, ["text", "k1", "k2", "places"], sort, ROUTED)


Member = tuple[bytes, bytes, Owner]


def resolve(members: list[Member], length: int) -> Iterator[tuple[Owner, int, int]]:
    """Repeated spans of the different keys of one k-mer, in order of their keys: owner, bytes before and after its place.

    A partner that shares l bytes before and r after makes the span from -l to r a repeat if l + r reaches ``length``; all
    such spans hold the place, so their union is one span.
    """
    if len(members) < 2 or all(owner[2] == REPEATED for _, _, owner in members):
        return
    back = length - kmer_size(length)
    n = len(members)
    rights = [common_prefix(members[i][0], members[i + 1][0]) for i in range(n - 1)]
    by_left = sorted(range(n), key=lambda i: members[i][1])
    lefts = [common_prefix(members[i][1], members[j][1]) for i, j in zip(by_left, by_left[1:])]
    place_of = [0] * n
    for p, i in enumerate(by_left):
        place_of[i] = p
    table = None
    for i, (right, left, owner) in enumerate(members):
        if owner[2] == REPEATED:
            continue
        p = place_of[i]
        most_right = max(rights[i - 1] if i else 0, rights[i] if i + 1 < n else 0)
        most_left = max(lefts[p - 1] if p else 0, lefts[p] if p + 1 < n else 0)
        if most_left + most_right < length:
            continue
        before = after = -1
        partners = {j for j in (i - 1, i + 1) if 0 <= j < n} | {by_left[q] for q in (p - 1, p + 1) if 0 <= q < n}
        for j in partners:
            r, l = common_prefix(right, members[j][0]), common_prefix(left, members[j][1])
            if l + r >= length:
                before, after = max(before, l), max(after, r)
        if before < min(most_left, back) or after < most_right:
            if table is None:
                table = _left_table(members, back), np.array([*rights, 0], np.int64)
            shares_left = _shared_left(table[0], i)
            shares_right = np.concatenate([np.minimum.accumulate(table[1][:i][::-1])[::-1], [0], np.minimum.accumulate(table[1][i : n - 1])])
            fits = shares_left + shares_right >= length
            if fits.any():
                before, after = max(before, int(shares_left[fits].max())), max(after, int(shares_right[fits].max()))
        if after >= 0:
            yield owner, before, after


def _left_table(members: list[Member], back: int) -> np.ndarray:
    """Bytes before each place as numbers, with the end of the document as a number that equals nothing."""
    table = np.full((len(members), back + 1), -1, np.int16)
    for i, (_, left, _) in enumerate(members):
        table[i, : len(left)] = np.frombuffer(left, np.uint8)
    return table


def _shared_left(table: np.ndarray, i: int) -> np.ndarray:
    differs = (table != table[i]) | (table < 0)
    return np.argmax(differs, axis=1)


def _spans(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    k1, k2, a, b = zip(*rows) if rows else ((), (), (), ())
    return _found(np.zeros(len(k1), np.int32), k1, k2, a, b, [None] * len(k1))


def _found(*columns) -> pa.RecordBatch:
    names = ["kind", "k1", "k2", "a", "b", "blob"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _merged(runs: DataFrame, length: int, ranges: int, wide: set[bytes], group_rows: int) -> DataFrame:
    """Spans (kind 0), and the keys of k-mers that are too frequent for one task (kind 1, the place in a)."""
    shared, k = runs.sparkSession.sparkContext.broadcast(wide), kmer_size(length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in _grouped(batches):
            out: list[tuple] = []
            handed: list[tuple] = []
            group: list[Member] = []
            kmer, loose = None, False

            def hand_on(right: bytes, left: bytes, owner: Owner) -> None:
                handed.append((1, owner[0], owner[1], owner[2], 0, key_of(right, left, length)))

            for kind, blob in members:
                if kind == 1:
                    k1, k2, a, b = _unpack(blob, "<i8", "<i8", "<i8", "<i8")
                    yield _found(np.zeros(len(k1), np.int32), k1, k2, a, b, [None] * len(k1))
            for key, _, owners in merge([blob for kind, blob in members if kind == 0]):
                right, left = parts_of(key, length)
                if len(owners) > 1 or owners[0][2] == REPEATED:
                    out += [(x, y, p - len(left), p + len(right)) for x, y, p in owners if p != REPEATED]
                    owners = [MANY]
                if right[:k] != kmer:
                    out += [(o[0], o[1], o[2] - l, o[2] + r) for o, l, r in resolve(group, length)]
                    group, kmer = [], right[:k]
                    loose = kmer in shared.value
                if loose:
                    hand_on(right, left, owners[0])
                else:
                    group.append((right, left, owners[0]))
                    if len(group) > group_rows:
                        loose = True
                        for member in group:
                            hand_on(*member)
                        group = []
                if len(out) > 50_000:
                    yield _spans(out)
                    out = []
                if len(handed) > 10_000:
                    yield _found(*zip(*handed))
                    handed = []
            out += [(o[0], o[1], o[2] - l, o[2] + r) for o, l, r in resolve(group, length)]
            yield _spans(out)
            if handed:
                yield _found(*zip(*handed))

    return _route(runs, ranges).mapInArrow(work, FOUND)


def _windows(handed: DataFrame, length: int, ranges: int) -> DataFrame:
    """Spans from the strings of ``length`` bytes around the places of the keys handed on."""
    spark = handed.sparkSession

    def all_of(key: bytes, owner: Owner) -> Iterator[tuple[bytes, Owner]]:
        right, left = parts_of(key, length)
        whole = left[::-1] + right
        for start in range(len(whole) - length + 1 if len(whole) >= length else 0):
            if start > len(left):
                break
            yield whole[start : start + length], MANY if owner[2] == REPEATED else (owner[0], owner[1], owner[2] - len(left) + start)

    def sample(batches: Iterator[list[list]]) -> Iterator[dict]:
        for (blobs,) in batches:
            yield {"key": [w for b in blobs for i, (w, _) in enumerate(all_of(bytes(b), MANY)) if i % 21 == 10]}

    picked = bounded_sample(handed.select("blob"), "blob", SPLITTER_DOCUMENTS)
    found = sorted(bytes(r["key"]) for r in map_columns(picked, ["blob"], sample, "key binary").collect())
    splitters = sorted({found[i * len(found) // ranges] for i in range(1, ranges)}) if found else []
    shared = spark.sparkContext.broadcast(splitters)

    def sort(batches: Iterator[list[list]]) -> Iterator[dict]:
        entries: dict[bytes, Owner] = {}
        settled: list[Owner] = []

        def flush() -> Iterator[dict]:
            for number, blob in cut_run(entries, shared.value):
                yield {"target": [number], "kind": [0], "blob": [blob]}
            if settled:
                spans = np.array(settled, "<i8").reshape(-1, 3)
                yield {"target": [int(spans[0, 1] % (len(shared.value) + 1))], "kind": [1], "blob": [_pack(spans[:, 0], spans[:, 1], spans[:, 2], spans[:, 2] + length)]}

        for k1s, k2s, places, blobs in batches:
            for k1, k2, place, blob in zip(k1s, k2s, places, blobs):
                for window, owner in all_of(bytes(blob), (k1, k2, place)):
                    before = entries.get(window)
                    if before is None:
                        entries[window] = owner
                        continue
                    settled += [o for o in (before, owner) if o[2] != REPEATED and before != owner]
                    entries[window] = before if before == owner else MANY
                if len(entries) >= RUN_KEYS:
                    yield from flush()
                    entries, settled = {}, []
        yield from flush()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in _grouped(batches):
            out = []
            for kind, blob in members:
                if kind == 1:
                    k1, k2, a, b = _unpack(blob, "<i8", "<i8", "<i8", "<i8")
                    yield _found(np.zeros(len(k1), np.int32), k1, k2, a, b, [None] * len(k1))
            for _, _, owners in merge([blob for kind, blob in members if kind == 0]):
                if len(set(owners)) > 1 or owners[0][2] == REPEATED:
                    out += [(x, y, p, p + length) for x, y, p in owners if p != REPEATED]
            yield _spans(out)

    runs = map_columns(handed, ["k1", "k2", "a", "blob"], sort, ROUTED)
    return _route(runs, len(splitters) + 1).mapInArrow(match, FOUND)


def repeated_spans(rows: DataFrame, length: int = LENGTH, group_rows: int = GROUP_ROWS, ranges: int | None = None) -> DataFrame:
    """Columns k1, k2 and spans (array of a, b; may overlap) of the rows of ``keyed`` that hold repeated strings."""
    spark = rows.sparkSession
    ranges = ranges or 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    splitters, wide = splitters_of(rows, length, ranges)
    places = repeated_anchors(rows, length, ranges).groupBy("k1", "k2").agg(F.array_sort(F.collect_set("place")).alias("places"))
    joined = rows.select("k1", "k2", "text").join(places, ["k1", "k2"])
    found = materialise(_merged(_runs(joined, length, splitters), length, len(splitters) + 1, wide, group_rows), "spans")
    spans, handed = found.where("kind = 0"), found.where("kind = 1")
    if not handed.isEmpty():
        spans = spans.unionByName(_windows(handed, length, ranges))
    return spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[list[bytes], int, int]:
    """Parts of ``data`` outside the spans, bytes removed and number of maximal removed runs."""
    kept, end, removed, runs = [], 0, 0, 0
    for a, b in sorted(spans):
        if a > end or runs == 0:
            kept.append(data[end:a])
            runs += 1
            removed += b - a
            end = b
        elif b > end:
            removed += b - end
            end = b
    kept.append(data[end:])
    return kept, removed, runs


def _span_pairs(spans) -> list[tuple[int, int]]:
    return [(s["a"], s["b"]) for s in spans] if spans is not None else []


def removal_digests(docs: DataFrame, length: int = LENGTH, **settings) -> DataFrame:
    """Columns doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``.

    Null texts count as empty. Texts shorter than ``length`` bytes keep all. Matches never cross documents; a repeated row is
    another document. Ids may be null or repeated. Other columns are ignored; an empty table gives no rows.
    """
    rows = keyed(docs.select("doc_id", "text"))
    found = rows.join(repeated_spans(rows, length, **settings), ["k1", "k2"], "left")

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        for ids, texts, all_spans in batches:
            out: dict[str, list] = {"doc_id": ids, "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for text, spans in zip(texts, all_spans):
                data = (text or "").encode()
                kept, removed, runs = cut(data, _span_pairs(spans))
                digest = hashlib.sha256()
                for part in kept:
                    digest.update(part)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(removed)
                out["n_spans"].append(runs)
                out["kept_sha256"].append(digest.hexdigest())
            yield out

    return map_columns(found, ["doc_id", "text", "spans"], work, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH, **settings) -> DataFrame:
    """The rows of ``docs`` with the repeated strings cut out of their texts; a cut within a character drops it whole.

    Null texts stay null, all other columns stay as they are.
    """
    rows = keyed(whole_rows(docs))
    found = rows.join(repeated_spans(rows, length, **settings), ["k1", "k2"], "left")

    @F.pandas_udf("string")
    def kept(texts, all_spans):
        import pandas as pd

        def one(text, spans):
            if text is None or spans is None:
                return text
            return b"".join(cut(text.encode(), _span_pairs(spans))[0]).decode(errors="ignore")

        return pd.Series([one(t, s) for t, s in zip(texts, all_spans)], dtype=object)

    return found.withColumn("text", kept("text", "spans")).select(*row_columns(docs))
