"""SimHash fingerprints and near duplicates by BK-trees.

Two fingerprints of 64 bits that differ in at most three agree in one of four blocks of 16 bits at least (in general, with
more blocks, in as many as these exceed the radius), so the shards of the search are the fingerprints with these blocks in
common: each gets a BK-tree, in which a child hangs on its parent by the
Hamming distance between the two, and a search follows only the edges whose distance is within the radius of its own.
Fingerprints are made distinct first. A shard of more than ``shard_rows`` is cut into several trees, and its fingerprints
are sent to each of them as queries, so no task holds more than a tree and its queries. A shard returns the links of a
spanning forest, not all pairs.

Shard trees are not broadcast: fingerprints of all documents have no size bound. They are shuffled by their blocks instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchflow.llm.common import let_go, map_columns
from matchflow.llm.components import components
from matchflow.llm.suffix_dedup import keyed, whole_rows
from matchflow.session import materialise

RADIUS = 3
BLOCKS = 4
SHINGLE = 3
SEED = 42
SHARD_ROWS = 4096
UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(UPPER, UPPER.lower())
ONE_BY_ONE = 24


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned SimHash of the word shingles; 0 without words."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    parts = list(map(b" ".join, zip(*(words[i:] for i in range(shingle))))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(seed)), np.uint64, len(parts))
    votes = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(parts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, keys: str = "doc_id bigint") -> DataFrame:
    """The columns of ``keys`` (names and types) and bits (the fingerprint as a signed bigint); null texts count as empty."""
    names = [key.split()[0] for key in keys.split(", ")]

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        let_go()
        for *values, texts in batches:
            bits = np.array([fingerprint(t or "", shingle, seed) for t in texts], np.uint64)
            yield {**dict(zip(names, values)), "bits": bits.view(np.int64).tolist()}

    return map_columns(docs, [*names, "text"], work, f"{keys}, bits bigint")


class BKTree:
    """Children of a node by their Hamming distance to it."""

    def __init__(self):
        self.nodes: list[int] = []
        self.children: list[dict[int, int]] = []

    def insert(self, value: int) -> None:
        self.nodes.append(value)
        self.children.append({})
        if len(self.nodes) == 1:
            return
        at = 0
        while True:
            distance = (self.nodes[at] ^ value).bit_count()
            if distance not in self.children[at]:
                self.children[at][distance] = len(self.nodes) - 1
                return
            at = self.children[at][distance]

    def search(self, value: int, radius: int) -> list[int]:
        """Numbers of the nodes within the radius."""
        found, stack = [], [0] if self.nodes else []
        while stack:
            at = stack.pop()
            distance = (self.nodes[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            stack += [child for edge, child in self.children[at].items() if abs(edge - distance) <= radius]
        return found

    def search_all(self, values: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each node that has some: its number, and the indices of the values within the radius."""
        stack = [(0, np.arange(len(values)))] if self.nodes else []
        while stack:
            at, which = stack.pop()
            distance = np.bitwise_count(values[which] ^ np.uint64(self.nodes[at])).astype(np.int64)
            near = which[distance <= radius]
            if len(near):
                yield at, near
            for edge, child in self.children[at].items():
                follow = which[np.abs(distance - edge) <= radius]
                if len(follow):
                    stack.append((child, follow))


def forest(members: np.ndarray, queries: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that connect the queries and members within the radius: value and smallest value of its component.

    ``queries`` are searched besides the members themselves.
    """
    values = np.concatenate([members, queries])
    label = np.arange(len(values))
    tree = BKTree()
    if len(values) <= ONE_BY_ONE:
        whole = values.tolist()
        for i, value in enumerate(whole):
            for j in tree.search(value, radius):
                if label[i] != label[j]:
                    label[label == max(label[i], label[j])] = min(label[i], label[j])
            if i < len(members):
                tree.insert(value)
    else:
        for value in members.tolist():
            tree.insert(value)
        for node, near in tree.search_all(values, radius):
            groups = np.unique(np.append(label[near], label[node]))
            if len(groups) > 1:
                label[np.isin(label, groups)] = groups[0]
    least = np.full(len(values), np.iinfo(np.int64).max)
    signed = values.view(np.int64)
    np.minimum.at(least, label, signed)
    root = least[label]
    linked = root != signed
    return signed[linked].tolist(), root[linked].tolist()


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges a, b whose components are those of all pairs within the radius; ``distinct`` has the column bits."""
    if blocks <= radius or 64 % blocks or (blocks - radius) * (64 // blocks) > 62:
        raise ValueError("more blocks than the radius, dividing 64, are needed")
    width = 64 // blocks
    block = [F.shiftrightunsigned("bits", i * width).bitwiseAND((1 << width) - 1) for i in range(blocks)]
    keys = []
    for number, agree in enumerate(combinations(range(blocks), blocks - radius)):
        key = F.lit(0).cast("bigint")
        for i in agree:
            key = F.shiftleft(key, width) + block[i]
        keys.append(F.struct(F.lit(number).alias("block"), key.alias("key")))
    rows = distinct.select("bits", F.explode(F.array(*keys)).alias("k")).select("bits", "k.block", "k.key")
    hot = rows.groupBy("block", "key").count().where(F.col("count") > shard_rows).select("block", "key", F.ceil(F.col("count") / shard_rows).cast("int").alias("trees"))
    rows = rows.join(hot, ["block", "key"], "left").withColumn("trees", F.coalesce("trees", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("bits"), F.col("trees")).cast("int"))
    rows = rows.select("block", "key", "own", "bits", F.explode(F.sequence(F.col("own"), F.col("trees") - 1)).alias("tree"))
    shards = rows.repartition("block", "key", "tree").sortWithinPartitions("block", "key", "tree", "bits")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, bits, own in _groups(batches):
            mine = own == key[2]
            a, b = forest(bits[mine], bits[~mine], radius)
            if a:
                yield pa.RecordBatch.from_pydict({"a": a, "b": b}, schema=out)

    return shards.select("block", "key", "tree", "own", "bits").mapInArrow(search, "a bigint, b bigint")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """Groups of two rows or more of sorted batches: key, bits (unsigned) and own trees; a group may span batches."""
    rest = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            columns = [np.concatenate([x, y]) for x, y in zip(rest, columns)]
        change = np.flatnonzero((columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]) | (columns[2][1:] != columns[2][:-1])) + 1
        starts = np.concatenate([[0], change])
        yield from _cut(columns, starts)
        rest = [c[starts[-1] :] for c in columns]
    if rest is not None:
        yield from _cut(rest, np.array([0, len(rest[0])]))


def _cut(columns: list[np.ndarray], starts: np.ndarray) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    bits = columns[4].astype(np.int64).view(np.uint64)
    for i in np.flatnonzero(np.diff(starts) > 1):
        x, y = starts[i], starts[i + 1]
        yield (columns[0][x], columns[1][x], columns[2][x]), bits[x:y], columns[3][x:y]


def with_roots(distinct: DataFrame, radius: int, blocks: int, shard_rows: int) -> DataFrame:
    """Add root, one of the fingerprints of the component, to a table of distinct ``bits``."""
    found = components(links(distinct.select("bits"), radius, blocks, shard_rows))
    return distinct.join(found.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, radius: int = RADIUS, blocks: int = BLOCKS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Columns doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id of its component).

    Every row gets a row. Null and empty texts, and texts without words, have fingerprint zero and are linked like others.
    Null ids do not count for the smallest id; a component without any id has a null component_id. Repeated rows link by
    distance 0. Columns other than doc_id and text are ignored; an empty table gives no rows.
    """
    prints = materialise(fingerprints(docs, shingle, seed), "fingerprints")
    distinct = prints.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    rooted = with_roots(distinct, radius, blocks, shard_rows)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.select("bits", "root").join(least, "root").select("bits", "component_id")
    return prints.join(named, "bits").select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, radius: int = RADIUS, blocks: int = BLOCKS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of ``docs`` for each component of near_duplicates; its columns stay as they are.

    The row of the smallest id stays; rows with a null id come last. Of several texts of one id the one of the smaller hash
    stays, and of repeated rows, which count as copies, the one whose other columns come first as JSON. Null and empty texts
    and texts without words are one component. A row whose fingerprint is unlike all others stays, whatever its id; an empty
    table gives no rows. Repeated rows are summed up before the shuffle.
    """
    rows = keyed(whole_rows(docs)).withColumn("unnamed", F.col("doc_id").isNull())
    prints = materialise(fingerprints(rows, shingle, seed, "unnamed boolean, k1 bigint, k2 bigint"), "fingerprints")
    distinct = prints.groupBy("bits").agg(F.min(F.struct("unnamed", "k1", "k2")).alias("first"))
    heads = with_roots(distinct, radius, blocks, shard_rows).groupBy("root").agg(F.min("first").alias("first"))
    others = F.to_json(F.struct(F.col("text").isNull().alias("_"), *[F.col("row")[c].alias(c) for c in docs.columns if c != "text"]))
    unique = rows.groupBy("k1", "k2").agg(F.min_by("row", others).alias("row"))
    kept = unique.join(materialise(heads.select("first.k1", "first.k2"), "heads"), ["k1", "k2"], "left_semi")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
