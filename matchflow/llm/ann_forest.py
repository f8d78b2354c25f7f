"""Nearest neighbours by largest inner product: a forest of random-projection trees and exact reranking.

Each tree cuts the vectors at the median along the line between two random points, on a sample of at most SAMPLE vectors,
until a leaf holds about LEAF vectors of the sample. A query walks all trees at once through one priority queue, ordered by
how far it lies on the wrong side of the cuts on the way, and takes the first ``visits`` leaves. How many that are is
measured: on the sample, brute force gives the true neighbours of TRIALS queries, and ``visits`` is the least number that
finds the share RECALL of them. In a larger table neighbours lie nearer, so more of them are found.

All rows are indexed. Rows and queries meet per leaf, in blocks of about BLOCK by BLOCK, so vectors are moved once per tree
and scores are matrix products; only the best of a block leave it. Equal vectors are one class, of which the smallest ids are
kept, as no more can be among the nearest; so a vector that very many rows share is one row of the index.

Vectors of different length are lifted by one component to the length of the longest, so that the nearest direction is the
largest inner product; the query's own component is zero.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchflow.session import materialise

NEIGHBOURS = 20
TREES = 4
LEAF = 256
SAMPLE = 20_000
RECALL = 0.95
TRIALS = 200
BLOCK = 2048
SEED = 7


class Forest:
    """Balanced trees of ``depth`` cuts; nodes are numbered from the root as in a heap, leaves from 0."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.depth = max(0, int(np.ceil(np.log2(max(len(sample), 1) / leaf))))
        self.inner = (1 << self.depth) - 1
        self.normals = np.zeros((trees, self.inner, sample.shape[1]), np.float32)
        self.cuts = np.zeros((trees, self.inner), np.float32)
        for tree in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(self.inner):
                here = members.pop(node)
                normal = rng.standard_normal(sample.shape[1])
                for _ in range(3 if len(here) > 1 else 0):  # two points that differ give the direction
                    a, b = sample[rng.choice(here, 2, replace=False)]
                    if np.any(a != b):
                        normal = a - b
                        break
                normal = normal / np.linalg.norm(normal)
                along = sample[here] @ normal
                cut = np.median(along) if len(here) else 0.0
                self.normals[tree, node], self.cuts[tree, node] = normal, cut
                above = along > self.cuts[tree, node]
                members[2 * node + 1], members[2 * node + 2] = here[~above], here[above]

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of every vector in every tree."""
        found = np.zeros((len(vectors), len(self.cuts)), np.int64)
        for tree in range(len(self.cuts)):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                along = np.einsum("ij,ij->i", vectors, self.normals[tree][node])
                node = 2 * node + 1 + (along > self.cuts[tree][node])
            found[:, tree] = node - self.inner
        return found

    def search(self, vector: np.ndarray, leaves: int) -> list[tuple[int, int]]:
        """The (tree, leaf) pairs that come first from one queue over all trees."""
        margins = (self.normals @ vector - self.cuts).tolist()
        queue = [(-np.inf, tree, 0) for tree in range(len(margins))]
        found: list[tuple[int, int]] = []
        while queue and len(found) < leaves:
            cost, tree, node = heapq.heappop(queue)
            if node >= self.inner:
                found.append((tree, node - self.inner))
                continue
            margin = margins[tree][node]
            heapq.heappush(queue, (max(cost, -margin), tree, 2 * node + 2))
            heapq.heappush(queue, (max(cost, margin), tree, 2 * node + 1))
        return found


def measured_visits(forest: Forest, sample: np.ndarray, queries: np.ndarray, k: int, recall: float) -> int:
    """Leaves that a query has to visit so that the share ``recall`` of its ``k`` nearest in the sample is met."""
    where = forest.leaves(sample)
    shape = where.shape[1], forest.inner + 1
    ranks = []
    for query in queries:
        scores = sample @ query
        nearest = np.argsort(-scores, kind="stable")[: k + 1]
        order = np.zeros(shape, np.int64)
        for place, (tree, leaf) in enumerate(forest.search(query, shape[0] * shape[1])):
            order[tree, leaf] = place + 1
        ranks.append(order[np.arange(shape[0])[None, :], where[nearest]].min(axis=1))
    return int(np.quantile(np.concatenate(ranks), recall, method="higher")) if ranks else 1


def usable(vector: Column) -> Column:
    """Neither null nor zero, and every component is a finite number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False)) & F.exists(vector, lambda x: x != 0)


def best_of(there: np.ndarray, query: np.ndarray, products: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the ``n`` largest inner products, ties in the order of the rows.

    ``products`` may differ from the exact scores by rounding, which is bounded relative to the lengths; whatever lies within that
    bound of the n-th largest is scored exactly.
    """
    near = np.arange(len(products))
    if len(products) > n:
        bound = 4 * len(query) * np.finfo(np.float64).eps * np.linalg.norm(query) * np.linalg.norm(there, axis=1).max()
        near = np.flatnonzero(products >= np.partition(products, -n)[-n] - bound)
    exact = (there[near] * query).sum(axis=1)
    order = np.argsort(-exact, kind="stable")[:n]
    return near[order], exact[order]


def stack(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def nearest(
    rows: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = NEIGHBOURS,
    trees: int = TREES,
    leaf: int = LEAF,
    sample_rows: int = SAMPLE,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` nearest found of every query row: query_id, rank (from 1), vec_id and score.

    Candidates are all rows with another id. Nearness is the inner product in double precision, ties go to the smaller id. A
    vector that is null, zero or holds a null or a number that is not finite takes no part, nor does one whose length is not
    the most frequent one, nor a row without id. Repeated rows (same id and vector) count once. With fewer than ``k``
    candidates all are returned. Other columns are ignored; an empty table gives no rows.
    """
    spark = rows.sparkSession
    out = "query_id bigint, rank int, vec_id bigint, score double"
    valid = rows.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"), is_query.alias("asks"))
    valid = valid.where(usable(F.col("vector")) & F.col("id").isNotNull())
    sizes = valid.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return spark.createDataFrame([], out)
    valid = valid.where(F.size("vector") == sizes["n"])
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    classes = valid.groupBy("vector").agg(F.min("id").alias("class"), F.bool_or(F.coalesce("asks", F.lit(False))).alias("asks"))
    classes = materialise(classes.withColumn("length", length), "vectors")
    total = classes.agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("int")).alias("q"), F.max("length").alias("m")).first()
    longest = total["m"]

    def lifted(vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / longest  # the trees see the same for vectors of any scale
        return np.column_stack([scaled, np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))])

    def asking(vectors: np.ndarray) -> np.ndarray:
        return np.column_stack([vectors / np.linalg.norm(vectors, axis=1, keepdims=True), np.zeros(len(vectors))])

    share = min(1.0, sample_rows / total["n"])
    picked = classes.where(F.pmod(F.xxhash64("class"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("class").limit(sample_rows).select("vector").toPandas()
    plain = stack(picked["vector"]) if len(picked) else np.zeros((0, sizes["n"]))
    sample = lifted(plain)
    forest = Forest(sample, trees, leaf)
    visits = measured_visits(forest, sample, asking(plain[:TRIALS]), k, recall) if len(plain) else trees
    leaves = forest.inner + 1
    query_blocks = max(1, -(-total["q"] * visits // (trees * leaves * block)))
    shared = spark.sparkContext.broadcast(forest)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in np.array_split(np.arange(len(pdf)), max(1, len(pdf) // block)):
                found = shared.value.leaves(lifted(stack(pdf["vector"].iloc[part]))) if len(part) else np.zeros((0, trees), np.int64)
                for tree in range(found.shape[1]):
                    yield pd.DataFrame({"tree": tree, "leaf": found[:, tree], "id": pdf["class"].to_numpy()[part], "vector": pdf["vector"].to_numpy()[part]})

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for id_, vector in zip(pdf["class"], pdf["vector"]):
                found = np.array(shared.value.search(asking(np.asarray(vector)[None, :])[0], visits))
                yield pd.DataFrame({"tree": found[:, 0], "leaf": found[:, 1], "id": id_, "vector": [vector] * len(found)})

    placed = "tree int, leaf int, id bigint, vector array<double>"
    indexed = classes.select("class", "vector").mapInPandas(index, placed)
    per_leaf = classes.select("class", "vector").mapInPandas(index, placed).groupBy("tree", "leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    parts = {(r["tree"], r["leaf"]): r["parts"] for r in per_leaf.where("parts > 1").collect()}  # at most trees * leaves rows
    many = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for (t, i), n in parts.items() for x in (t * leaves + i, n))), F.col("tree") * leaves + F.col("leaf")), F.lit(1)) if parts else F.lit(1)
    own = lambda n, name: F.pmod(F.xxhash64("id"), n).cast("int").alias(name)
    indexed = indexed.select("*", own(many, "part"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("asked"))
    asked = classes.where("asks").select("class", "vector").mapInPandas(ask, placed)
    asked = asked.select("*", own(F.lit(query_blocks), "asked"), F.explode(F.sequence(F.lit(0), many - 1)).alias("part"))
    keys = ["tree", "leaf", "part", "asked"]

    def score(queries: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or there.empty:
            return pd.DataFrame({"query": [], "id": [], "score": []})
        q, x = stack(queries["vector"]), stack(there["vector"])
        order = np.argsort(there["id"].to_numpy(), kind="stable")
        x, ids = x[order], there["id"].to_numpy()[order]
        best = [best_of(x, v, products, k + 1) for v, products in zip(q, q @ x.T)]
        places, exact = np.concatenate([b for b, _ in best]), np.concatenate([e for _, e in best])
        return pd.DataFrame({"query": np.repeat(queries["id"].to_numpy(), [len(b) for b, _ in best]), "id": ids[places], "score": exact})

    scored = asked.groupBy(*keys).cogroup(indexed.groupBy(*keys)).applyInPandas(score, "query bigint, id bigint, score double")
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = scored.groupBy("query", "id").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(best_first)).where(f"r <= {k + 1}").drop("r")
    smallest = valid.select("vector", "id").distinct().withColumn("r", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(f"r <= {k + 1}")
    members = smallest.join(classes.select("vector", "class"), "vector").select(F.col("class").alias("id"), F.col("id").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    spread = top.join(members, "id").withColumn("r", F.row_number().over(order)).where(f"r <= {k + 1}").select("query", "vec_id", "score")
    queries = valid.where("asks").select("vector", F.col("id").alias("query_id")).distinct().join(classes.select("vector", F.col("class").alias("query")), "vector").select("query_id", "query")
    ranked = queries.join(spread, "query").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return ranked.withColumn("rank", rank).where(f"rank <= {k}").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
