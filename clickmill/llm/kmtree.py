"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first."""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import seeded_hash, share_of, stored
from clickmill.llm.embeddings import matrix, usable

SEED = 4
SAMPLE = 20_000  # vectors that the tree is fitted on
BRANCHES = 8
LEAF = 64  # sample vectors below which a node is not split
CALIBRATION = 200  # queries whose exact neighbours set the number of leaves
RECALL = 0.96  # that the calibration queries must reach
PART = 4096  # vectors or queries of a leaf that meet in one task
STEPS = 10  # of k-means


@dataclass
class Tree:
    """Nodes by number, 0 the root; a leaf has no children and a number among the leaves."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[np.ndarray] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def ordered_leaves(self, query: np.ndarray, wanted: int) -> list[int]:
        """Up to `wanted` leaves, best bin first: the nearest centre not yet opened goes next."""
        queue, found = [(0.0, 0)], []
        while queue and len(found) < wanted:
            _, node = heapq.heappop(queue)
            if not len(self.children[node]):
                found.append(self.leaf[node])
                continue
            below = self.children[node]
            away = ((self.centres[node] - query) ** 2).sum(axis=1)
            for child, distance in zip(below.tolist(), away.tolist()):
                heapq.heappush(queue, (distance, child))
        return found

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: at every node it goes to the nearest centre."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not len(self.children[node]):
                out[rows] = self.leaf[node]
                continue
            nearest = _squares(vectors[rows], self.centres[node]).argmin(axis=1)
            todo += [(int(child), part) for i, child in enumerate(self.children[node]) if len(part := rows[nearest == i])]
        return out


def _squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of rows, up to rounding."""
    return (left**2).sum(axis=1)[:, None] - 2 * left @ right.T + (right**2).sum(axis=1)


def _k_means(vectors: np.ndarray, k: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centres = vectors[random.choice(len(vectors), k, replace=False)]
    for _ in range(STEPS):
        own = _squares(vectors, centres).argmin(axis=1)
        counts = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(1, counts)[:, None], centres)
    return centres, _squares(vectors, centres).argmin(axis=1)


def grow(sample: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF) -> Tree:
    """Split nodes by k-means until they hold fewer than `leaf` vectors of the sample, or equal ones."""
    tree, random = Tree(), np.random.default_rng(SEED)

    def add(rows: np.ndarray) -> int:
        node = len(tree.children)
        tree.children.append(np.zeros(0, int))
        tree.centres.append(np.zeros((0, sample.shape[1])))
        tree.leaf.append(-1)
        if len(rows) >= leaf:
            centres, own = _k_means(sample[rows], branches, random)
            kept = np.unique(own)
            if len(kept) > 1:
                tree.centres[node] = centres[kept]
                tree.children[node] = np.array([add(rows[own == c]) for c in kept])
                return node
        tree.leaf[node] = tree.leaves
        tree.leaves += 1
        return node

    add(np.arange(len(sample)))
    return tree


def nearest(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """query_id, vec_id, score: the k vectors nearest to each query, but the one of its own id.

    Distances by the product formula choose, with room for its rounding; what they choose is
    measured on the differences of components. Ties go to the smaller id.
    """
    rows = []
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    scale = (vectors**2).sum(axis=1).max(initial=0)
    for start in range(0, len(queries), 256):
        block = queries[start : start + 256]
        squares = _squares(block, vectors)
        own = query_ids[start : start + 256]
        squares[ids[None, :] == own[:, None]] = np.inf
        take = min(k, len(ids))
        bound = np.partition(squares, take - 1, axis=1)[:, take - 1]
        slack = 1e-12 * (scale + (block**2).sum(axis=1)) + 1e-300
        for i, query in enumerate(block):
            near = np.flatnonzero(squares[i] <= bound[i] + 100 * slack[i])
            near = near[np.isfinite(squares[i][near])]
            exact = np.sqrt(((vectors[near] - query) ** 2).sum(axis=1))
            best = np.lexsort((ids[near], exact))[:k]
            rows.append((np.full(len(best), own[i]), ids[near[best]], exact[best]))
    columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0)] * 3
    return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], columns))).astype({"query_id": "int64", "vec_id": "int64"})


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of what the parts found for each query, with their rank."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _calibrate(tree: Tree, index: DataFrame, queries: pd.DataFrame, k: int, target: float) -> int:
    """How many leaves to visit so that the calibration queries find `target` of their exact neighbours.

    The exact neighbours come from a comparison with the whole index, each task giving its k
    best. The visits are widened leaf by leaf until the recall is reached.
    """
    wanted, wanted_ids = matrix(queries["embedding"]), queries["vec_id"].to_numpy()

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = nearest(wanted, wanted_ids, matrix(frame["embedding"]), frame["vec_id"].to_numpy(), k)
            leaf = dict(zip(frame["vec_id"], frame["leaf"]))
            yield found.assign(leaf=found["vec_id"].map(leaf))

    found = index.select("vec_id", "embedding", "leaf").mapInPandas(compare, "query_id long, vec_id long, score double, leaf int")
    exact = _best(found, k).toPandas()
    if not len(exact):
        return 1
    places = {i: {leaf: n for n, leaf in enumerate(tree.ordered_leaves(v, tree.leaves))} for i, v in zip(wanted_ids.tolist(), wanted)}
    visit = np.array([places[q][leaf] for q, leaf in zip(exact["query_id"], exact["leaf"])])
    visits = 1
    while np.mean(visit < visits) < target:
        visits += 1
    return visits


def search(
    spark: SparkSession,
    embeddings: DataFrame,
    is_query: Column,
    k: int = 10,
    recall: float = RECALL,
    sample: int = SAMPLE,
) -> DataFrame:
    """The k nearest rows to every query row of embeddings (vec_id, embedding) by Euclidean distance.

    The tree is fitted on about `sample` vectors; every vector is put in its leaf. A query
    opens branches best first until it has visited the number of leaves that calibration
    asked for, and more while these hold no k candidates. Queries meet the vectors of a leaf
    in parts of bounded size.

    Returns query_id, rank (from 1), vec_id, score; all candidates if there are fewer than k.
    Ties go to the smaller vec_id. Vectors that are null, zero or hold null or non-finite
    components and rows without a vec_id take no part. Vectors have a distance only to those
    of their length, so each length is searched by itself, with a tree of its own; a table
    has few lengths. Repeated rows of a vec_id are one candidate each; a query repeated is one
    query for each length of its vectors. An empty table has no result.
    """
    rows = embeddings.where(usable() & F.col("vec_id").isNotNull()).withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "is_query")
    lengths = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").collect()
    found = [_search(spark, rows.where(F.size("embedding") == r["dim"]), r["dim"], r["n"], k, recall, sample) for r in lengths]
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found) if found else nothing


def _search(spark: SparkSession, rows: DataFrame, dim: int, total: int, k: int, recall: float, sample: int) -> DataFrame:
    """The search among rows (vec_id, embedding, is_query) whose vectors are usable and of one length."""
    drawn = rows.where(share_of(sample, total, SEED, "vec_id")).orderBy("vec_id").select("embedding").toPandas()
    tree = grow(matrix(drawn["embedding"]).reshape(-1, dim))

    @F.pandas_udf("int")
    def leaf_of(vectors: pd.Series) -> pd.Series:
        return pd.Series(tree.place(matrix(vectors)).astype(np.int32)) if len(vectors) else pd.Series([], dtype="int32")

    index = stored(spark, rows.withColumn("leaf", leaf_of("embedding")), "leaves")
    sizes = {r["leaf"]: r["n"] for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    queries = index.where("is_query").select("vec_id", "embedding").dropDuplicates(["vec_id"])
    trial = queries.where(share_of(CALIBRATION, queries.count(), SEED + 1, "vec_id")).orderBy("vec_id").toPandas()
    visits = _calibrate(tree, index, trial, k, recall) if len(trial) else 1

    @F.pandas_udf("array<int>")
    def leaves_of(vectors: pd.Series) -> pd.Series:
        def chosen(vector) -> list[int]:
            query, wanted = np.array(vector, np.float64), visits
            while True:
                found = tree.ordered_leaves(query, wanted)
                if len(found) < wanted or sum(sizes.get(leaf, 0) for leaf in found) > k:
                    return found
                wanted *= 2

        return vectors.map(chosen)

    visited = stored(spark, queries.select(F.col("vec_id").alias("query_id"), "embedding", F.explode(leaves_of("embedding")).alias("leaf")), "visits")
    asked = {r["leaf"]: r["n"] for r in visited.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    # Two numbers for each leaf of a tree whose size depends on the sample alone.
    parts = spark.createDataFrame(
        [(leaf, -(-n // PART), -(-asked[leaf] // PART)) for leaf, n in sizes.items() if leaf in asked],
        "leaf int, parts int, query_parts int",
    )

    def spread(column: str, parts: str) -> Column:
        return F.pmod(seeded_hash(SEED, column), F.col(parts)).cast("int")

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    left = visited.join(F.broadcast(parts), "leaf").withColumn("query_part", spread("query_id", "query_parts")).withColumn("part", every("parts"))
    right = index.join(F.broadcast(parts), "leaf").withColumn("part", spread("vec_id", "parts")).withColumn("query_part", every("query_parts"))
    group = ["leaf", "part", "query_part"]

    def compare(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return nearest(matrix(queries["embedding"]), queries["query_id"].to_numpy(), matrix(vectors["embedding"]), vectors["vec_id"].to_numpy(), k)

    left = left.select("query_id", "embedding", *group).groupBy(*group)
    right = right.select("vec_id", "embedding", *group).groupBy(*group)
    found = left.cogroup(right).applyInPandas(compare, "query_id long, vec_id long, score double")
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
