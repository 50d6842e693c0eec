"""Near-duplicate embeddings by an exact metric range join."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import components, local_components, seeded_hash, stored
from clickmill.llm.embeddings import matrix, unit, usable

LEAST = 0.93
CELL = 4096  # vectors that a cell should hold
PIVOTS = 64  # into which a cell is split at once, at most
PART = 2048  # vectors of one side of a comparison, or that meet the pivots of their cell in one task
BROADCAST_ROWS = 100_000  # large cells whose sizes are sent to every task
SEED = 2
SLACK = 1e-9  # by which bounds are widened for rounding
AT = ["label", "dim", "cell"]
ROW = "label int, dim int, cell long, member boolean, rep long, n long, embedding array<double>"


def _cells(vectors: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """For each unit vector its cell, that of the nearest pivot, and all cells it must be compared in.

    A vector x within `radius` of one in the cell of pivot j lies, by the triangle inequality,
    at most that far beyond the plane halfway between j and its nearest pivot i:
    (|x - j|^2 - |x - i|^2) / (2 |i - j|) <= radius.
    """
    square = np.maximum(0, 2 - 2 * vectors @ pivots.T)
    home = square.argmin(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))[home]
    reach = square - square[np.arange(len(vectors)), home][:, None] <= 2 * apart * radius + SLACK
    reach[np.arange(len(vectors)), home] = True
    return home, reach


def _cosines(vectors: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The cosine of each pair of rows, a bounded number at a time."""
    norm = np.linalg.norm(vectors, axis=1)
    cuts = 1 + len(left) // 65_536
    pairs = zip(np.array_split(left, cuts), np.array_split(right, cuts))
    return np.concatenate([np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norm[a] * norm[b]) for a, b in pairs])


def _large(rows: DataFrame) -> DataFrame:
    """Cells of more than PART rows with the number of rows and of members. There are at most rows / PART of them."""
    sizes = rows.groupBy(*AT).agg(F.count("*").alias("rows"), F.count_if("member").alias("members"))
    large = sizes.where(F.col("rows") > PART)
    return F.broadcast(large) if large.count() <= BROADCAST_ROWS else large


def _spread(parts: Column) -> Column:
    return F.pmod(seeded_hash(SEED, "rep"), parts).cast("int")


def _split(rows: DataFrame, large: DataFrame, radius: float) -> DataFrame:
    """Split the cells of rows by pivots, which are members of theirs, two or one for each CELL members.

    A member becomes one of the cell of its nearest pivot, and every row also a guest of all
    cells whose members may be near enough. Large cells meet their pivots in pieces.
    """
    order = Window.partitionBy(*AT).orderBy(F.xxhash64("embedding", F.lit(SEED)), "rep")
    drawn = rows.where("member").select(*AT, "embedding", F.row_number().over(order).alias("rank")).where(F.col("rank") <= PIVOTS)
    pieces = F.coalesce(F.ceil(F.col("rows") / PART), F.lit(1)).cast("int")
    wanted = F.greatest(F.lit(2), F.coalesce(F.floor(F.col("members") / CELL), F.lit(0)))
    pivots = drawn.join(large, AT, "left").where(F.col("rank") <= wanted)
    pivots = pivots.select(*[F.col(c).alias(f"of_{c}") for c in AT], "rank", F.col("embedding").alias("pivot"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("of_piece"))
    dealt = rows.join(large, AT, "left").select(*rows.columns, _spread(pieces).alias("piece"))
    names = [part.split()[0] for part in ROW.split(", ")]

    def meet(vectors: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(pivots):  # no members, so nothing to be compared with
            return vectors[names].iloc[:0]
        centres = unit(matrix(pivots.sort_values("rank")["pivot"]))
        home, reach = _cells(unit(matrix(vectors["embedding"])), centres, radius)
        which, child = np.nonzero(reach)
        out = vectors[names].iloc[which]
        return out.assign(cell=out["cell"].to_numpy() * PIVOTS + child, member=out["member"].to_numpy() & (home[which] == child))

    by = [*AT, "piece"]
    return dealt.groupBy(*by).cogroup(pivots.groupBy(*[f"of_{c}" for c in by])).applyInPandas(meet, ROW)


def cells(spark: SparkSession, classes: DataFrame, radius: float) -> DataFrame:
    """label, dim, cell, member, rep, n and embedding: every vector as a member of one cell and as a guest of others.

    Any two vectors of a label and length within `radius` meet in the cell of either. Each
    label has pivots of its own, from two vectors on; cells that remain large are split by
    pivots of theirs, in as many rounds as the largest label needs for cells of about CELL
    members.
    """
    rows = classes.select(
        "label", F.size("embedding").alias("dim"), F.lit(0).cast("long").alias("cell"), F.lit(True).alias("member"), "rep", "n", "embedding"
    )
    most = rows.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    rounds = max(1, math.ceil(math.log(max(1, most / CELL), PIVOTS)))
    rows = stored(spark, _split(rows, _large(rows), radius), "cells")
    for _ in range(1, rounds):
        large = _large(rows)
        again = large.where(F.col("members") > CELL).select(*AT)
        split = _split(rows.join(again, AT, "left_semi"), large, radius)
        # Numbers of cells that are not split stay apart from those of others.
        whole = rows.join(again, AT, "left_anti").withColumn("cell", F.col("cell") * PIVOTS)
        rows = stored(spark, split.unionByName(whole), "cells")
    return rows


def join(spark: SparkSession, classes: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Links between different vectors of classes (rep, label, embedding, n), all usable.

    Returns rep and links, the number of rows linked to the class from outside, and star
    links (a, b) that connect the components. Cells join independently, members against
    members and guests. Large cells are cut in parts, each pair of parts a group, so a task
    holds two parts at a time.
    """
    rows = cells(spark, classes, math.sqrt(max(0, 2 - 2 * least)))
    parts = [F.greatest(F.lit(1), F.coalesce(F.ceil(F.col(c) / PART), F.lit(1))).cast("int") for c in ("members", "rows")]
    dealt = rows.join(_large(rows), AT, "left").select(*rows.columns, *[p.alias(c) for p, c in zip(parts, ("is", "js"))])
    own_row, own_column = _spread(F.col("is")), _spread(F.col("js"))
    places = F.array_union(
        F.when(F.col("member"), F.transform(F.sequence(F.lit(0), F.col("js") - 1), lambda j: F.struct(own_row.alias("i"), j.alias("j"))))
        .otherwise(F.array().cast("array<struct<i: int, j: int>>")),
        F.transform(F.sequence(F.lit(0), F.col("is") - 1), lambda i: F.struct(i.alias("i"), own_column.alias("j"))),
    )
    dealt = dealt.withColumn("own_row", own_row).withColumn("own_column", own_column).withColumn("at", F.explode(places)).select(
        *AT, "at.*", (F.col("member") & (F.col("own_row") == F.col("at.i"))).alias("member"),
        (F.col("own_column") == F.col("at.j")).alias("visitor"), "rep", "n", "embedding",
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        if not frame["member"].any() or len(frame) < 2:
            return pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
        exact = matrix(frame["embedding"])
        exact /= np.abs(exact).max(axis=1, keepdims=True)
        vectors = unit(exact)
        rows, columns = np.flatnonzero(frame["member"]), np.flatnonzero(frame["visitor"])
        left, right = np.nonzero(vectors[rows] @ vectors[columns].T >= least - SLACK)
        left, right = rows[left], columns[right]
        # The same class may stand here as member and as visitor.
        apart = left != right
        left, right = left[apart], right[apart]
        near = _cosines(exact, left, right) >= least
        left, right = left[near], right[near]
        rep, n = frame["rep"].to_numpy(), frame["n"].to_numpy()
        links = np.bincount(left, n[right], len(frame)).astype(np.int64)
        root = local_components(len(frame), left, right)
        found = np.flatnonzero((links > 0) | (root != np.arange(len(frame))))
        return pd.DataFrame({"rep": rep[found], "links": links[found], "root": rep[root[found]]})

    found = dealt.groupBy(*AT, "i", "j").applyInPandas(compare, "rep long, links long, root long")
    found = stored(spark, found, "found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    return links, found.select(F.col("rep").alias("a"), F.col("root").alias("b"))


def near_duplicates(spark: SparkSession, embeddings: DataFrame, least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of embeddings (vec_id, embedding, label).

    Rows link if their labels are equal and not null and the cosine of their vectors is at
    least `least`, in double precision. n_links counts the other rows linked directly, copies
    included; component_id is the smallest vec_id reachable; kept says whether that is the
    row's own. Equal vectors of a label are one class and are compared once. Vectors that are
    null, zero or hold null or non-finite components, and rows without a label or vec_id, link
    with nothing; vectors of different lengths do not link. vec_id names a vector: rows that
    share one are copies where their vectors are equal.
    """
    rows = embeddings.select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("usable", usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    classes = rows.where("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    classes = stored(spark, classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    links, edges = join(spark, classes, least)
    roots = components(spark, edges).select(F.col("node").alias("rep"), "root")
    placed = classes.join(links, "rep", "left").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component"))
    classes = placed.join(smallest, "root")
    classes = classes.select(
        F.col("label").alias("of_label"), F.col("embedding").alias("of_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.col("component").alias("component_id"),
    )
    same = F.col("usable") & (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of_vector"))
    # Only rows of classes that link need be told so.
    joined = rows.join(classes.where("n_links > 0"), same, "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
