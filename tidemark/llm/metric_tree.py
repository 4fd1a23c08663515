"""Exact top-k by inner product, with best-first search in M-trees.

Vectors of whole numbers are dealt into chunks by a hash of their id; each chunk becomes
one M-tree of paged nodes, written to the shared folder. The queries are cut into blocks,
each block meets each tree once, and the best of all trees are ranked together.

An inner product is turned into a distance by one more component: with M the largest
norm of a tree, x is given sqrt(M^2 - |x|^2) and q is given 0, so that
d(q, x)^2 = |q|^2 + M^2 - 2 <q, x>. Nodes are visited by the least distance their covering
radius allows. Before a distance is computed the stored distance to the parent bounds it
by the triangle inequality; what cannot come into the k best is left out. Bounds are
floating point with a margin on the safe side; scores are exact integers.

Rules for odd rows
    * Vectors that are null, empty or hold a null or non-finite component, and rows with a
      null id, take no part. Large components are multiplied as Python's integers; a score that
      a long cannot hold is given as the nearest one that it can.
    * Vectors of different lengths are compared as if zeros followed the shorter one.
    * A row with the query's id is not its candidate. An id that repeats among the queries
      is asked once, with its smallest vector; repeated candidates are found each.
    * Ties go to the smaller id. Empty tables give empty results; extra columns take no part.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import stored

LEAF, FANOUT = 64, 16
# Sums of products below it are exact in 64 bits; beyond it Python's integers are used.
LARGEST = 1 << 60


def squares(rows: np.ndarray) -> np.ndarray:
    """The sum of squares of each row, to the precision of distances."""
    if rows.dtype == object:
        rows = rows.astype(np.float64)
    return np.einsum("ij,ij->i", rows, rows).astype(np.float64)


@dataclass
class Node:
    """A page: a routing object with its covering radius, and children or rows below it.

    ``to_parent`` has the distance of each child's routing object, or of each row, to this
    node's own routing object.
    """

    centre: int
    radius: float
    to_parent: np.ndarray
    children: list[Node] | None
    rows: np.ndarray


@dataclass
class MTree:
    ids: np.ndarray
    vectors: np.ndarray
    extra: np.ndarray
    top: float
    root: Node | None

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> MTree:
        norms = squares(vectors)
        top = float(norms.max()) if len(ids) else 0.0
        tree = cls(ids, vectors, np.sqrt(top - norms), top, None)
        if len(ids):
            tree.root = tree._page(np.arange(len(ids)), 0, np.random.default_rng(len(ids)))
        return tree

    def _distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        apart = self.vectors[rows] - self.vectors[centre]
        return np.sqrt(squares(apart) + (self.extra[rows] - self.extra[centre]) ** 2)

    def _page(self, rows: np.ndarray, centre: int, rng: np.random.Generator) -> Node:
        far = self._distances(rows, centre)
        if len(rows) <= LEAF:
            return Node(centre, float(far.max()), far, None, rows)
        pivots = rng.choice(rows, FANOUT, replace=False)
        nearest = np.argmin(np.stack([self._distances(rows, p) for p in pivots]), axis=0)
        if np.bincount(nearest, minlength=FANOUT).max() > 0.9 * len(rows):
            # Copies of one vector: no pivot parts them, so they are paged as they come.
            nearest = np.arange(len(rows)) * FANOUT // len(rows)
            pivots = rows[np.searchsorted(nearest, np.arange(FANOUT))]
        children = [self._page(rows[nearest == k], int(p), rng) for k, p in enumerate(pivots) if (nearest == k).any()]
        centres = np.array([c.centre for c in children])
        return Node(centre, float(far.max()), self._distances(centres, centre), children, rows[:0])

    def search(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best, best first; ties to the smaller id."""
        if self.root is None:
            return []
        width = min(len(query), self.vectors.shape[1])
        query = query[:width]
        vectors = self.vectors[:, :width]
        square = float(query @ query) + self.top
        margin = 1e-9 * square + 1e-6

        def distance(score) -> np.ndarray:
            return np.sqrt(np.maximum(square - 2.0 * np.asarray(score, dtype=np.float64), 0.0))

        best: list[tuple[int, int]] = []  # heap of (score, -id): the worst on top
        reach = math.inf
        start = float(distance(vectors[self.root.centre] @ query))
        queue: list[tuple[float, int, float, Node]] = [(max(0.0, start - self.root.radius), 0, start, self.root)]
        order = 1
        while queue:
            least, _, own, node = heapq.heappop(queue)
            if least > reach:
                break
            able = np.abs(own - node.to_parent)
            if node.children is None:
                rows = node.rows[able <= reach]
                scores = vectors[rows] @ query
                if len(best) == k:
                    near = (scores >= best[0][0]).astype(bool)
                    rows, scores = rows[near], scores[near]
                for score, vec_id in zip(scores.tolist(), self.ids[rows].tolist(), strict=True):
                    if vec_id == query_id:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -vec_id))
                    elif (score, -vec_id) > best[0]:
                        heapq.heapreplace(best, (score, -vec_id))
                if len(best) == k:
                    # Where the square is small its root is least exact: the margin goes inside.
                    reach = math.sqrt(max(square - 2.0 * best[0][0], 0.0) + margin) + 1e-6
                continue
            radii = np.array([c.radius for c in node.children])
            open_ = np.flatnonzero(able - radii <= reach)
            centres = np.array([node.children[i].centre for i in open_], dtype=np.int64)
            for i, far in zip(open_.tolist(), distance(vectors[centres] @ query).tolist(), strict=True):
                child = node.children[i]
                if far - child.radius <= reach:
                    heapq.heappush(queue, (max(0.0, far - child.radius), order, far, child))
                    order += 1
        return [(score, -vec_id) for score, vec_id in sorted(best, reverse=True)]


def scaled(vector: Column, factor: float) -> Column:
    """floor(factor * x) of each component; null for vectors that take no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.when((F.size(vector) > 0) & usable, F.transform(vector, lambda x: F.floor(F.lit(factor) * x.cast("double"))))


def _matrix(vectors: pd.Series) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    if out.size and width * max(abs(int(out.max())), abs(int(out.min()))) ** 2 >= LARGEST:
        return out.astype(object)
    return out


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    factor: float = 1024.0,
    chunk_rows: int = 16_384,
    block_rows: int = 256,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds its k best others."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), scaled(F.col(embedding), factor).alias("v"), queries.alias("asks")
    ).where("v IS NOT NULL AND vec_id IS NOT NULL")
    chunks = math.ceil(rows.count() / chunk_rows) or 1
    asked = rows.where("asks").groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = math.ceil(asked.count() / block_rows) or 1

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id", kind="stable")
        tree = MTree.build(group["vec_id"].to_numpy(), _matrix(group["v"]))
        return pd.DataFrame({"chunk": [key[0]], "tree": [pickle.dumps(tree)]})

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {"block": [key[0]], "queries": [pickle.dumps((group["vec_id"].to_numpy(), _matrix(group["v"])))]}
        )

    trees = stored(
        rows.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)))
        .groupBy("chunk")
        .applyInPandas(grow, "chunk long, tree binary"),
        "metric-trees",
    )
    packed = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))).groupBy("block").applyInPandas(
        pack, "block long, queries binary"
    )
    # The stated queries against all rows, in blocks: each block meets each tree.
    meetings = packed.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree_bytes, query_bytes in zip(batch["tree"], batch["queries"], strict=True):
                tree = pickle.loads(tree_bytes)
                # A score that a long cannot hold is the nearest one that it can.
                out = [
                    (query_id, found, max(-(2**63), min(2**63 - 1, score)))
                    for query_id, query in zip(*pickle.loads(query_bytes), strict=True)
                    for score, found in tree.search(int(query_id), query, k)
                ]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    found = (
        meetings.join(trees, "chunk")
        .repartition("chunk", "block")
        .select("tree", "queries")
        .mapInPandas(search, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
