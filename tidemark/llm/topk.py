"""Exact top-k inner products by a dual-tree search over cover trees.

Queries in blocks and rows in cells, both of bounded size, meet in cogroups; each builds a cover tree of
either side and walks the two together. For nodes with centres q, x and covering radii r, s no product
between them exceeds <q, x> + r|x| + s|q| + rs; a pair of nodes is left out when that is below the worst
kth score of the query group. Every query brings along a kth score that a bounded sample of rows already
reaches, so pruning works from the first cell on; the sample changes speed, not results.

Vectors that are null or hold null or non-finite components take no part, nor do rows with a null id.
Equal rows count once, and a row with the query's id is never its result. Vectors of different length
have no score. Ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

CELL = 2048
BLOCK = 4096
LEAF = 32
EXACT = float(1 << 52)


class Node:
    """A node of a cover tree: all its points are within ``radius`` of its centre.

    ``loose`` are points that no child has; children cover half the distance their parent may.
    """

    __slots__ = ("centre", "length", "radius", "loose", "children", "points")

    def __init__(self, centre: np.ndarray, radius: float, points: np.ndarray):
        self.centre, self.radius, self.points = centre, radius, points
        self.length = float(np.linalg.norm(centre))
        self.loose, self.children = points, []


def cover_tree(x: np.ndarray, points: np.ndarray) -> Node:
    """The tree over rows ``points`` of x, around the first of them."""
    far = np.linalg.norm(x[points] - x[points[0]], axis=1)
    root = Node(x[points[0]], float(far.max()), points)
    todo = [(root, points[0])]
    while todo:
        node, at = todo.pop()
        if len(node.points) <= LEAF or node.radius == 0:
            continue
        half, left, loose = node.radius / 2, node.points, []
        centre = at
        while len(left):
            away = np.linalg.norm(x[left] - x[centre], axis=1)
            within = away <= half
            some = left[within]
            if len(some) > LEAF // 4:
                child = Node(x[centre], float(away[within].max()), some)
                node.children.append(child)
                todo.append((child, centre))
            else:
                loose.append(some)
            left = left[~within]
            if len(left):
                centre = left[0]
        node.loose = np.concatenate(loose) if loose else node.points[:0]
    return root


class Search:
    """Best k rows of x for each query; ``floors`` are scores that k rows are known to reach."""

    def __init__(self, queries, query_ids, x, ids, floors, k: int):
        self.q, self.x = queries.astype(np.float64), x.astype(np.float64)
        self.exact_q, self.exact_x = queries, x
        self.query_ids, self.ids, self.k = query_ids, ids, k
        self.worst = floors.astype(np.float64)
        self.floors = floors
        self.best: list[list[tuple[int, int]]] = [[] for _ in query_ids]
        size = np.abs(self.q).sum(axis=1).max(initial=0) * np.abs(self.x).max(initial=0)
        self.in_doubles = size < EXACT

    def run(self) -> None:
        if len(self.q) and len(self.x):
            self.walk(cover_tree(self.q, np.arange(len(self.q))), [cover_tree(self.x, np.arange(len(self.x)))])

    def walk(self, node: Node, others: list[Node]) -> None:
        """Queries of a node against nodes of rows, the most promising first."""
        if not others:
            return
        centres = np.array([o.centre for o in others])
        radii = np.array([o.radius for o in others])
        lengths = np.array([o.length for o in others])
        bounds = centres @ node.centre + node.radius * lengths + radii * node.length + node.radius * radii
        bounds += 1e-9 * np.abs(bounds) + 1e-6
        for i in np.argsort(-bounds, kind="stable"):
            if bounds[i] < self.worst[node.points].min():
                break
            other = others[i]
            if node.children and node.radius >= other.radius:
                for child in node.children:
                    self.walk(child, [other])
                self.meet(node, node.loose, other)
            else:
                self.score(node.points, other.loose)
                self.walk(node, other.children)

    def meet(self, node: Node, queries: np.ndarray, other: Node) -> None:
        """Queries that no child holds, against all of a node of rows."""
        if len(queries):
            alone = Node(node.centre, node.radius, queries)
            self.score(queries, other.loose)
            self.walk(alone, other.children)

    def score(self, queries: np.ndarray, rows: np.ndarray) -> None:
        if not len(queries) or not len(rows):
            return
        if self.in_doubles:
            found = (self.q[queries] @ self.x[rows].T).astype(np.int64)
        else:
            found = self.exact_q[queries] @ self.exact_x[rows].T
        ids = self.ids[rows]
        over = (found >= self.worst[queries][:, None]) & (ids != self.query_ids[queries][:, None])
        for i in np.flatnonzero(over.any(axis=1)):
            at, keep = queries[i], over[i]
            best = self.best[at]
            best.extend(zip((-found[i][keep]).tolist(), ids[keep].tolist(), strict=True))
            best.sort()
            del best[self.k :]
            if len(best) == self.k:
                self.worst[at] = max(self.worst[at], -best[-1][0])


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if column.num_chunks else pa.array([], pa.int64())
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim) if dim else np.zeros((len(column), 0), np.int64)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, dim, v): floor(scale * x) of every vector that takes part."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(math.inf)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x"), F.coalesce(fine, F.lit(False)).alias("fine"))
    rows = rows.where("fine and id is not null")
    return rows.select("id", F.size("x").alias("dim"), F.transform("x", lambda e: F.floor(e * scale).cast("long")).alias("v")).distinct()


def top_k(
    vectors: DataFrame,
    every: int = 50,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cell: int = CELL,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, a row whose id is divisible by ``every``."""
    rows = cut(quantised(vectors, id_col, vector_col))
    asked = F.pmod("id", F.lit(every)) == 0
    total, queries = rows.agg(F.count("*"), F.count_if(asked)).first()
    cells, blocks = max(1, math.ceil(total / cell)), max(1, math.ceil(queries / block))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(cell).collect()

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims, vs = (c.to_pylist() for c in b.columns)
            floors = []
            for i, dim, v in zip(ids, dims, vs, strict=True):
                known, x = of.get(dim, ([], np.zeros((0, dim), np.int64)))
                scores = np.sort((x @ np.array(v, dtype=np.int64))[np.array(known, dtype=np.int64) != i])
                floors.append(int(scores[-k]) if len(scores) >= k else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(floors, pa.int64())], ["id", "dim", "v", "floor"])

    of: dict[int, tuple[list[int], np.ndarray]] = {}
    for dim in {r.dim for r in sample}:
        same = [r for r in sample if r.dim == dim]
        of[dim] = ([r.id for r in same], np.array([r.v for r in same], dtype=np.int64).reshape(len(same), dim))

    floored = rows.where(asked).mapInArrow(begin, "id long, dim int, v array<long>, floor long")
    left = floored.select(
        "id", "dim", "v", "floor", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell")
    )
    right = rows.select(
        "id", "dim", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("block"), F.pmod(F.xxhash64("id"), F.lit(cells)).cast("int").alias("cell")
    )

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows and b.num_rows:
            dim = a.column("dim")[0].as_py()
            floors = a.column("floor").fill_null(np.iinfo(np.int64).min).to_numpy()
            ids = a.column("id").to_numpy()
            s = Search(matrix(a.column("v"), dim), ids, matrix(b.column("v"), dim), b.column("id").to_numpy(), floors, k)
            s.run()
            found = [(int(q), n, -score) for q, best in zip(ids, s.best, strict=True) for score, n in best]
        else:
            found = []
        return pa.table({name: pa.array([f[i] for f in found], pa.int64()) for i, name in enumerate(("query_id", "vec_id", "score"))})

    keys = ["dim", "block", "cell"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""
