"""Exact top-k inner-product search by dual-tree traversal of cover trees.

Vectors (integer components) are dealt into blocks by id, and a cover tree is
built over each block: a node has a centre, the radius that covers all its
vectors, and children whose centres are more than the child scale apart. The
queries get trees of the same kind. A pair of nodes (queries around p within
s, data around c within r) can score at most p.c + |p| r + |c| s + r s; the
pair is passed over when that is under the worst k-th score that the node's
queries have so far. What is left at the leaves is scored exactly.

Each query block meets one data block first; the k-th scores found there are
the floors with which the pair of every other block starts. A task holds two
blocks, whatever the size of the tables.

Equal vectors of a block are one point with its k + 1 smallest ids (no others
can be among the k best). Scores are exact: float64 while every product stays
below 2**53, whole Python integers beyond.

Defined results: vectors that are null, empty or hold null or non-finite
components take no part, nor do rows without an id; only vectors of the
query's dimension are candidates; ties go to the smaller id; a query with
fewer than k candidates gets all of them; repeated rows of one id and vector
count once; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplog.llm.common import freeze

K = 10
SCALE = 1024
BLOCK = 4096
QUERY_BLOCK = 1024
LEAF = 48
WIDE = 40
STEPS = (2.0, 1.6, 1.3, 1.15, 1.06)


class Tree:
    """Points in tree order; node i covers points[lo[i]:hi[i]], its centre is
    points[centre[i]], its children are nodes kids[i] (none: a leaf)."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.lo: list[int] = []
        self.hi: list[int] = []
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.kids: list[list[int]] = []
        self.order = np.arange(len(points))
        if len(points):
            self._build(0, len(points), self._far(0, len(points), points.mean(axis=0))[1])
        self.points = points[self.order]
        self.norm = np.sqrt((self.points**2).sum(axis=1))
        at = np.empty(len(points), dtype=np.int64)
        at[self.order] = np.arange(len(points))
        self.centre = [int(at[c]) for c in self.centre]

    def _far(self, lo: int, hi: int, p: np.ndarray) -> tuple[np.ndarray, int]:
        d = np.sqrt(((self.points[self.order[lo:hi]] - p) ** 2).sum(axis=1))
        return d, int(self.order[lo + int(d.argmin())])

    def _build(self, lo: int, hi: int, centre: int) -> int:
        d, _ = self._far(lo, hi, self.points[centre])
        node = len(self.lo)
        radius = float(d.max()) * (1 + 1e-12) if hi > lo else 0.0
        self.lo.append(lo)
        self.hi.append(hi)
        self.centre.append(centre)
        self.radius.append(radius)
        self.kids.append([])
        if hi - lo <= LEAF or radius == 0:
            return node
        for step in STEPS:  # the smallest child scale that is not too bushy
            net = self._net(lo, hi, centre, d, radius / step)
            if net is not None:
                break
        else:
            return node
        centres, group = net
        self.order[lo:hi] = self.order[lo:hi][np.argsort(group, kind="stable")]
        sizes = np.bincount(group, minlength=len(centres))
        at = lo
        for c, n in zip(centres, sizes.tolist(), strict=True):
            self.kids[node].append(self._build(at, at + n, c))
            at += n
        return node

    def _net(self, lo: int, hi: int, centre: int, d: np.ndarray, scale: float):
        """Centres more than ``scale`` apart, and each point's first centre
        within it; None if there are more than WIDE, or one holds all."""
        own = self.order[lo:hi]
        group = np.full(hi - lo, -1)
        group[d <= scale] = 0
        centres = [centre]
        while (group < 0).any():
            if len(centres) >= WIDE:
                return None
            c = int(own[int((group < 0).argmax())])
            e = np.sqrt(((self.points[own] - self.points[c]) ** 2).sum(axis=1))
            group[(group < 0) & (e <= scale)] = len(centres)
            centres.append(c)
        return (centres, group) if len(centres) > 1 else None


def _matrix(table: pa.Table, ids: str, vectors: str) -> tuple[np.ndarray, np.ndarray]:
    v = table.column(vectors).combine_chunks()
    flat = v.flatten().to_numpy(zero_copy_only=False)
    return table.column(ids).to_numpy(), flat.reshape(len(v), -1)


def search(data_ids: np.ndarray, data: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int = K) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of each query's k best within the block, less
    those that score under the query's floor."""
    points, group = np.unique(data, axis=0, return_inverse=True)
    by = np.lexsort((data_ids, group.ravel()))
    starts = np.searchsorted(group.ravel()[by], np.arange(len(points) + 1))
    tree, asked = Tree(points), Tree(queries)
    floors, query_ids = floors[asked.order].astype(float), query_ids[asked.order]
    exact = float(tree.norm.max(initial=0)) * float(asked.norm.max(initial=0)) < 2**53
    slack = 1e-9 * (1 + float(tree.norm.max(initial=0)) * float(asked.norm.max(initial=0)))
    best: list[list[tuple]] = [[] for _ in range(len(queries))]  # (-score, id), sorted
    worst = np.where(np.isfinite(floors), floors, -np.inf)

    def base(q: int, t: int) -> None:
        a, b, lo, hi = asked.lo[q], asked.hi[q], tree.lo[t], tree.hi[t]
        scores = asked.points[a:b] @ tree.points[lo:hi].T
        for i in range(a, b):
            row = scores[i - a]
            near = np.flatnonzero(row >= worst[i] - slack)
            if not len(near):
                continue
            if len(near) > k:  # equal scores stay together
                cut = np.partition(row[near], len(near) - k - 1)[len(near) - k - 1]
                near = near[row[near] >= cut - slack]
            found = best[i]
            for j in near.tolist():
                p = int(tree.order[lo + j])
                s = int(row[j]) if exact else sum(int(x) * int(y) for x, y in zip(asked.points[i].tolist(), tree.points[lo + j].tolist(), strict=True))
                own = data_ids[by[starts[p] : min(starts[p + 1], starts[p] + k + 1)]].tolist()
                found += [(-s, v) for v in dict.fromkeys(own) if v != query_ids[i]]
            found.sort()
            del found[k:]
            if len(found) == k:
                worst[i] = max(worst[i], float(-found[-1][0]))

    def bound(q: list[int], t: list[int]) -> np.ndarray:
        qc, tc = [asked.centre[x] for x in q], [tree.centre[x] for x in t]
        s, r = np.array([asked.radius[x] for x in q]), np.array([tree.radius[x] for x in t])
        return asked.points[qc] @ tree.points[tc].T + np.outer(asked.norm[qc], r) + np.outer(s, tree.norm[tc]) + np.outer(s, r) + slack

    stack = [(np.inf, 0, 0)] if len(points) and len(queries) else []
    while stack:
        top, q, t = stack.pop()
        if top < worst[asked.lo[q] : asked.hi[q]].min() - slack:
            continue
        if not asked.kids[q] and not tree.kids[t]:
            base(q, t)
            continue
        # a query node that is small against the data node waits
        down_q = asked.kids[q] if asked.kids[q] and (not tree.kids[t] or asked.radius[q] >= tree.radius[t]) else [q]
        down_t = tree.kids[t] or [t]
        if down_q == [q] and not tree.kids[t]:
            down_q = asked.kids[q]
        b = bound(down_q, down_t)
        for i in np.argsort(b, axis=None, kind="stable").tolist():  # best on top
            x, y = divmod(i, len(down_t))
            stack.append((b[x, y], down_q[x], down_t[y]))
    return [(int(query_ids[i]), int(v), -s) for i, found in enumerate(best) for s, v in found if -s >= floors[i]]


def _pair(k: int):
    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if queries.num_rows and data.num_rows:
            qi, qv = _matrix(queries, "query_id", "q")
            di, dv = _matrix(data, "vec_id", "v")
            rows = search(di, dv, qi, qv, queries.column("floor").to_numpy(), k)
        cols = list(zip(*rows, strict=True)) or [[], [], []]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

    return run


def scaled(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components floor(scale * x) of the usable vectors."""
    own = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"))
    fine = F.col("e").isNotNull() & (F.size("e") > 0)
    each = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    grown = F.transform("e", lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    return own.where(F.col("vec_id").isNotNull() & fine & each).select("vec_id", grown.alias("v")).withColumn("dim", F.size("v"))


def top_k(vectors: DataFrame, is_query, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best other vectors.

    ``is_query`` makes a condition from the id column.
    """
    rows = freeze(scaled(vectors, vec_id, embedding, scale), "vectors")
    asked = rows.where(is_query(F.col("vec_id")))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(is_query(F.col("vec_id")).cast("long")).alias("q")).first()
    n_data, n_query = max(1, -(-sizes["n"] // block)), max(1, -(-(sizes["q"] or 0) // query_block))
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    data = rows.withColumn("t", deal(n_data, 1))
    query = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "dim", deal(n_query, 2).alias("g"))
    query = query.dropDuplicates(["query_id"])
    schema = "query_id long, vec_id long, score long"
    # each query block with one data block
    first = query.withColumn("t", F.pmod("g", F.lit(n_data))).withColumn("floor", F.lit(float("-inf")))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_query - 1)))
    paired = data.select("vec_id", "v", "dim", "t", blocks.alias("g"))
    seeds = paired.where(F.pmod("g", F.lit(n_data)) == F.col("t"))
    key = ["dim", "g", "t"]

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # own column ids
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_pair(k), schema)

    found = freeze(meet(first, seeds), "seeds")
    if n_data > 1:
        floors = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("s"))
        floors = floors.select("query_id", F.when(F.col("n") >= k, F.col("s")).alias("s"))
        rest = query.join(floors, "query_id", "left").withColumn("floor", F.coalesce("s", F.lit(float("-inf")))).drop("s")
        rest = rest.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_data - 1))).alias("t")).where(F.pmod("g", F.lit(n_data)) != F.col("t"))
        others = paired.where(F.pmod("g", F.lit(n_data)) != F.col("t"))
        found = found.union(meet(rest, others))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.e) = len(d.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= {K}
"""
