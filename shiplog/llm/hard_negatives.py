"""Hard negatives by a vertical scan with shrinking candidate sets (BOND).

Rows are dealt into blocks of one label, held by column: one array per
dimension, with its least and greatest value. For an anchor the dimensions are
read in descending magnitude of its own components. After every ``STEP`` of
them a candidate's score lies between what it has gathered plus the least and
plus the most that the dimensions left can add, which follows from the block's
minima and maxima. Candidates that cannot count any more leave the bitmap:

* looking for positives (the anchor's label): those whose most is under the
  k-th least of all;
* looking for negatives (other labels): those that no positive's window can
  hold, or that ``WANTED`` rows surely inside the window surely beat.

What is left when all dimensions are read has exact scores.

An anchor visits all blocks of its label, then, with the scores of its
positives, the blocks of other labels whose minima and maxima allow a score in
some window. Blocks hold about ``BLOCK`` rows whatever the label's size, and the
anchors that visit a block stream by, in slices of about ``ASKED``; so a label
with most of the rows is many tasks and no group is held but one block.

Scores are integers: exact in float64 while the norms' product stays below
2**53, in whole Python integers beyond (results are held within 64 bits).

Defined results: rows without an id or a label, and vectors that are null,
empty or hold null or non-finite components take no part; vectors meet vectors
of their dimension; of rows with one id the one with the smallest label, then
vector, takes part; ties go to the smaller id; an anchor without positives, or
a positive without negatives in its window, has no rows; other columns play no
part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplog.llm.common import freeze

SCALE = 256
POSITIVES = 5
WANTED = 3
#: A negative's score is LOW to HIGH hundredths of the positive's.
LOW, HIGH = 50, 95
STEP = 8
BLOCK = 1 << 16
ASKED = 1 << 16
_LONG = 2**63 - 1


class Block:
    """Vectors of one label by column, ids ascending."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.columns = np.ascontiguousarray(vectors.T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.norm = float(np.sqrt((vectors**2).sum(axis=1).max()))

    def _scan(self, anchor: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, scores) of the rows that ``keep(least, most)`` leaves
        after every ``STEP`` dimensions."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        x, y = anchor * self.low, anchor * self.high
        least, most = np.minimum(x, y)[order], np.maximum(x, y)[order]
        # what the dimensions from the i-th on can add
        least = np.concatenate([np.cumsum(least[::-1])[::-1], [0.0]])
        most = np.concatenate([np.cumsum(most[::-1])[::-1], [0.0]])
        rows: np.ndarray | None = None  # all
        score = np.zeros(len(self.ids))
        for i in range(0, len(order), STEP):
            for d in order[i : i + STEP].tolist():
                score += anchor[d] * (self.columns[d] if rows is None else self.columns[d][rows])
            done = min(i + STEP, len(order))
            alive = keep(score + least[done], score + most[done])
            if not alive.all():
                rows, score = np.flatnonzero(alive) if rows is None else rows[alive], score[alive]
            if not len(score):
                break
        return np.arange(len(self.ids)) if rows is None else rows, score

    def scan(self, anchor: np.ndarray, keep) -> tuple[np.ndarray, list[int]]:
        """As ``_scan``, with exact integer scores."""
        norm = float(np.sqrt((anchor**2).sum()))
        if self.norm * norm < 2**53:
            rows, score = self._scan(anchor, keep)
            return rows, score.astype(np.int64).tolist()
        own = [int(a) for a in anchor.tolist()]
        each = (sum(a * int(c) for a, c in zip(own, v, strict=True)) for v in self.columns.T.tolist())
        return np.arange(len(self.ids)), [max(-_LONG, min(_LONG, s)) for s in each]


def positives_in(block: Block, anchor_id: int, anchor: np.ndarray, k: int = POSITIVES) -> list[tuple[int, int]]:
    """(id, score) of the block's ``k`` best rows, less the anchor itself."""
    need = k + 1  # the anchor may be among them

    def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        if len(least) <= need:
            return np.ones(len(least), dtype=bool)
        return most >= np.partition(least, len(least) - need)[len(least) - need]

    rows, scores = block.scan(anchor, keep)
    found = sorted((-s, i) for s, i in zip(scores, block.ids[rows].tolist(), strict=True) if i != anchor_id)
    return [(i, -s) for s, i in found[:k]]


def in_window(score: int, positive: int) -> bool:
    return LOW * positive <= 100 * score <= HIGH * positive


def negatives_in(block: Block, anchor: np.ndarray, positives: list[int], k: int = WANTED) -> list[tuple[int, int, int]]:
    """(positive score, id, score): the block's ``k`` best rows in the window of
    each positive score."""
    windows = [(LOW * p / 100, HIGH * p / 100) for p in positives if p >= 0]

    def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        alive = np.zeros(len(least), dtype=bool)
        for low, high in windows:
            slack = 1e-9 * (1 + abs(high))
            may = (most >= low - slack) & (least <= high + slack)
            sure = least[(least >= low + slack) & (most <= high - slack)]
            if len(sure) >= k:  # the k-th best of them is beaten or equalled
                may &= most >= np.partition(sure, len(sure) - k)[len(sure) - k]
            alive |= may
        return alive

    if not windows:
        return []
    rows, scores = block.scan(anchor, keep)
    ids = block.ids[rows].tolist()
    found = []
    for p in positives:
        inside = sorted((-s, i) for s, i in zip(scores, ids, strict=True) if in_window(s, p))
        found += [(p, i, -s) for s, i in inside[:k]]
    return found


def _visits(ask, names: list[str]):
    """Over rows sorted by (label, dim, b, s, asks): each group's data rows make
    a block, and ``ask(block, id, vector, payload)`` answers its anchors."""

    def run(batches):
        key, block = None, None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows: list[tuple] = []

        def out():
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in range(5)])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                *own, dim, _, _, asks = (int(x) for x in keys[:, s])
                group = (*own, *keys[1:4, s].tolist())
                if group != key:
                    key, block, held = group, None, []
                ids = batch.column(5).slice(s, e - s).to_numpy()
                vectors = batch.column(6).slice(s, e - s).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                if not asks:
                    held.append((ids, vectors))
                    continue
                if block is None and held:
                    block, held = Block(*map(np.concatenate, zip(*held, strict=True))), []
                if block is not None:
                    payload = batch.column(7).slice(s, e - s).to_pylist()
                    for i, v, p in zip(ids.tolist(), vectors, payload, strict=True):
                        rows += [(i, *r) for r in ask(block, i, v, p)]
                        if len(rows) > 20_000:
                            yield out()
        yield out()

    return run


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, dim, v): one row per id; components floor(SCALE * x)."""
    own = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("e"))
    each = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("e") > 0) & each)

    def grown(x: Column) -> Column:  # floor() gives longs; larger doubles are whole
        y = x * F.lit(float(SCALE))
        return F.when(F.abs(y) < float(2**53), F.floor(y).cast("double")).otherwise(y)

    own = own.select("vec_id", "label", F.transform("e", grown).alias("v"))
    one = own.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return one.select("vec_id", "r.label", F.size("r.v").alias("dim"), "r.v")


def dealt(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows with their block number ``b``, all blocks with minima and maxima)."""
    sizes = freeze(rows.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks")), "sizes")
    placed = rows.join(sizes, ["label", "dim"]).withColumn("b", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).drop("blocks")
    placed = freeze(placed, "dealt")
    each = placed.select("label", "dim", "b", F.posexplode("v").alias("d", "x")).groupBy("label", "dim", "b", "d").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    sides = F.array_sort(F.collect_list(F.struct("d", "low", "high")))  # one entry per dimension
    bounds = each.groupBy("label", "dim", "b").agg(sides.alias("sides"))
    return placed, freeze(bounds, "blocks")


def visit(data: DataFrame, asked: DataFrame, slices: int, ask, names: list[str]) -> DataFrame:
    """``ask`` of every anchor of ``asked`` (vec_id, v, payload) at the block
    (label, dim, b) it comes with."""
    none = F.lit(None).cast("array<long>")
    each = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    left = data.select("label", "dim", "b", each.alias("s"), F.lit(0).alias("asks"), "vec_id", "v", none.alias("payload"))
    place = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(slices)).cast("int")
    right = asked.select("label", "dim", "b", place.alias("s"), F.lit(1).alias("asks"), "vec_id", "v", "payload")
    group = ["label", "dim", "b", "s"]
    rows = left.unionByName(right).repartition(*group).sortWithinPartitions(*group, "asks", "vec_id")
    return rows.mapInArrow(_visits(ask, names), ", ".join(f"{n} long" for n in names))


def _best(found: DataFrame, by: list[str], vec_id: str, score: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), vec_id)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor, label_of=None, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    positives: int = POSITIVES, wanted: int = WANTED, block: int = BLOCK, asked: int = ASKED,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` makes a condition from the id column, ``label_of`` a label
    from the id and label columns (before anything else)."""
    rows = usable(vectors, vec_id, embedding, label)
    if label_of is not None:
        rows = rows.withColumn("label", label_of(F.col("vec_id"), F.col("label")).cast("long"))
    data, blocks = dealt(rows, block)
    anchors = data.where(is_anchor(F.col("vec_id"))).drop("b")
    slices = max(1, -(-anchors.count() // asked))
    # the anchor's own label: every block
    own = blocks.groupBy("label", "dim").agg(F.max("b").alias("last"))
    seekers = anchors.join(own, ["label", "dim"]).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("last"))))
    seekers = seekers.withColumn("payload", F.lit(None).cast("array<long>"))
    near = visit(data, seekers, slices, lambda at, i, v, _: positives_in(at, i, v, positives), ["anchor_id", "positive_id", "positive_score"])
    near = freeze(_best(near, ["anchor_id"], "positive_id", "positive_score", positives).drop("rank"), "positives")
    # other labels: the blocks that can hold a score of some window
    scores = near.groupBy("anchor_id").agg(F.array_sort(F.collect_set("positive_score")).alias("payload"))  # at most `positives`
    known = anchors.withColumnRenamed("label", "own").join(scores, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    places = blocks.groupBy("dim").agg(F.collect_list(F.struct("label", "b")).alias("places"))  # one entry per block
    pairs = known.join(places, "dim").select("vec_id", "own", "dim", "v", "payload", F.explode("places").alias("p"))
    pairs = pairs.select("vec_id", "own", "dim", "v", "payload", "p.label", "p.b").where("label <> own").join(blocks, ["label", "dim", "b"])
    term = lambda pick: F.aggregate(
        F.zip_with("v", "sides", lambda x, s: pick(x * s["low"], x * s["high"])), F.lit(0.0), lambda a, x: a + x
    )
    top, bottom = F.array_max("payload").cast("double"), F.greatest(F.array_min("payload"), F.lit(0)).cast("double")
    slack = 1e-6 * (1 + F.abs(top))
    may = (top >= 0) & (term(F.greatest) >= bottom * LOW / 100 - slack) & (term(F.least) <= top * HIGH / 100 + slack)
    pairs = pairs.where(may).select("label", "dim", "b", "vec_id", "v", "payload")
    far = visit(data, pairs, slices, lambda at, _, v, p: negatives_in(at, v, p, wanted), ["anchor_id", "positive_score", "negative_id", "negative_score"])
    far = _best(far, ["anchor_id", "positive_score"], "negative_id", "negative_score", wanted)
    out = near.join(far, ["anchor_id", "positive_score"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND {LOW} * p.positive_score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.positive_score
QUALIFY rank <= {WANTED}
"""
