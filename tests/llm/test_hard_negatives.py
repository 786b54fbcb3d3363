import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from shiplog.llm import hard_negatives as hn
from shiplog.llm.common import read_table
from shiplog.llm.queries import op12_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchor=lambda i: i % 5 == 0):
    """The contract, row by row: (anchor, positive, rank, negative, scores)."""
    own = {}
    for i, e, lab in rows:
        if i is None or lab is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        one = (lab, tuple(math.floor(hn.SCALE * x) for x in e))
        own[i] = min(own.get(i, one), one)
    out = []
    for a, (lab, v) in own.items():
        if not anchor(a):
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=True)) for i, (_, w) in own.items() if i != a and len(w) == len(v)}
        best = sorted((i for i in score if own[i][0] == lab), key=lambda i: (-score[i], i))[:5]
        for p in best:
            inside = [i for i in score if own[i][0] != lab and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            for rank, n in enumerate(sorted(inside, key=lambda i: (-score[i], i))[:3], 1):
                out.append((a, p, rank, n, score[p], score[n]))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in hn.hard_negatives(df, lambda i: i % 5 == 0, **options).collect())


def vectors(n, dim, seed, hot=0.5):
    """Clusters with rounded components (many ties), half of one label."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    rows = []
    for i in range(n):
        lab = 0 if rng.random() < hot else int(rng.integers(0, 4))
        v = np.round(centres[int(rng.integers(0, 4))] + rng.normal(size=dim) * 0.5, 1)
        rows.append((i, v.tolist(), lab))
    return rows


@pytest.mark.parametrize(("dim", "block", "asked"), [(3, 1 << 16, 1 << 16), (24, 20, 8), (9, 7, 100)])
def test_matches_brute_force(spark, dim, block, asked):
    rows = vectors(220, dim, dim)
    want = brute(rows)
    assert want and found(spark.createDataFrame(rows, SCHEMA), block=block, asked=asked) == want


def test_scan_shrinks_and_is_exact():
    rng = np.random.default_rng(5)
    data = np.floor(rng.normal(size=(500, 40)) * 50)
    anchor = np.floor(rng.normal(size=40) * (200 * 0.7 ** np.arange(40)))
    block = hn.Block(np.arange(500), data)
    score = (data @ anchor).astype(int)
    order = sorted(range(500), key=lambda i: (-score[i], i))
    assert hn.positives_in(block, -1, anchor) == [(i, score[i]) for i in order[:5]]
    assert hn.positives_in(block, order[0], anchor) == [(i, score[i]) for i in order[1:6]]
    p = int(score.max())
    inside = [i for i in order if hn.in_window(int(score[i]), p)]
    assert hn.negatives_in(block, anchor, [p, p, -7]) == [(p, i, score[i]) for i in inside[:3]] * 2
    left = []
    block.scan(anchor, lambda least, most: left.append(len(least)) or most >= np.partition(least, len(least) - 5)[-5])
    assert left[0] == 500 and left[-1] < 50


def test_odd_rows(spark):
    """Nulls, non-finite and empty vectors, other dimensions, one id with several
    vectors, repeated rows, zero and negative scores."""
    inf, nan = float("inf"), float("nan")
    rows = vectors(40, 4, 1) + [
        (50, None, 1), (55, [0.5, None, 0.1, 0.1], 1), (60, [nan, 0.0, 0.0, 0.0], 2), (65, [inf, 0.0, 0.0, 0.0], 2), (70, [], 0),
        (None, [1.0, 1.0, 1.0, 1.0], 0), (75, [1.0, 1.0, 1.0, 1.0], None), (80, [1.0, 2.0], 0), (81, [1.0, 1.0], 0), (82, [0.9, 1.0], 1),
        (5, [9.0, 9.0, 9.0, 9.0], 3), (5, [9.0, 9.0, 9.0, 9.0], 3), (90, [0.0] * 4, 0), (95, [-5.0] * 4, 7), (96, [5.0] * 4, 7),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit(1), "b": F.lit("x"), "payload": F.lit(None).cast("string")})
    assert found(df) == brute(rows)
    assert any(a == 90 for a, *_ in found(df)) and not any(a in (95, 70, 75) for a, *_ in found(df))


def test_whole_numbers_beyond_doubles(spark):
    big = 2.0**40
    rows = [(i, [big + i * 2.0**-6, float(i), -big if i % 2 else 1.0], i % 3) for i in range(30)]
    small = [(i, [v / 2**20 for v in e], lab) for i, e, lab in rows]
    block = hn.Block(np.arange(2), np.array([[2.0**40, 1.0], [2.0**40, 2.0]]))
    assert block.scan(np.array([2.0**20, 1.0]), None)[1] == [2**60 + 1, 2**60 + 2]
    assert found(spark.createDataFrame(small, SCHEMA)) == brute(small)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_query_covers_every_anchor(spark):
    got = op12_hard_negatives(spark, SF_SMALL)
    anchors = read_table(spark, SF_SMALL, "embeddings").where("vec_id % 50 = 0").count()
    assert got.select("anchor_id").distinct().count() == anchors
