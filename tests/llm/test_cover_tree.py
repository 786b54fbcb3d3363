"""Dual-tree search against brute force."""

import numpy as np
import pytest

from shiplog.llm import cover_tree as C


def brute(rows, k, scale=1024):
    vs = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            vs[i] = [int(np.floor(scale * float(x))) for x in v]
    out = []
    for q in sorted(vs):
        if q % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(vs[q], vs[i], strict=True)), i) for i in vs if i != q and len(vs[i]) == len(vs[q]))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = C.top_k(df, lambda v: v % 10 == 0, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


@pytest.mark.parametrize("blocks", [{}, {"block": 60, "query_block": 7}])
def test_matches_brute_force(spark, blocks):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((5, 8))
    rows = [(i, (centres[i % 5] + 0.2 * rng.standard_normal(8)).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 380)]  # one very common vector
    rows += [(400, None), (401, []), (410, [float("nan")] * 8), (411, [1.0, None] * 4), (None, [1.0] * 8), (420, [0.5, 0.25]), (421, [1.0, 2.0]), (7, rows[7][1])]
    assert run(spark, rows, **blocks) == brute(rows, 10)


def test_scores_beyond_floats(spark):
    big = float(2**26)
    rows = [(i, [big + i, 1.0 + i]) for i in range(12)]
    assert run(spark, rows, scale=1) == brute(rows, 10, 1)


def test_few_and_no_vectors(spark):
    assert run(spark, [(10, [1.0])]) == []
    assert run(spark, [(10, [1.0]), (11, [2.0])]) == [(10, 1, 11, 1024 * 2048)]
    assert run(spark, []) == []


def test_tree_covers_and_separates():
    points = np.random.default_rng(2).standard_normal((900, 3))
    t = C.Tree(points)
    assert sorted(t.order.tolist()) == list(range(900))
    for i, kids in enumerate(t.kids):
        own = t.points[t.lo[i] : t.hi[i]]
        assert np.sqrt(((own - t.points[t.centre[i]]) ** 2).sum(axis=1)).max() <= t.radius[i] + 1e-9
        if kids:
            assert [t.lo[kids[0]], t.hi[kids[-1]]] == [t.lo[i], t.hi[i]]
