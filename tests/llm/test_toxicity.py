"""Segments against brute force, and held-out accuracy."""

import itertools
import random

from shiplog.llm import toxicity as T
from shiplog.llm.common import read_table

SF = "/root/testdata/sf0.01"


def brute(scores):
    """Ruzzo and Tompa by definition: the best segment (shortest, leftmost),
    then the same to its left and right."""
    if not any(s > 0 for s in scores):
        return []
    spans = itertools.combinations(range(len(scores) + 1), 2)
    a, b = max(spans, key=lambda x: (sum(scores[x[0] : x[1]]), x[0] - x[1], -x[0]))
    left, right = brute(scores[:a]), brute(scores[b:])
    return [*left, (a, b, sum(scores[a:b])), *[(x + b, y + b, s) for x, y, s in right]]


def test_segments_match_brute_force():
    r = random.Random(1)
    for _ in range(300):
        scores = [r.choice([-5, -3, -2, -1, 1.5, 2.25, 4.125]) + r.random() * 1e-3 for _ in range(r.randint(0, 14))]
        got = [(a, b, round(s, 6)) for a, b, s in T.segments(scores)]
        assert got == [(a, b, round(s, 6)) for a, b, s in brute(scores)]


def test_word_segments_keep_positions():
    seen = T.Weights({"bad": 5.0, "rott-": 4.0})
    assert T.word_segments("a b bad c rotten d e".split(), seen, 0.1) == [(2, 5, 5 + 4 - 0.3)]


def test_held_out_accuracy(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    got = {x.doc_id: x for x in T.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(got[x.doc_id].score, x.toxic) for x in labels.collect() if x.toxic is not None and x.doc_id in got and got[x.doc_id].held_out]
    right = sum((s >= 0.5) == bool(y) for s, y in held) / len(held)
    assert right > 0.93
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    area = sum((a > b) + 0.5 * (a == b) for a in bad for b in good) / (len(bad) * len(good))
    assert area > 0.85


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (4, None, None), (None, 1, 1), (6, 1, 1)], "doc_id long, quality int, toxic int")
    rows = T.toxicity(odd, labels).collect()
    assert len(rows) == 8 and all(0 <= x.score <= 1 for x in rows)
    none = labels.limit(0)
    assert {x.score for x in T.toxicity(odd, none).collect()} == {0.0}
    kept = T.drop_toxic(odd, none)
    assert kept.columns == odd.columns and kept.count() == 8
    assert T.toxicity(empty, labels).count() == 0
