"""Containment search against brute force over all shingles."""

import random
import re

from shiplog.llm import decontaminate as D


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, items):
    out = set()
    for i, t in docs:
        own = shingles(t)
        for j, s in items:
            want = shingles(s)
            if want and len(own & want) >= 0.8 * len(want) - 1e-9:
                out.add((i, j, len(want), len(own & want)))
    return out


def test_matches_brute_force(spark):
    r = random.Random(4)
    words = lambda n: " ".join(r.choice(["ab", "cd", "Éf", "gh", "ij", "kl", "mn", "op"]) + str(r.randint(0, 30)) for _ in range(n))
    items = [(i, words(r.randint(3, 60))) for i in range(30)] + [(90, None), (91, ""), (92, "a b c d")]
    docs = []
    for i in range(60):
        part = (r.choice(items)[1] or "").split()
        for _ in range(r.randint(0, 3)):
            if part:
                part[r.randrange(len(part))] = "zzz"
        docs.append((i, words(r.randint(0, 300)) + ", " + " ".join(part).upper() + ".\n" + words(r.randint(0, 50))))
    docs += [(100, None), (101, ""), (5, docs[5][1])]
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = [(x.doc_id, x.item_id, x.n_shingles, x.n_shared) for x in got.collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(docs, items) and found


def test_sketch_cannot_miss(spark):
    """An item keeps more sketch entries than it may lack."""
    items = spark.createDataFrame([(n, " ".join(f"w{n}x{i}" for i in range(n + 4))) for n in range(1, 70)], "item_id long, text string")
    for r in D.item_sketches(items).groupBy("item_id", "size", "need").count().collect():
        assert r["count"] >= min(r["size"], r["size"] - r["need"] + 1)


def test_odd_rows(spark, odd, empty):
    item = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert D.contaminated(odd, item).count() == 0
    assert D.drop_contaminated(odd, item).count() == odd.count()
    assert D.drop_contaminated(odd, item).columns == odd.columns
    bad = odd.sparkSession.createDataFrame([(None, "x One two, three four five SIX y"), (9, "clean words stand here in this text")], "doc_id long, text string")
    assert [r.doc_id for r in D.drop_contaminated(bad, item).collect()] == [9]
    assert D.contaminated(empty, item).count() == 0
    assert D.contaminated(odd, item.limit(0)).count() == 0
