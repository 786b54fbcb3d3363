"""Line dedup against brute force."""

import hashlib
import random
from collections import Counter

from shiplog.llm import line_dedup as D


def brute(docs, ratio, least):
    pages, holds = Counter(s for _, s, _ in docs), Counter()
    for _, s, t in docs:
        holds.update({(s, x.strip(" \t\r")) for x in (t or "").split("\n")})
    out = []
    for i, s, t in docs:
        if t is None:
            out.append((i, None))
            continue
        keep = []
        for x in t.split("\n"):
            n = holds[s, x.strip(" \t\r")]
            if not (x.strip(" \t\r") and n >= least and n > ratio * pages[s]):
                keep.append(x)
        out.append((i, "\n".join(keep)))
    return out


def test_matches_brute_force(spark):
    r = random.Random(1)
    lines = ["menu", "footer  ", "\tfooter\r", "", "  ", *[f"line {i}" for i in range(40)]]
    docs = [(i, r.choice(["a", "a", "b", None]), "\n".join(r.choice(lines) for _ in range(r.randint(0, 8)))) for i in range(120)]
    docs += [(500, "a", None), (501, "c", "only page\nof its site"), (502, "b", "")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    got = D.drop_boilerplate(df, max_ratio=0.12, min_pages=3)
    assert sorted((x.doc_id, x.text) for x in got.collect()) == sorted(brute(docs, 0.12, 3), key=lambda x: x[0])
    report = {x.doc_id: x for x in D.line_report(df, max_ratio=0.12, min_pages=3).collect()}
    for i, t in brute(docs, 0.12, 3):
        assert report[i].kept_md5 == hashlib.md5((t or "").encode()).hexdigest()


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a", "x")], "doc_id long, source string, text string")
    plan = D.drop_boilerplate(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(odd, empty):
    got = D.drop_boilerplate(odd)
    assert got.columns == odd.columns and got.count() == 8
    assert D.drop_boilerplate(empty).count() == 0 and D.line_report(empty).count() == 0
