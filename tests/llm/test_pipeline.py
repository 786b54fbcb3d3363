"""The pipeline against its brute-force parts, on a small fixture."""

import random
import re

import pytest

import corpus_pipeline as P

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, note string"


@pytest.fixture
def sf(spark, tmp_path):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    words = lambda n: " ".join(word() for _ in range(n))
    texts = {i: words(r.randint(60, 120)) for i in range(200)}
    toxic = set(range(0, 200, 5))
    for i in toxic:
        texts[i] += " you idiot scum moron loser " + words(5)
    item = words(30)
    for i in range(1, 200, 5):
        texts[i] += "\nshared menu line of the site"
    for i in (3, 13):
        texts[i] += "\n" + item + "\n" + words(40)
    texts[200], texts[201] = texts[2], texts[4] + " end"
    texts[202], texts[203], texts[204] = None, "", words(3)
    rows = [(i, t, "en", "s", len(t or ""), "x") for i, t in texts.items()]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), texts, toxic


def test_stages(spark, sf):
    path, texts, toxic = sf
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = []
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        out.append({x.doc_id: x.text for x in docs.collect()})
    assert set(out[0]) == set(texts) - toxic
    menu = "shared menu line of the site"
    clean = lambda t: None if t is None else "\n".join(x for x in t.split("\n") if x != menu)
    assert out[1] == {i: clean(texts[i]) for i in out[0]}
    assert set(out[2]) == set(out[1]) - {200, 201, 203}
    assert set(out[3]) == set(out[2]) - {3, 13}
    packed = P.run(spark, path).collect()
    assert {x.doc_id for x in packed} == set(out[3])
    assert all(re.fullmatch(r"\d+", str(x.length)) for x in packed)


def test_empty_tables(spark, sf, tmp_path):
    path, _, _ = sf
    empty = tmp_path / "none"
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    assert P.run(spark, str(empty)).count() == 0
