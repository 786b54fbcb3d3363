"""Prefix doubling against brute force over all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shiplog.llm import suffix_dedup as S

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(c for c, x in zip(t, gone, strict=True) if not x)
        starts = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(t)))
        out.append((len(t), sum(gone), starts, hashlib.sha256(kept).hexdigest()))
    return out


def found(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.repeated_passages(df, **options).collect()}


@pytest.mark.parametrize(("seed", "grams"), [(1, (14, 28)), (2, (10, 20, 35)), (3, (14,))])
def test_matches_brute_force(spark, seed, grams):
    r = random.Random(seed)
    word = lambda a, b: "".join(r.choice("abcdefgh é") for _ in range(r.randint(a, b)))
    passages = [word(20, 200) for _ in range(6)]
    docs = ["".join(r.choice([r.choice(passages), word(1, 120), r.choice(passages)[r.randint(0, 19) :]]) for _ in range(r.randint(0, 6))) for _ in range(50)]
    docs += [docs[3], docs[5], "a" * 300, "ab" * 60, "", "x" * 39, "y" * 40, "z" * 41, None, docs[7][3:]]
    got = found(spark, docs, length=40, grams=grams)
    for i, want in enumerate(brute([(d or "").encode() for d in docs], 40)):
        assert got[i] == want, i


def test_chunks_do_not_change_the_anchors(monkeypatch):
    raw = np.random.default_rng(1).integers(97, 100, 3000).astype(np.uint8)
    raw[1000:1400] = 97

    def by_start():
        place, rank, lo, hi = S.anchors(raw, 40, 14)
        return [(int(p), int(r)) for p, r, a, b in zip(place, rank, lo, hi, strict=True) for _ in range(a, b + 1)]

    want = by_start()
    assert len(want) == 3000 - 40 + 1
    for chunk in (64, 97, 500):
        monkeypatch.setattr(S, "CHUNK", chunk)
        assert by_start() == want


def test_full_length_passage(spark):
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcdefghijklmnop ") for _ in range(n))
    shared, just, short = word(900), word(400), word(399)
    docs = [word(1000) + shared + word(500), word(10) + shared + just, just + word(700), short + word(300), word(77) + short]
    want = brute([d.encode() for d in docs], 400)
    got = found(spark, docs)
    assert [got[i] for i in range(len(docs))] == want
    assert want[3][1] == want[4][1] == 0 and want[1][1] == 1300


def test_odd_rows(odd, empty):
    rows = S.repeated_passages(odd).collect()
    assert len(rows) == 8
    long = next(x for x in rows if x.doc_id == 5)
    assert (long.n_bytes, long.n_removed, long.n_spans, long.kept_sha256) == (5000, 5000, 1, EMPTY_SHA)
    assert all(x.n_removed == 0 for x in rows if x.doc_id != 5)
    assert S.repeated_passages(empty).count() == 0


@pytest.mark.parametrize(("chunk", "most"), [(1 << 19, 1), (100, 60)])
def test_short_runs_share_their_batches(monkeypatch, chunk, most):
    """The strings of a piece's runs come together, and chunks change no string."""
    monkeypatch.setattr(S, "CHUNK", chunk)
    r = np.random.default_rng(5)
    texts = [r.integers(97, 99, n).astype(np.uint8).tobytes() for n in (12, 300, 90, 500)]
    lows = [[0], list(range(1, 290, 12)), [80, 3], list(range(0, 490, 7))]
    highs = [[min(x + 4, len(t) - 10) for x in lo] for t, lo in zip(texts, lows, strict=True)]
    known = [[x % 2 == 0 for x in lo] for lo in lows]
    lists = [pa.array(c, pa.list_(k)) for c, k in ((lows, pa.int64()), (highs, pa.int64()), (known, pa.bool_()))]
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8, 9, 10]), pa.array(texts, pa.binary()), *lists], ["key", "text", "lo", "hi", "settled"])
    batches = list(S._string_rows(10)([batch]))
    assert len(batches) <= most
    rows = [x for b in batches for x in b.to_pylist()]
    want = [
        (i + 7, at, k, texts[i][at : at + 10]) for i in range(4) for lo, hi, k in zip(lows[i], highs[i], known[i], strict=True) for at in range(lo, hi + 1)
    ]
    assert sorted((x["key"], x["at"], x["settled"]) for x in rows) == sorted(w[:3] for w in want)
    ranks = {(x["key"], x["at"]): (x["r1"], x["r2"]) for x in rows}
    by_string = {}
    for key, at, _, string in want:
        by_string.setdefault(string, set()).add(ranks[key, at])
    assert all(len(s) == 1 for s in by_string.values()) and len(set.union(*by_string.values())) == len(by_string)
