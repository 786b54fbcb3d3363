import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import SF_SMALL
from shiplog.llm import segment_simhash as sh
from shiplog.llm.common import read_table
from shiplog.llm.queries import op13_segment_simhash


def plain_print(text):
    """Fingerprint of a text, bit by bit."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [words[i : i + 4] for i in range(len(words) - 3)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, distance=4):
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    prints = [plain_print(t) for _, t in rows]
    known = sorted(set(prints))
    name = {p: p for p in known}

    def root(p):
        while name[p] != p:
            p = name[p]
        return p

    for i, p in enumerate(known):
        for q in known[:i]:
            if (p ^ q).bit_count() <= distance:
                name[root(p)] = root(q)
    first = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            first[root(p)] = min(first.get(root(p), i), i)
    return sorted(((i, f"{p:016x}", first.get(root(p))) for (i, _), p in zip(rows, prints, strict=True)), key=repr)


def found(docs, **options):
    return sorted((tuple(r) for r in sh.simhash_classes(docs, **options).collect()), key=repr)


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.text(alphabet="aBÉé \t\n\x0b\x1c\x85.", max_size=40))
def test_fingerprint(text):
    assert sh.fingerprint(text.encode()) == plain_print(text)


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4), st.sampled_from([1, 2, 4]))
def test_near_prints_meet_in_a_cell(p, bits, segment):
    q = p
    for b in bits:
        q ^= 1 << b
    own = []
    for x in (p, q):
        placed = list(sh.cells(np.array([x], dtype=np.uint64).view(np.int64), 4, segment))
        own.append(({int(c) for cell, _, v in placed if not v for c in cell}, {int(c) for cell, _, _ in placed for c in cell}))
    assert own[0][0] & own[1][1] or own[1][0] & own[0][1]


def test_matches_brute_force_on_documents(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert found(docs) == brute(rows)


def _variants(n, seed=7):
    """Texts of many words, each with a few words changed, and unrelated ones."""
    rng = np.random.default_rng(seed)
    source = [f"w{i}" for i in rng.integers(0, 5000, 400)]
    rows = []
    for i in range(n):
        own = list(source) if i % 3 else [f"u{j}" for j in rng.integers(0, 5000, 30)]
        for k in rng.integers(0, len(own), i % 7):
            own[k] = f"x{i}"
        rows.append((n - i, " ".join(own)))
    return rows


@pytest.mark.parametrize("block", [sh.BLOCK, 4])
def test_large_groups_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(sh, "BLOCK", block)
    rows = _variants(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len({c for *_, c in want}) < len({p for _, p, _ in want}) < 150
    assert found(docs) == want


def test_forest_is_small_and_spans():
    rng = np.random.default_rng(3)
    prints = np.array([(1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (300, 2))], dtype=np.int64)
    got = sh.forest(prints, prints)
    assert len(got) == len(np.unique(prints)) - 1  # all within four bits of each other


def test_odd_and_empty_tables(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = found(odd)
    assert got == brute(rows)
    assert (1, "0" * 16, 1) in got and (2, "0" * 16, 1) in got and (None, "0" * 16, 1) in got
    assert sh.simhash_classes(empty).count() == 0


def test_ids_all_null(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "c")], "doc_id long, text string")
    assert {c for *_, c in found(docs)} == {None}


def test_long_text():
    assert sh.fingerprint(b"word " * 400_000) == plain_print("word " * 5)


def test_query_keeps_every_document(spark):
    assert op13_segment_simhash(spark, SF_SMALL).count() == read_table(spark, SF_SMALL, "documents").count()
