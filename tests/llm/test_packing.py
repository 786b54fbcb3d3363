"""Packing: exact round trip, and cuts against brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from shiplog.llm import packing as P


def test_encoder_is_exact():
    whole = Tokenizer.from_file(P.vocabulary_path())
    texts = [
        "Foo. BAR_x é.é á. ab́ x² don't. it'S ÀÉ. <|ENDOFTEXT|> <|endoftext|>a <|startoftext|>. ½a abc… 日本. ß ẞ ς",
        "a b\x1cc　d é́x x'll've 12345 ½ ①", " a\x85b '​s", "   ", "x" * 5000, "\x00 \x01a...!? İİ ΑΣ", "",
    ]
    enc = P.Encoder(P.vocabulary_path())
    for _ in range(2):  # unknown parts, then known ones
        got = enc.encode([t.encode() for t in texts])
        assert [np.frombuffer(b, dtype="<u4").tolist() for b in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_holds_few_parts(monkeypatch):
    """Texts of ever new words: the tables stay small, a frequent word stays
    known, and the ids are those of a fresh encoder."""
    monkeypatch.setattr(P, "GENERATION", 200, raising=False)
    enc, r = P.Encoder(P.vocabulary_path()), random.Random(6)
    learnt, learn = [], enc.learn
    monkeypatch.setattr(enc, "learn", lambda parts: (learnt.extend(parts), learn(parts)))
    texts = [[" ".join(["often,", *("".join(r.choices("abcdefgh", k=9)) + r.choice(["", ".", "!?"]) for _ in range(30))]).encode() for _ in range(3)] for _ in range(60)]
    got = []
    for own in texts:
        got += enc.encode(own)
        tables = [v for v in vars(enc).values() if isinstance(v, dict)]
        assert sum(map(len, tables)) < 2 * 200 + 4 * 180 + 100
    assert learnt.count(b"often,") == 1
    assert got == P.Encoder(P.vocabulary_path()).encode([t for own in texts for t in own])


def test_cuts_match_brute_force():
    r = random.Random(1)
    for _ in range(200):
        size = r.randint(4, 12)
        gaps = [r.randint(1, size) for _ in range(r.randint(1, 9))]
        places = np.cumsum(gaps)
        kinds = np.array([r.choice([0, 1, 3]) for _ in gaps])
        cost = {0: 0}
        for p, k in zip(places.tolist(), kinds.tolist(), strict=True):
            cost[p] = min(c + size - (p - q) for q, c in cost.items() if 0 < p - q <= size) + k
        found = [0, *P.cuts(places, kinds, size)]
        own = sum(size - (b - a) + int(kinds[places.tolist().index(b)]) for a, b in zip(found, found[1:], strict=False))
        assert found[-1] == places[-1] and own == cost[int(places[-1])]


def check(rows, docs, size):
    whole = Tokenizer.from_file(P.vocabulary_path())
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for x in rows:
        by_doc[x.doc_id].append(x)
        by_seq[x.sequence_id].append(x)
    for i, t in docs:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, P.END_ID], dtype="<u4").tobytes()
        at = 0
        for x in sorted(by_doc[i], key=lambda x: x.start):
            assert x.start == at and x.length > 0 and x.doc_tokens == len(ids) // 4
            at += x.length
            assert x.ids_crc32 == zlib.crc32(ids[x.start * 4 : at * 4])
        assert at == len(ids) // 4
    padding = tokens = 0
    for own in by_seq.values():
        at = 0
        for x in sorted(own, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= size
        tokens += at
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding, tokens


@pytest.mark.parametrize("block", [400_000, 500])
def test_round_trip(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    r = random.Random(2)
    docs = [(i, " ".join(r.choice(["the", "cat", "sat.", "Down,", "émigré!", "x" * 50]) for _ in range(int(r.paretovariate(0.8) * 8) % 3000))) for i in range(150)]
    docs += [(900, None), (901, ""), (902, "word " * 9000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    padding, tokens = check(P.pack(df, size=512).collect(), docs, 512)
    assert padding < 0.05 * tokens


def test_odd_rows(odd, empty):
    rows = P.pack(odd).collect()
    assert len({(x.sequence_id, x.offset) for x in rows}) == len(rows)
    assert sum(x.start == 0 for x in rows) == 8
    assert P.pack(empty).count() == 0
