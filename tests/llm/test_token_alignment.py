import hashlib
from collections import Counter
from itertools import accumulate

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import SF_SMALL
from shiplog.llm import token_alignment as ta
from shiplog.llm.common import read_table
from shiplog.llm.queries import op11_token_alignment


@pytest.fixture(scope="module")
def own():
    return ta.Aligner(ta.vocabulary_path(ta.VOCABULARY_A), ta.vocabulary_path(ta.VOCABULARY_B))


def whole(own, text):
    """Groups and links of a text encoded in one piece, by comparing ranges."""
    if not text:
        return [], [], [], []
    ids_a, ids_b = own.a.encode(" " + text, add_special_tokens=False).ids, own.b.encode(text)
    tokens_a, tokens_b = [own.bytes_a[i] for i in ids_a], [own.bytes_b[i] for i in ids_b]
    if {b"".join(tokens_a), b"".join(tokens_b)} != {(" " + text).encode()}:
        return [], [], [], []
    a, b = [0, *accumulate(map(len, tokens_a))], [0, *accumulate(map(len, tokens_b))]
    groups, start = [], 0
    for end in sorted(set(a[1:]) & set(b[1:])):
        inside = lambda ids, ends: ",".join(str(x) for i, x in enumerate(ids) if start < ends[i + 1] <= end)  # noqa: B023, E731
        groups.append(f"{inside(ids_a, a)}|{inside(ids_b, b)}")
        start = end
    links = [(x, y) for i, x in enumerate(ids_a) for j, y in enumerate(ids_b) if max(a[i], b[j]) < min(a[i + 1], b[j + 1])]
    return ids_a, ids_b, groups, links


def check(own, texts):
    for text, (n_a, n_b, n_groups, groups, codes) in zip(texts, own.align(texts), strict=True):
        ids_a, ids_b, want, links = whole(own, text)
        assert (n_a, n_b, n_groups, groups) == (len(ids_a), len(ids_b), len(want), ";".join(want)), text
        found = ta.np.frombuffer(codes, dtype=own.dtype).tolist()
        assert Counter(found) == Counter(x * own.base + y for x, y in links), text


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet=" \n\tab'sé日▁12.　\xa0\x1c\x00​😀̈-", max_size=16), max_size=4))
def test_stretches_align_like_whole_texts(own, texts):
    check(own, texts)


def test_special_strings_are_plain_text(own):
    check(own, ["<|endoftext|> <s>a</s>", "a <unk> <0x41>", "</s>", " lead", "trail  ", "a  b   c", "don't we'll", "x\n y\n\n z"])


def test_plain_encoder_is_the_vocabulary(own, spark):
    assert own.plain is not None
    for row in read_table(spark, SF_SMALL, "documents").limit(40).collect():  # whole texts
        assert own.plain(" " + (row["text"] or "")) == own.a.encode(" " + (row["text"] or ""), add_special_tokens=False).ids


@pytest.mark.parametrize("frequent", [ta.FREQUENT, 40, 0])
def test_report_matches_brute_force(spark, own, odd, monkeypatch, frequent):
    """With all, few and no pair counts travelling with the tasks."""
    monkeypatch.setattr(ta, "FREQUENT", frequent)
    given_rows = read_table(spark, SF_SMALL, "documents").where("length(text) < 1500").orderBy("doc_id").limit(40)
    docs = given_rows.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    parts = [(i, *whole(own, t)) for i, t in texts]
    counts = Counter(p for *_, links in parts for p in links)
    best: dict[int, int] = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    want = [
        (
            i, len(a), len(b), len(g), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(";".join(g).encode()).hexdigest() if a else "",
        )
        for i, a, b, g, links in parts
    ]
    got = [tuple(r) for r in ta.alignment_report(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_odd_and_empty_tables(odd, empty):
    got = ta.alignment_report(odd)
    assert got.count() == odd.count()
    assert got.where("n_a = 0").selectExpr("max(n_links + n_best + count_sum)", "max(groups_sha256)").first() == (0, "")
    assert ta.alignment_report(empty).count() == 0


def test_long_texts(own):
    for text in ("x" * 200_000, "ab " * 60_000, "日本" * 60_000, " " * 50_000, "it's\n" * 40_000):
        n_a, n_b, n_groups, _, codes = own.align([text])[0]
        assert min(n_a, n_b) >= n_groups > 0 and len(codes) >= 4 * max(n_a, n_b)


def test_query_keeps_every_document(spark):
    got = op11_token_alignment(spark, SF_SMALL)
    assert got.count() == read_table(spark, SF_SMALL, "documents").count()
