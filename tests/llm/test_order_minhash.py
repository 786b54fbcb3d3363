"""Order MinHash against brute force over all pairs."""

import random

import numpy as np

from shiplog.llm import order_minhash as O
from shiplog.llm.common import word_hashes


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def brute_classes(docs):
    ids = sorted({i for i, _ in docs})
    text = dict(docs)
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = word_hashes(text[i] or ""), word_hashes(text[j] or "")
            c = lcs(a.tolist(), b.tolist())
            if (text[i] or "") == (text[j] or "") or (c and c / (len(a) + len(b) - c) >= 0.8):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return {i: root(i) for i in ids}


def edited(r, text, share):
    w = text.split()
    for _ in range(max(1, int(len(w) * share))):
        at = r.randrange(len(w))
        w[at : at + 1] = r.choice([[], ["new" + str(r.randint(0, 99))], [w[at], "more"]])
    return " ".join(w)


def test_classes_match_brute_force(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(r.randint(2, 5)))
    common = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(12):
        base = " ".join(word() for _ in range(r.randint(40, 120)))
        texts += [base, base, edited(r, base, 0.02), edited(r, base, 0.03)]
    texts += [common + " " + " ".join(word() for _ in range(50)) for _ in range(15)]  # one passage, different texts
    chain = [" ".join(word() for _ in range(80))]
    for _ in range(4):
        chain.append(edited(r, chain[-1], 0.04))
    texts += chain + ["", "", None, "one", "one", "One!"]
    r.shuffle(texts)
    docs = list(enumerate(texts))
    got = {x.doc_id: x.class_id for x in O.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_classes(docs)


def test_alignment_matches_brute_force(monkeypatch):
    r = np.random.default_rng(1)
    for chunk in (512, 7):
        monkeypatch.setattr(O, "CHUNK", chunk)
        for _ in range(60):
            a = r.integers(0, 6, r.integers(0, 40)).astype(np.uint64)
            b = r.integers(0, 6, r.integers(0, 40)).astype(np.uint64)
            assert O.aligned(a, b, 50) == lcs(a.tolist(), b.tolist())
            c = a[r.random(len(a)) > 0.05]
            best = lcs(a.tolist(), c.tolist())
            sim = best / (len(a) + len(c) - best) if len(a) and len(c) else float(len(a) == len(c))
            assert (O.similarity(a, c) >= 0.8) == (sim >= 0.8)


def test_profiles_never_rule_out_a_link():
    r = random.Random(9)
    for n in (5, 80, 3000):
        base = " ".join("abcdefghij"[r.randint(0, 9)] + str(int(r.paretovariate(0.7))) for _ in range(n))
        for share in (0.02, 0.05, 0.1):
            a, b = word_hashes(base), word_hashes(edited(r, base, share))
            if O.similarity(a, b) >= 0.8:
                assert O.may_reach(O.profile(a), O.profile(b), 0.8)
    assert len(O.profile(np.zeros(300, dtype=np.uint64))) == 4 * O.BINS
    assert not O.may_reach(O.profile(word_hashes("a b c d e")), O.profile(word_hashes("f g h i j")), 0.8)


def test_order_counts():
    base = " ".join(f"w{i}" for i in range(200))
    turned = " ".join(f"w{i}" for i in [*range(100, 200), *range(100)])
    same = lambda x, y: int((O.sketch(word_hashes(x)) == O.sketch(word_hashes(y))).sum())
    assert same(base, edited(random.Random(1), base, 0.01)) > same(base, turned) > 0


def test_odd_rows(odd, empty):
    got = O.near_duplicates(odd)
    rows = [(x.doc_id, x.class_id) for x in got.collect()]
    assert len(rows) == 8 and (None, None) in rows and (1, 1) in rows and (2, 1) in rows
    kept = O.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((x.doc_id for x in kept.collect()), key=str) == [1, 3, 4, 5, 6, None]
    assert O.near_duplicates(empty).count() == 0 and O.drop_near_duplicates(empty).count() == 0


def test_variants_of_an_absent_source(spark, monkeypatch):
    """Families whose buckets all hold over eight nodes, around the threshold:
    every linked pair that shares a sketch is in one class."""
    monkeypatch.setattr(O, "BLOCK", 16)  # several blocks a bucket
    r = random.Random(11)
    texts = []
    for _ in range(5):
        source = [f"w{r.randint(0, 999)}" for _ in range(100)]
        for _ in range(40):
            own = list(source)
            for at in r.sample(range(100), r.randint(4, 8)):
                own[at] = f"x{r.randint(0, 9999)}"
            texts.append(" ".join(own))
    docs = list(enumerate(texts))
    words = [word_hashes(t) for t in texts]
    sketches = [O.sketch(w) for w in words]
    label = list(range(len(docs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (sketches[i] == sketches[j]).any() and O.similarity(words[i], words[j]) >= 0.8:
                x, y = sorted((root(i), root(j)))
                label[y] = x
    got = {x.doc_id: x.class_id for x in O.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: root(i) for i in range(len(docs))}


def test_block_screen_matches_profiles():
    r = random.Random(12)
    base = " ".join("w" + str(int(r.paretovariate(0.7))) for _ in range(300))
    words = [word_hashes(edited(r, base, share)) for share in (0.02, 0.05, 0.08, 0.15) for _ in range(10)]
    profiles = [O.profile(w) for w in words] * 2
    n = len(words)
    nodes = np.arange(n).repeat(1).tolist() * 2
    nodes, seeks = np.array(nodes), np.arange(2 * n) < n
    names = nodes % 7
    rest = names != 0
    got = {(int(nodes[x]), int(nodes[y])) for b in O._likely(nodes, names, seeks & rest, rest, profiles, 0.8, None) for x, y in zip(*[c.tolist() for c in b], strict=True)}
    want = {
        (x, y)
        for x in range(n)
        for y in range(n)
        if x % 7 and x % 7 != y % 7 and (y % 7 == 0 or x < y) and O.may_reach(profiles[x], profiles[y], 0.8)
    }
    assert want <= got


def test_blocks_return_a_forest():
    """All variants of one text in one block: one link less than names, and no
    alignment inside what the links already join."""
    r = random.Random(13)
    base = " ".join(f"w{i}" for i in range(100))
    texts = [edited(r, base, 0.01) for _ in range(60)]
    words = [word_hashes(t) for t in texts]
    n = len(words)
    columns = {
        "node": list(range(n)) * 2, "name": list(range(n)) * 2, "seeks": [True] * n + [False] * n, "rest": [True] * 2 * n,
        "profile": [O.profile(w) for w in words] * 2, "words": [w.tobytes() for w in words] * 2,
        "cell": [7] * 2 * n, "sketch": [[7, 9]] * 2 * n,
    }
    found = O.linked(O.pa.table(columns), 0.8, None)
    assert len(found) == n - 1 and all(O.similarity(words[x], words[y]) == s >= 0.8 for x, y, s in found)
    # a later common sketch leaves the pair to the first one's bucket
    assert O.linked(O.pa.table({**columns, "cell": [9] * 2 * n}), 0.8, None) == []


def test_several_texts_under_one_id(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    docs = spark.createDataFrame([(1, a), (1, b), (1, b), (2, a + " end"), (3, b + " end"), (4, "c")], "doc_id long, text string")
    got = sorted((x.doc_id, x.class_id, x.copy_of) for x in O.near_duplicates(docs).collect())
    assert got == [(1, 1, 1)] * 3 + [(2, 1, 2), (3, 1, 3), (4, 4, 4)]
    assert sorted((x.doc_id, x.text) for x in O.drop_near_duplicates(docs).collect()) == [(1, a), (1, b), (4, "c")]
