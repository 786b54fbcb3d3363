"""Language model: gradients, probabilities that add up, counts, gain."""

import math
import random
import zlib
from collections import Counter

import numpy as np

from shiplog.llm import gru_lm as L


def test_probabilities_add_up():
    p = L.initial(np.array([5.0, 3, 9, 4, 2, 2, 1]))
    h = np.random.default_rng(1).standard_normal((3, L.HIDDEN)).astype(np.float32)
    total = sum(np.exp(L.log_prob(p, h, np.full(3, w))) for w in range(7))
    assert np.allclose(total, 1, atol=1e-5)


def test_state_is_carried_and_order_does_not_matter(monkeypatch):
    r = np.random.default_rng(2)
    p = L.initial(np.arange(1, 30, dtype=float))
    texts = [np.append(r.integers(2, 29, n), L.END).astype(np.int32) for n in (0, 5, 80, 33, 5)]
    whole = L.score_texts(p, texts)
    table = p["embed"] @ p["w"] + p["b"]
    for t, got in zip(texts, whole, strict=True):
        h, want, before = np.zeros((1, L.HIDDEN), dtype=np.float32), 0.0, L.END
        for x in t.tolist():
            h = L._step(table, p["u"], np.array([before]), h)[0]
            want += float(L.log_prob(p, h, np.array([x]))[0])
            before = x
        assert abs(got - want) < 1e-2


def test_gradients_of_rows_far_below_the_shift():
    """A row whose sum would vanish under the common shift gets its own."""
    x = np.array([[200.0, 199, 0], [-90, -91, -92], [1, 2, 3]], dtype=np.float32)
    e = np.exp(x.astype(float) - x.max(axis=1, keepdims=True))
    want = (e / e.sum(axis=1, keepdims=True) - np.eye(3)[[0, 2, 1]]) * 0.5
    assert np.allclose(L._softmax_gradient(x, np.array([0, 2, 1]), np.float32(0.5)), want, atol=1e-6)


def test_training_step_follows_the_gradient():
    """The first step moves every weight against the loss's numeric slope."""
    r = np.random.default_rng(4)
    stream = np.append(L.END, r.integers(0, 12, 40)).astype(np.int32)
    p = L.initial(np.arange(1, 13, dtype=float))
    q = L.train(p, stream, streams=1, window=40)  # one window of one row

    def loss(k, at, d):
        own = {n: v.astype(float) for n, v in p.items()}
        own[k][at] += d
        table, h, out = own["embed"] @ own["w"] + own["b"], np.zeros((1, L.HIDDEN)), 0.0
        for x, y in zip(stream[:-1].tolist(), stream[1:].tolist(), strict=True):
            h = L._step(table, own["u"], np.array([x]), h * (x != L.END))[0]
            size = own["word_b"].shape[1]
            a, b = h @ own["class_w"] + own["class_b"], h @ own["word_w"][y // size] + own["word_b"][y // size]
            out -= L._log_softmax(a)[0, y // size] + L._log_softmax(b)[0, y % size]
        return out / len(stream[1:])

    checked = 0
    for k, v in p.items():
        for _ in range(12):
            at = tuple(int(r.integers(n)) for n in v.shape)
            slope = (loss(k, at, 1e-4) - loss(k, at, -1e-4)) / 2e-4
            if abs(slope) > 1e-4:
                assert np.sign(p[k][at] - q[k][at]) == np.sign(slope), (k, at, slope)
                checked += 1
    assert checked > 40


def test_rare_tokens_come_in_their_own_rows():
    """Rows of rare tokens hold nulls for a document's columns, and none is lost."""
    import pyarrow as pa

    words = [b"a", b"b"]
    p = L.pack(L.initial(np.array([3.0, 2, 5, 4]))).astype(np.float32)
    model = {"v": 4, "flat": p, "words": words, "counts": np.array([5, 4]), "vocabulary": 4, "base_log": 1.0, "rest_log": 1.0, "n_end": 2}
    texts = [b"a x x y", b"", b"b a z x"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 2]), pa.array(texts, pa.binary())], ["doc_id", "text"])
    real, L.TaskContext = L.TaskContext, type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 3)}))})
    try:
        rows = [r for b in L._score_rows(model)([batch]) for r in b.to_pylist()]
    finally:
        L.TaskContext = real
    first = 3 << 33
    assert [(r["key"] - first, r["doc_id"], r["n_tokens"], r["n_rare"]) for r in rows if r["token"] is None] == [(0, 1, 5, 3), (1, 2, 1, 0), (2, 2, 5, 2)]
    rare = [(r["key"] - first, r["token"], r["n"], r["doc_id"], r["score"]) for r in rows if r["token"] is not None]
    assert sorted(rare, key=lambda r: r[:2]) == [(0, b"x", 2, None, None), (0, b"y", 1, None, None), (2, b"x", 1, None, None), (2, b"z", 1, None, None)]


def test_training_lowers_the_loss():
    r = random.Random(3)
    texts = []
    for _ in range(150):
        a = r.randint(2, 11)
        texts.append(np.array([a, a + 10, a, a + 10, a, L.END], dtype=np.int32))  # the next token follows from the last
    stream = np.concatenate([[L.END], *texts]).astype(np.int32)
    p = L.initial(np.bincount(stream, minlength=22).astype(float))
    loss = lambda p: -L.score_texts(p, texts).sum()
    before = loss(p)
    for _ in range(14):
        p = L.train(p, stream, streams=4)
    assert loss(p) < 0.7 * before


def docs():
    r = random.Random(5)
    out = []
    for i in range(300):
        lang = r.choice("xyz")
        out.append((i, " ".join((lang.upper() if r.random() < 0.1 else lang) + str(int(r.paretovariate(1))) for _ in range(r.randint(1, 60)))))
    return out


def test_counts_and_gain(spark):
    rows = [*docs(), (900, None), (901, ""), (902, "a\x0bb\x1cc　d  É é")]
    got = {x.doc_id: x for x in L.score(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary=40, frequent=80, share=1.0).collect()}
    words = {i: (t or "").encode().lower().split() + [b""] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    c = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in words.items():
        x = got[i]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(x.base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) < 1e-6
    out = [i for i in words if held[i]]
    assert sum(got[i].score for i in out) > sum(got[i].base_score for i in out)


def test_every_document_trains_in_one_small_shard(spark):
    texts = ["the same text"] * 4000 + [f"text {i}" for i in range(8000)]
    df = spark.createDataFrame([(7 if i < 2000 else i, t.encode()) for i, t in enumerate(texts)], "doc_id long, text binary").repartition(4)
    dealt, turns = L.deal(df, len(texts))
    rows = dealt.collect()
    assert Counter(bytes(r.text).decode() for r in rows) == Counter(texts)
    assert {r.turn for r in rows} == set(range(turns)) and turns >= L.ROUNDS
    sizes = Counter((r.turn, r.shard) for r in rows)
    assert 0.7 * L.SHARD_DOCS < min(sizes.values()) and max(sizes.values()) < 1.5 * L.SHARD_DOCS


def test_gain_with_production_parameters(spark):
    """Each word follows from the last, which counts alone cannot show."""
    r = random.Random(8)
    rows = []
    for i in range(1500):
        a = r.randint(0, 9)
        rows.append((i, " ".join(f"w{(a + k) % 10}" for k in range(150))))
    held = [x for x in L.score(spark.createDataFrame(rows, "doc_id long, text string")).collect() if x.held_out]
    assert sum(x.score for x in held) > 0.6 * sum(x.base_score for x in held)


def test_odd_rows(odd, empty):
    rows = L.score(odd).collect()
    assert len(rows) == 8 and all(x.score <= 0 for x in rows)
    assert L.score(empty).count() == 0
    only = odd.where("doc_id is null")
    assert L.score(only).count() == 1


def test_texts_share_lanes_of_equal_length():
    """Many short texts beside a long one fill the lanes, and each keeps its score."""
    r = np.random.default_rng(6)
    p = L.initial(np.arange(1, 30, dtype=float))
    lengths = np.array([400, *r.integers(1, 60, 300)])
    dealt = L.lanes(lengths, 8)
    assert sorted(i for own in dealt for i in own) == list(range(301))
    held = [lengths[own].sum() for own in dealt]
    assert held == sorted(held, reverse=True) and held[0] - held[-1] < 60
    texts = [np.append(r.integers(2, 29, n - 1), L.END).astype(np.int32) for n in lengths]
    together = L.score_texts(p, texts)
    assert all(abs(together[i] - L.score_texts(p, [texts[i]])[0]) < 1e-2 for i in range(0, 301, 30))
    assert len(L.score_texts(p, [])) == 0


def test_tokens_of_many_texts():
    """Words of all texts at once: as bytes.split, for any bytes."""
    import pyarrow as pa

    texts = [b"", b"  A b\x0bc\x1cD\t\n", b" ", b"\xff\xfeE \xc3\x89 e", b"x" * 3000, b"a  a"]
    words, n = L.tokens(pa.array([b"skipped", *texts], pa.binary()).slice(1))
    assert n.tolist() == [len(t.split()) for t in texts]
    assert words.to_pylist() == [w for t in texts for w in t.lower().split()]
    rows = [x for b in L._count([pa.RecordBatch.from_arrays([pa.array(texts * 2, pa.binary())], ["text"])]) for x in b.to_pylist()]
    want = Counter(w for t in texts * 2 for w in [*t.lower().split(), b""])
    assert {x["token"]: x["n"] for x in rows} == want and len(rows) == len(want)


def test_slices_follow_the_bytes(monkeypatch):
    """Long texts come alone, and training and counting see every text once."""
    import pyarrow as pa

    monkeypatch.setattr(L, "SLICE_BYTES", 300)
    texts = [b"a b", b"c " * 400, b"", b"b a", b"d " * 500, b"e"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])
    cut = list(L.slices(batch))
    assert len(cut) >= 3 and [x for c in cut for x in c.column(0).to_pylist()] == texts
    got = Counter()
    for b in L._count([batch]):
        got.update({x["token"]: x["n"] for x in b.to_pylist()})
    assert got == Counter(w for t in texts for w in [*t.split(), b""])
    seen = []
    monkeypatch.setattr(L, "train", lambda p, stream: seen.append(stream) or p)
    words = [b"a", b"b", b"c", b"d"]
    L._train_shard(6, L.pack(L.initial(np.ones(6))), words, np.ones(4), 6)(pa.Table.from_batches([batch]))
    want = [L.END]
    for t in sorted(texts):
        want += [words.index(w) + 2 if w in words else L.UNKNOWN for w in t.split()] + [L.END]
    assert seen[0].tolist() == want
