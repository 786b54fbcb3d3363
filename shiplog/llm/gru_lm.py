"""Document log-likelihood under a gated recurrent language model.

Corpus statistics: the tokens of all training documents are counted over Spark.
At most ``vocabulary`` of the most frequent tokens are the model's own; any other token
has the model's unknown-token probability times its share (c + 1 of c
occurrences) among the tokens outside the vocabulary, one unseen kind included,
so the probabilities of all tokens add up to one.

Model (numpy): embedding, one gated recurrent layer, and a softmax factored by
class (a token's class, then the token within its class; classes by frequency
rank). Output biases start at the corpus counts. Training is data-parallel: in
every round another slice of the training documents is dealt, row by row, to
shards of about ``SHARD_DOCS`` documents, so that every document takes part
once. A shard starts from the common parameters and runs truncated
backpropagation over windows of ``WINDOW`` tokens with the state carried from
window to window; then the parameters are averaged, weighted by tokens, in a
Spark aggregation. There is a round more for each doubling of the shards, so a
longer corpus also trains longer.

Scoring reads every document whole: documents run side by side in
lanes of equal length, with the state carried over a document. Counts of at most ``frequent``
of the most frequent tokens travel with the task; the others are joined over
Spark.

Defined results: null counts as the empty text, whose only token is the end; a
corpus without training documents has no counts (base score 0) and an untrained
model; repeated rows are scored each; null ids hash as the empty text; other
columns play no part.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import crc_remainder, freeze, text_bytes

MODULUS, HELD_OUT = 7, 2
VOCABULARY = 4096
FREQUENT = 131_072
SHARE = 1.0
SHARD_DOCS = 400
ROUNDS = 2
EMBED, HIDDEN, WINDOW = 16, 24, 32
STREAMS = 256
STEPS = 24
RATE = 0.02
#: Parameter sums that reach the driver in a round.
SUMS = 8
SIDE_BY_SIDE = 512
POOL_TOKENS = 4_000_000
#: Rows of a softmax worked on at once: their activations stay in the cache.
ROWS = 1024
#: Text that is split into words at once (a longer text has its own slice).
SLICE_BYTES = 4 << 20
UNKNOWN, END = 0, 1
LOG10 = math.log(10)


def slices(batch: pa.RecordBatch, text: int = 0):
    """Slices of a record batch, cut by the bytes of their texts."""
    size = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    edges = [0, *(np.flatnonzero(np.diff(size // SLICE_BYTES)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, one after the other, and each text's number of
    them: ASCII letters lower-cased, split at ASCII white space. The bytes are
    never decoded."""
    kind = pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()
    plain = pa.Array.from_buffers(kind, len(texts), texts.buffers(), offset=texts.offset)
    split = pc.ascii_split_whitespace(pc.ascii_lower(plain))
    words, n = split.flatten().cast(pa.binary()), split.value_lengths().to_numpy(zero_copy_only=False)
    full = pc.greater(pc.binary_length(words), 0)
    n = np.bincount(np.repeat(np.arange(len(n)), n)[full.to_numpy(zero_copy_only=False)], minlength=len(n))
    return words.filter(full), n


# --- the model -------------------------------------------------------------


def shapes(v: int) -> dict[str, tuple[int, ...]]:
    size = math.ceil(math.sqrt(v))
    classes = math.ceil(v / size)
    return {
        "embed": (v, EMBED), "w": (EMBED, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
        "class_w": (HIDDEN, classes), "class_b": (classes,), "word_w": (classes, HIDDEN, size), "word_b": (classes, size),
    }


def initial(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Start parameters: small random weights, biases from the counts."""
    v = len(counts)
    rng = np.random.default_rng(12345)
    p = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in shapes(v).items()}
    classes, size = p["word_b"].shape
    padded = np.zeros(classes * size)
    padded[:v] = counts + 0.5
    padded = padded.reshape(classes, size)
    with np.errstate(divide="ignore"):
        inner = np.log(padded / padded.sum(axis=1, keepdims=True))
    p["word_b"] = np.maximum(inner, -1e4).astype(np.float32)
    p["class_b"] = np.log(padded.sum(axis=1) / padded.sum()).astype(np.float32)
    p["class_w"] *= 0.1
    p["word_w"] *= 0.1
    p["b"][:] = 0
    return p


def pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x.ravel() for x in p.values()])


def _views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The parts of a parameter vector, shaped as in ``like``."""
    out, at = {}, 0
    for k, x in like.items():
        out[k] = flat[at : at + x.size].reshape(x.shape)
        at += x.size
    return out


def unpack(flat: np.ndarray, v: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in shapes(v).items():
        n = int(np.prod(s))
        out[k] = flat[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


def _gates(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The inputs of some steps, (steps, 3 * HIDDEN, rows): a gate's values lie
    side by side, so that every step works on unbroken memory."""
    return np.ascontiguousarray(np.take(table, ids, axis=0).transpose(0, 2, 1))


def _advance(g: np.ndarray, ut: np.ndarray, h: np.ndarray):
    """One step of the layer, a column per row: (new state, z and r, candidate, h times u)."""
    hu = ut @ h
    zr = g[: 2 * HIDDEN] + hu[: 2 * HIDDEN]
    np.negative(zr, out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    n = zr[HIDDEN:] * hu[2 * HIDDEN :]
    n += g[2 * HIDDEN :]
    np.tanh(n, out=n)
    new = h - n
    new *= zr[:HIDDEN]
    new += n
    return new, zr, n, hu


def _step(table: np.ndarray, u: np.ndarray, x: np.ndarray, h: np.ndarray):
    """One step with a row per token: (new state, z and r, candidate, h times u)."""
    return tuple(v.T for v in _advance(_gates(table, x[None])[0], u.T, h.T))


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _softmax_gradient(x: np.ndarray, target: np.ndarray, scale: np.float32) -> np.ndarray:
    """``scale`` times (softmax of each row less one at its target); ``x`` is
    used up. One shift serves all rows, as in ``_at``."""
    x -= x.max()
    ones = np.ones(x.shape[1], dtype=x.dtype)
    e = np.exp(x)
    total = e @ ones
    if total.min() < 1e-30:
        x -= x.max(axis=1, keepdims=True)
        e = np.exp(x)
        total = e @ ones
    e *= (scale / total)[:, None]
    e[np.arange(len(e)), target] -= scale
    return e


def _rows_summed(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct places and the sum of the rows of each."""
    order = np.argsort(at, kind="stable")
    edges = np.flatnonzero(np.diff(at[order], prepend=-1))
    return at[order[edges]], np.add.reduceat(rows[order], edges, axis=0)


def _at(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-softmax of each row at its target. One shift serves all rows unless
    a row lies so low that its sum would vanish."""
    row = np.arange(len(x))
    top = x.max()
    e = x - top
    own = e[row, target]
    total = np.exp(e, out=e) @ np.ones(x.shape[1], dtype=x.dtype)
    if total.min() < 1e-30:
        return _log_softmax(x)[row, target]
    return own - np.log(total)


def _by_class(target: np.ndarray, size: int):
    """Class of each target, the order of the targets by class, and (class,
    first, end) of each class in that order."""
    kind = target // size
    order = np.argsort(kind.astype(np.int16), kind="stable")
    edges = np.flatnonzero(np.diff(kind[order], prepend=-1))
    return kind, order, list(zip(kind[order[edges]].tolist(), edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True))


def _in_class(p: dict[str, np.ndarray], h: np.ndarray, groups: list[tuple[int, int, int]]) -> np.ndarray:
    """The inner activations of the states ``h``, sorted by class."""
    x = np.empty((len(h), p["word_b"].shape[1]), dtype=np.float32)
    for c, a, b in groups:
        np.matmul(h[a:b], p["word_w"][c], out=x[a:b])
        x[a:b] += p["word_b"][c]
    return x


def log_prob(p: dict[str, np.ndarray], h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log-probability of each target after its state."""
    size = p["word_b"].shape[1]
    kind, order, groups = _by_class(target, size)
    inner, place = _in_class(p, h[order], groups), (target - kind * size)[order]
    out, own = np.empty(len(h), dtype=np.float32), np.empty(len(h), dtype=np.float32)
    for a in range(0, len(h), ROWS):
        b = a + ROWS
        out[a:b] = _at(h[a:b] @ p["class_w"] + p["class_b"], kind[a:b])
        own[a:b] = _at(inner[a:b], place[a:b])
    out[order] += own
    return out


def lanes(lengths: np.ndarray, most: int) -> list[list[int]]:
    """Texts dealt to at most ``most`` lanes that are about equally long, the
    longest lane first: the longest text left goes to the shortest lane."""
    heap = [(0, k) for k in range(min(most, len(lengths)))]
    out: list[list[int]] = [[] for _ in heap]
    for i in np.argsort(-lengths, kind="stable").tolist():
        held, k = heap[0]
        out[k].append(i)
        heapq.heapreplace(heap, (held + int(lengths[i]), k))
    return [out[k] for _, k in sorted(heap, key=lambda x: (-x[0], x[1]))]


def score_texts(p: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Log-probability of every text (ids ending with END), state carried over
    the whole text. A lane holds one text after the other; the state starts
    anew after every END."""
    total = np.zeros(len(texts))
    if not len(texts):
        return total
    table, ut = p["embed"] @ p["w"] + p["b"], np.ascontiguousarray(p["u"].T)
    lengths = np.array([len(t) for t in texts])
    dealt = lanes(lengths, max(1, min(SIDE_BY_SIDE, 4_000_000 // max(1, int(lengths.max())))))
    ends = np.array([lengths[own].sum() for own in dealt])
    longest = int(ends[0])
    ids, text = np.full((longest + 1, len(dealt)), END, dtype=np.int32), np.zeros((longest, len(dealt)), dtype=np.int32)
    for k, own in enumerate(dealt):
        ids[1 : ends[k] + 1, k] = np.concatenate([texts[i] for i in own])
        text[: ends[k], k] = np.repeat(own, lengths[own])
    active = np.searchsorted(-ends, -np.arange(longest), side="left").tolist()
    h = np.zeros((HIDDEN, len(dealt)), dtype=np.float32)
    states, targets, who, held, block = [], [], [], 0, 8
    for t in range(longest):
        a = active[t]
        if t % block == 0:
            gates = _gates(table, ids[t : min(t + block, longest), :a])
        h = h[:, :a]
        anew = np.flatnonzero(ids[t, :a] == END)
        if len(anew):
            h[:, anew] = 0
        h = _advance(gates[t % block, :, :a], ut, h)[0]
        # the state is changed in place where a text ends, so a copy is kept
        states.append(h.T.copy())
        targets.append(ids[t + 1, :a])
        who.append(text[t, :a])
        held += a
        if held >= 8_192 or t == longest - 1:
            lp = log_prob(p, np.concatenate(states), np.concatenate(targets))
            total += np.bincount(np.concatenate(who), weights=lp, minlength=len(texts))
            states, targets, who, held = [], [], [], 0
    return total


def train(p: dict[str, np.ndarray], stream: np.ndarray, rate: float = RATE, streams: int = STREAMS, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Truncated backpropagation through time over a token stream, laid out in
    up to ``streams`` rows, so that there are ``STEPS`` windows; the state is carried between windows and starts anew
    after every END. Adam steps with a clipped mean gradient."""
    rows = max(1, min(streams, len(stream) // (window * STEPS + 1)))
    length = (len(stream) - 1) // rows if len(stream) else 0
    if length < 2:
        return p
    x_all = stream[: rows * length].reshape(rows, length).T
    y_all = stream[1 : rows * length + 1].reshape(rows, length).T
    flat = pack(p)
    p, m1, m2, grad, room = _views(flat, p), np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat), np.empty_like(flat)
    g = _views(grad, p)
    size = p["word_b"].shape[1]
    h, step, H = np.zeros((HIDDEN, rows), dtype=np.float32), 0, HIDDEN
    for t0 in range(0, length, window):
        x, y = x_all[t0 : t0 + window], y_all[t0 : t0 + window]
        n_steps, going = len(x), (x != END).astype(np.float32)
        gates, ut = _gates(p["embed"] @ p["w"] + p["b"], x), np.ascontiguousarray(p["u"].T)
        before, states = np.empty((n_steps, H, rows), dtype=np.float32), np.empty((n_steps, H, rows), dtype=np.float32)
        zr, n, hn = np.empty((n_steps, 2 * H, rows), dtype=np.float32), np.empty_like(before), np.empty_like(before)
        for t in range(n_steps):
            np.multiply(h, going[t], out=before[t])
            h, zr[t], n[t], hu = _advance(gates[t], ut, before[t])
            states[t], hn[t] = h, hu[2 * H :]
        z, r = zr[:, :H], zr[:, H:]
        hs, target = np.ascontiguousarray(states.transpose(0, 2, 1)).reshape(-1, H), y.ravel()
        grad[:] = 0
        kind, order, groups = _by_class(target, size)
        scale = np.float32(1 / len(target))
        d = _softmax_gradient(hs @ p["class_w"] + p["class_b"], kind, scale)
        g["class_w"][:], g["class_b"][:] = hs.T @ d, np.ones(len(d), dtype=np.float32) @ d
        dh_all = d @ p["class_w"].T
        hs = hs[order]
        d = _softmax_gradient(_in_class(p, hs, groups), (target - kind * size)[order], scale)
        dh_words = np.empty_like(hs)
        for c, a, b in groups:
            np.matmul(hs[a:b].T, d[a:b], out=g["word_w"][c])
            np.sum(d[a:b], axis=0, out=g["word_b"][c])
            np.matmul(d[a:b], p["word_w"][c].T, out=dh_words[a:b])
        dh_all[order] += dh_words
        dh_all = np.ascontiguousarray(dh_all.reshape(n_steps, rows, H).transpose(0, 2, 1))
        # the factors of dh in the gradients of the three gates, for all steps
        by_z, by_n, by_r = (before - n) * z * (1 - z), (1 - z) * (1 - n * n), hn * r * (1 - r)
        d_in, d_hu = np.empty((n_steps, 3 * H, rows), dtype=np.float32), np.empty((n_steps, 3 * H, rows), dtype=np.float32)
        dh = np.zeros_like(h)
        for t in range(n_steps - 1, -1, -1):
            dh += dh_all[t]
            own = d_in[t]
            np.multiply(dh, by_z[t], out=own[:H])
            np.multiply(dh, by_n[t], out=own[2 * H :])
            np.multiply(own[2 * H :], by_r[t], out=own[H : 2 * H])
            d_hu[t, : 2 * H] = own[: 2 * H]
            np.multiply(own[2 * H :], r[t], out=d_hu[t, 2 * H :])
            dh *= z[t]
            dh += p["u"] @ d_hu[t]
            dh *= going[t]
        g["u"][:] = np.matmul(before, d_hu.transpose(0, 2, 1)).sum(axis=0)
        # only the tokens of the window have a gradient
        d_in = np.ascontiguousarray(d_in.transpose(0, 2, 1)).reshape(-1, 3 * H)
        at, d_embed = _rows_summed(x.ravel(), d_in @ p["w"].T)
        g["embed"][at], g["w"][:], g["b"][:] = d_embed, np.take(p["embed"], x.ravel(), axis=0).T @ d_in, np.ones(len(d_in), dtype=np.float32) @ d_in
        grad *= np.float32(min(1.0, 1.0 / (math.sqrt(float(grad @ grad)) + 1e-12)))
        step += 1
        slow = rate * min(1.0, step / 10)
        np.multiply(grad, grad, out=room)
        room -= m2
        room *= np.float32(0.01)
        m2 += room
        grad -= m1
        grad *= np.float32(0.1)
        m1 += grad
        np.multiply(m2, np.float32(1 / (1 - 0.99**step)), out=room)
        np.sqrt(room, out=room)
        room += np.float32(1e-8)
        np.divide(m1, room, out=room)
        room *= np.float32(slow / (1 - 0.9**step))
        flat -= room
    return p


# --- Spark jobs ------------------------------------------------------------


def _count(batches):
    held: list[pa.RecordBatch] = []
    size = 0

    def summed():
        return pa.Table.from_batches(held).group_by("token", use_threads=False).aggregate([("n", "sum")]).rename_columns(["token", "n"]).combine_chunks().to_batches()

    for batch in batches:
        for part in slices(batch):
            found = pc.value_counts(tokens(part.column(0))[0])
            # the empty token is the end of a text
            words = pa.concat_arrays([found.field("values"), pa.array([b""], pa.binary())])
            counts = pa.concat_arrays([found.field("counts"), pa.array([part.num_rows], pa.int64())])
            held.append(pa.RecordBatch.from_arrays([words, counts], ["token", "n"]))
            size += len(words)
            if size > 1_000_000:
                held = summed()
                size = sum(b.num_rows for b in held)
                if size > 500_000:
                    yield from held
                    held, size = [], 0
    if held:
        yield from summed()


def token_counts(training: DataFrame) -> DataFrame:
    """(token, c) over the training texts; the empty token is the end."""
    return training.select("text").mapInArrow(_count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("c"))


class Table:
    """The frequent tokens and their counts; the first ones are the model's."""

    def __init__(self, words: list[bytes], counts: np.ndarray, vocabulary: int):
        words = [w for w in words if w]
        self.words = pa.array(words, pa.binary())
        self.counts = counts
        self.own = min(len(words), vocabulary - 2)

    def places(self, words: pa.Array) -> np.ndarray:
        """Table places of some words (-1: not in the table)."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)

    def model_ids(self, at: np.ndarray) -> np.ndarray:
        """Model ids of table places (-1: not in the table)."""
        return np.where((at >= 0) & (at < self.own), at + 2, UNKNOWN).astype(np.int32)


def _train_shard(v: int, flat: np.ndarray, words: list[bytes], counts: np.ndarray, vocabulary: int):
    def run(table: pa.Table) -> pa.Table:
        known = Table(words, counts, vocabulary)
        parts = [np.array([END], dtype=np.int32)]
        for batch in table.sort_by("text").select(["text"]).to_batches():
            for part in slices(batch):
                found, n = tokens(part.column(0))
                own = np.full(len(found) + len(n), END, dtype=np.int32)
                inside = np.ones(len(own), dtype=bool)
                inside[np.cumsum(n + 1) - 1] = False
                own[inside] = known.model_ids(known.places(found))
                parts.append(own)
        stream = np.concatenate(parts)
        p = pack(train(unpack(flat, v), stream)).astype(np.float64)
        weight = float(len(stream))
        return pa.Table.from_arrays([pa.array([(p * weight).tobytes()], pa.binary()), pa.array([weight])], ["sums", "weight"])

    return run


SUMMED = "sums binary, weight double"


def _summed(batches):
    total, weight = None, 0.0
    for batch in batches:
        for row, w in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(row.as_buffer(), dtype=np.float64)
            total = own.copy() if total is None else total + own
            weight += w
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([weight])], ["sums", "weight"])


def mean_parameters(trained: DataFrame, shards: int) -> np.ndarray | None:
    """The mean of the shards' parameters by their tokens: summed in every task,
    then over ever fewer tasks; ``SUMS`` sums come to the driver."""
    sums = trained.mapInArrow(_summed, SUMMED)
    parts = math.ceil(math.sqrt(shards))
    while parts > SUMS:
        sums = sums.repartition(parts).mapInArrow(_summed, SUMMED)
        parts = math.ceil(parts / SUMS)
    rows = sums.repartition(SUMS).mapInArrow(_summed, SUMMED).collect()
    if not rows:
        return None
    return sum(np.frombuffer(r["sums"], dtype=np.float64) for r in rows) / sum(r["weight"] for r in rows)


def _score_rows(model: dict):
    v, words, counts, vocabulary = model["v"], model["words"], model["counts"], model["vocabulary"]
    base_log, rest_log, n_end = model["base_log"], model["rest_log"], model["n_end"]
    names = ["key", "doc_id", "n_tokens", "n_known", "base", "score", "n_rare", "token", "n"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.int64()]

    def run(batches):
        p = unpack(model["flat"], v)
        known = Table(words, counts, vocabulary)
        # the log-count of a table place; place -1 (rare) is settled by the join
        logs = np.append(np.log10(known.counts + 1.0), 0.0)
        outside = np.ones(len(logs))
        outside[: known.own] = outside[-1] = 0
        key = TaskContext.get().partitionId() << 33
        pool: list[np.ndarray] = []
        rows: list[tuple] = []
        rare: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        held = 0

        def flush():
            scores = score_texts(p, pool) / LOG10
            out = [(*r[:5], r[5] + s, r[6], None, None) for r, s in zip(rows, scores.tolist(), strict=True)]
            for i in range(0, len(out), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 50_000], strict=True), kinds, strict=True)], names)
            for key_of, token, n in rare:
                for i in range(0, len(key_of), 50_000):
                    own = key_of[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own), *[pa.nulls(len(own), t) for t in kinds[1:7]], token[i : i + 50_000], pa.array(n[i : i + 50_000])], names
                    )
            for x in (pool, rows, rare):
                x.clear()

        for batch in batches:
            for part in slices(batch, 1):
                words_of, n_words = tokens(part.column(1))
                places = known.places(words_of)
                edges = np.cumsum([0, *n_words]).tolist()
                strange = np.flatnonzero(places < 0)
                if len(strange):
                    # each document's rare tokens and how often it holds them
                    coded = words_of.take(pa.array(strange)).dictionary_encode()
                    kind = len(coded.dictionary)
                    pairs, often = np.unique((np.searchsorted(edges, strange, side="right") - 1) * kind + coded.indices.to_numpy(), return_counts=True)
                    rare.append((key + pairs // kind, coded.dictionary.take(pa.array(pairs % kind)), often))
                for doc, first, last in zip(part.column(0).to_pylist(), edges, edges[1:], strict=False):
                    at, n = places[first:last], last - first
                    n_rare = int((at < 0).sum())
                    log_count, n_out = float(logs[at].sum()), float(outside[at].sum())
                    out_log = float((logs[at] * outside[at]).sum())
                    rows.append(
                        (
                            key, doc, n + 1, n - n_rare + (n_end > 0),
                            log_count + math.log10(n_end + 1) - base_log * (n + 1), out_log - rest_log * n_out, n_rare,
                        )
                    )
                    pool.append(np.append(known.model_ids(at), END).astype(np.int32))
                    key += 1
                    held += n
                    if held >= POOL_TOKENS:
                        yield from flush()
                        held = 0
        if rows:
            yield from flush()

    return run


def frequent_tokens(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """The most frequent tokens (the end aside) by count and then by token: as
    many as whole ranges of counts allow within ``most``. The ranges (64 to a
    doubling) are counted first, so only chosen tokens leave their tasks."""
    kinds = counts.where(F.octet_length("token") > 0)
    step = F.floor(F.log2("c") * 64).cast("int")
    left, least = most, None
    for r in sorted(kinds.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["step"]):
        if r["n"] > left:
            break
        left, least = left - r["n"], r["step"]
    if least is None:
        return [], np.zeros(0, dtype=np.int64)
    top = sorted((-r["c"], bytes(r["token"])) for r in kinds.where(step >= least).collect())
    return [w for _, w in top], np.array([-n for n, _ in top], dtype=np.int64)


def deal(training: DataFrame, n_docs: int, share: float = SHARE, rounds: int = ROUNDS) -> tuple[DataFrame, int]:
    """(text, turn, shard) of the training documents, stored, and the number
    of turns. The row number keeps copies of a row or text apart."""
    shards = max(1, -(-int(n_docs * share) // SHARD_DOCS))
    turns = max(rounds, math.ceil(math.log2(shards))) if n_docs else 0
    rows = training.withColumn("row", F.monotonically_increasing_id())
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(10_000)) < int(share * 10_000))
    salted = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "doc_id", "text", "row"), F.lit(n)).cast("int")
    dealt = rows.select("text", salted(11, max(1, turns)).alias("turn"), salted(12, max(1, -(-shards // max(1, turns)))).alias("shard"))
    return freeze(dealt, "dealt"), turns


def fit(training: DataFrame, counts: DataFrame, vocabulary: int = VOCABULARY, frequent: int = FREQUENT, share: float = SHARE, rounds: int = ROUNDS) -> dict:
    """Counts, tables and trained parameters that scoring needs."""
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.octet_length("token") == 0, F.col("c"))).alias("e")).first()
    n, kinds, n_end = int(whole["n"] or 0), int(whole["v"]), int(whole["e"] or 0)
    words, c = frequent_tokens(counts, frequent)
    own = min(len(words), vocabulary - 2)
    n_out, kinds_out = n - n_end - int(c[:own].sum()), kinds - own - (n_end > 0)
    weights = np.concatenate([[n_out + 1, n_end], c[:own]]).astype(float)
    v = len(weights)
    flat = pack(initial(weights))
    dealt, rounds = deal(training, n_end, share, rounds)
    for turn in range(rounds):
        own_turn = dealt.where(F.col("turn") == turn).select("shard", "text")
        trained = own_turn.groupBy("shard").applyInArrow(_train_shard(v, flat, words[:own], c[:own], vocabulary), SUMMED)
        mean = mean_parameters(trained, max(1, n_end // SHARD_DOCS // max(1, rounds)))
        if mean is not None:  # no document fell into this turn
            flat = mean
    return {
        "v": v, "flat": flat.astype(np.float32), "words": words, "counts": c, "vocabulary": vocabulary, "n": n, "n_end": n_end,
        "base_log": math.log10(n + kinds + 1), "rest_log": math.log10(n_out + kinds_out + 1),
    }


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    training = own.where(crc_remainder("doc_id", MODULUS) != HELD_OUT)
    counts = freeze(token_counts(training), "token_counts")
    model = fit(training, counts, **options)
    schema = "key long, doc_id long, n_tokens long, n_known long, base double, score double, n_rare long, token binary, n long"
    both = freeze(own.mapInArrow(_score_rows(model), schema), "scored")
    rows = both.where("token is null").drop("token", "n")
    rare = both.where("token is not null").select("key", "token", "n").join(counts, "token", "left")
    seen = rare.groupBy("key").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("logs"), F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("known")
    )
    done = rows.join(seen, "key", "left").withColumn("logs", F.coalesce("logs", F.lit(0.0)))
    return done.select(
        "doc_id",
        (crc_remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("logs")).alias("base_score"),
        (F.col("score") + F.col("logs") - F.col("n_rare") * F.lit(model["rest_log"])).alias("score"),
    )
