"""Toxic-passage scoring by maximum-scoring segments.

Training (labelled documents of the learning part only, equal texts once):
Spark counts the toxic and the clean documents that hold a word or a word's
opening of four to six letters; its weight is the difference of the log-odds
under a Dirichlet prior proportional to its overall frequency, kept where it
exceeds its standard error ``MIN_Z`` times. A word takes the weight of its
longest piece that has one; every word costs ``DRIFT``, so that chance passages
lose. A document's significant passages are
its maximal scoring segments (Ruzzo and Tompa, linear time) whose E-value stays
under ``MAX_E``: with the Karlin-Altschul parameters lambda and K of the clean
documents, a segment of score S in n words has E = K n exp(-lambda S). A
document's evidence is its best segment's lambda S - ln K and -ln E, and the
summed lambda S - ln K of its significant segments; a logistic curve fitted to
the labels turns them into a probability.

Bounds: the model is fitted on ``max_labelled`` labelled documents or all, if
fewer (smallest id hashes, so about as many), a parameter. Every significant
weight is kept; they are words of toxic documents of that sample alone. Scoring
covers every word of every document.

Defined results: null and empty texts have no segment and get the curve's
value for no evidence; null labels are not learnt from; with no label of one
class at all every document gets the share of the toxic class (0 without
labels); repeated rows are scored each; other columns play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import checked, crc_remainder, freeze, pieces

MAX_LABELLED = 20_000
MIN_Z = 4.0
MIN_WEIGHT = 1.0
OPENINGS = (6, 5, 4)
DRIFT = 0.15
MAX_E = 1.0
PRIOR = 50.0
HOLD_OUT = 5
_WORD = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score), in order.

    Candidates are kept on a stack with the cumulative scores before and after
    each; ``back`` points to the nearest earlier candidate that starts lower.
    """
    lo: list[float] = []
    hi: list[float] = []
    span: list[list[int]] = []
    back: list[int] = []
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        left, right, first = before, total, i
        while True:
            j = len(lo) - 1
            while j >= 0 and lo[j] >= left:
                j = back[j]
            if j < 0 or hi[j] >= right:
                break
            left, first = lo[j], span[j][0]
            del lo[j:], hi[j:], span[j:], back[j:]
        lo.append(left)
        hi.append(right)
        span.append([first, i + 1])
        back.append(j)
    return [(a, b, h - x) for (a, b), x, h in zip(span, lo, hi, strict=True)]


def word_segments(words: list[str], seen: Weights, drift: float) -> list[tuple[int, int, float]]:
    """Maximal segments of a text. A run of words without a weight is one item
    of the scan, so the scan is as long as the weighted words are many."""
    at = [(i, w) for i, w in enumerate(map(seen.__getitem__, words)) if w is not None]
    scores: list[float] = []
    where: list[int] = []
    last = 0
    for i, w in at:
        if i > last:
            scores.append(-drift * (i - last))
            where.append(last)
        scores.append(w - drift)
        where.append(i)
        last = i + 1
    where.append(last)
    return [(where[a], where[b], s) for a, b, s in segments(scores)]


def pieces_of(word: str) -> list[str]:
    """A word and its openings, longest first: what may carry a weight."""
    return [word, *[word[:n] + "-" for n in OPENINGS if len(word) > n]]


def weight_of(word: str, weights: dict[str, float]) -> float | None:
    """The weight of the longest of the word's pieces that has one."""
    for piece in pieces_of(word):
        w = weights.get(piece)
        if w is not None:
            return w
    return None


class Weights(dict):
    """Weights of the words seen so far by a task; emptied when it is large."""

    def __init__(self, weights: dict[str, float], bound: int = 300_000):
        super().__init__()
        self.weights, self.bound = weights, bound

    def __missing__(self, word: str) -> float | None:
        if len(self) >= self.bound:
            self.clear()
        w = self[word] = weight_of(word, self.weights)
        return w


def _evidence(words: list[str], model: dict, seen: Weights) -> tuple[float, float, float, list[tuple[int, int, float]]]:
    """(best normalised score, best -ln E, summed normalised score of the
    significant segments, these segments)."""
    lam, log_k = model["lambda"], model["log_k"]
    log_n = math.log(max(1, len(words)))
    found, best, total = [], 0.0, 0.0
    for a, b, s in word_segments(words, seen, model["drift"]):
        score = lam * s - log_k
        best = max(best, score)
        if score - log_n > -math.log(MAX_E):
            found.append((a, b, s))
            total += score
    return best, best - log_n if best else -log_n, total, found


def _features(best: float, minus_log_e: float, total: float) -> list[float]:
    return [1.0, math.log1p(best), max(-12.0, min(20.0, minus_log_e)) / 5, math.log1p(total), float(best > 0)]


def _counts(batches):
    toxic: Counter = Counter()
    clean: Counter = Counter()

    def out():
        for label, c in ((1, toxic), (0, clean)):
            if c:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c.keys()), pa.string()), pa.array([label] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())], ["word", "toxic", "n"]
                )
                c.clear()

    for batch in batches:
        for part in pieces(batch):
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                (toxic if label else clean).update({p for w in set(tokens(text)) for p in pieces_of(w)})
            if len(toxic) + len(clean) > 400_000:
                yield from out()
    yield from out()


def _gumbel(best: list[float], words: list[int], lam: float) -> float:
    """ln K by the mean of the largest segment scores (Gumbel mean is 0.5772)."""
    if not best:
        return 0.0
    return float(np.mean(np.array(best) * lam - np.log(np.maximum(words, 1)))) - 0.5772


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1]) * ridge
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + penalty @ w
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        d = np.linalg.solve(h, g)
        w = w - np.clip(d, -5, 5)
        if np.abs(d).max() < 1e-8:
            break
    return w


def labelled_part(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, max_labelled: int) -> DataFrame:
    """(text, toxic) of the labelled documents of the learning part."""
    usable = (
        labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("__id").isNotNull())
        .where(crc_remainder("__id", HOLD_OUT) != 0)
        .groupBy("__id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # by the id's hash, so that no task sends its rows to one place
    share = min(1.0, max_labelled / max(1, usable.count()))
    near = F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int(share * (1 << 30))
    chosen = checked(freeze(usable.where(near), "labelled"), 24)
    own = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"))
    texts = own.join(chosen, "__id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    return freeze(texts, "labelled_texts")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_labelled: int = MAX_LABELLED) -> dict:
    """The model: word weights, Karlin-Altschul parameters, logistic curve."""
    part = labelled_part(docs, labels, doc_id, text, label, max_labelled)
    counts = part.mapInArrow(_counts, "word string, toxic int, n long")
    table = freeze(
        counts.groupBy("word").agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"),
        ),
        "word_counts",
    )
    model: dict = {"weights": {}, "drift": DRIFT, "lambda": 1.0, "log_k": 0.0, "curve": None, "share": 0.0}
    sizes = {int(r["toxic"]): int(r["n"]) for r in part.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_t, n_c = sizes.get(1, 0), sizes.get(0, 0)
    if n_t + n_c:
        model["share"] = n_t / (n_t + n_c)
    if not n_t or not n_c:
        return model
    alpha = PRIOR * (F.col("t") + F.col("c")) / (n_t + n_c)
    odds = lambda y, n: F.log((F.col(y) + alpha) / (F.lit(n + PRIOR) - F.col(y) - alpha + 1))
    delta = odds("t", n_t) - odds("c", n_c)
    error = F.sqrt(1 / (F.col("t") + alpha) + 1 / (F.col("c") + alpha))
    kept = (
        table.select("word", "c", delta.alias("weight"), (delta / error).alias("z"))
        .where((F.col("z") >= MIN_Z) & (F.col("weight") >= MIN_WEIGHT))
        .orderBy(F.col("z").desc(), "word")
        .collect()
    )
    if not kept:
        return model
    weights = model["weights"] = {r["word"]: float(r["weight"]) for r in kept}
    # lambda: the positive root of sum p(s) exp(lambda s) = 1 under clean text
    n_words = max(1, part.where("toxic = 0").agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 1)
    p = np.array([(r["c"] + 0.5) / n_words for r in kept])
    s = np.array([float(r["weight"]) for r in kept]) - DRIFT
    rest, low, high = max(0.0, 1 - p.sum()), 1e-3, 20.0
    f = lambda x: float(np.sum(p * np.exp(np.clip(x * s, -50, 50))) + rest * math.exp(-x * DRIFT)) - 1
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    model["lambda"] = (low + high) / 2
    draws = [r for r in part.mapInArrow(_best_of(model), "toxic int, best double, n long").collect() if not r["toxic"] and r["best"] > 0]
    model["log_k"] = _gumbel([r["best"] for r in draws], [r["n"] for r in draws], model["lambda"])
    shown = part.mapInArrow(_evidence_of(model), "toxic int, best double, e double, total double").collect()
    x = np.array([_features(r["best"], r["e"], r["total"]) for r in shown])
    model["curve"] = _logistic(x, np.array([float(r["toxic"] > 0) for r in shown])).tolist()
    return model


def _best_of(model: dict):
    def run(batches):
        seen = Weights(model["weights"])
        for batch in batches:
            for part in pieces(batch):
                words = [tokens(t) for t in part.column(0).to_pylist()]
                best = [max((s for *_, s in word_segments(w, seen, model["drift"])), default=0.0) for w in words]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(best, pa.float64()), pa.array([len(w) for w in words], pa.int64())], ["toxic", "best", "n"])

    return run


def _evidence_of(model: dict):
    def run(batches):
        seen = Weights(model["weights"])
        for batch in batches:
            for part in pieces(batch):
                got = [_evidence(tokens(t), model, seen) for t in part.column(0).to_pylist()]
                columns = [pa.array([g[i] for g in got], pa.float64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays([part.column(1), *columns], ["toxic", "best", "e", "total"])

    return run


def probability(words: list[str], model: dict, seen: Weights) -> tuple[float, list[tuple[int, int, float]]]:
    if model["curve"] is None:
        return model["share"], []
    best, e, total, found = _evidence(words, model, seen)
    z = sum(a * b for a, b in zip(model["curve"], _features(best, e, total), strict=True))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), found


SCORED = "score double, predicted int, n_words long, n_segments int, segment_starts array<int>, segment_ends array<int>"


def _score(model: dict, text_at: int, names: list[str]):
    def run(batches):
        seen = Weights(model["weights"])
        for batch in batches:
            for part in pieces(batch):
                score, n, starts, ends = [], [], [], []
                for t in part.column(text_at).to_pylist():
                    w = tokens(t)
                    p, found = probability(w, model, seen)
                    score.append(p)
                    n.append(len(w))
                    starts.append([a for a, _, _ in found])
                    ends.append([b for _, b, _ in found])
                more = [
                    pa.array(score, pa.float64()),
                    pa.array([int(p >= 0.5) for p in score], pa.int32()),
                    pa.array(n, pa.int64()),
                    pa.array([len(x) for x in starts], pa.int32()),
                    pa.array(starts, pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:text_at], *part.columns[text_at + 1 :], *more], names)

    return run


def score(docs: DataFrame, model: dict, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of every document with its score, prediction and
    significant passages (word positions)."""
    rows = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
    kept = ", ".join(f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.select(*[F.col(f"`{c}`") for c in keep]).schema.fields))
    names = [*[f"k{i}" for i in range(len(keep))], "score", "predicted", "n_words", "n_segments", "segment_starts", "segment_ends"]
    done = rows.mapInArrow(_score(model, len(keep), names), f"{kept}, {SCORED}" if kept else SCORED)
    return done.toDF(*keep, *names[len(keep) :])


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", **bounds) -> DataFrame:
    """doc_id, held_out and the score of every document."""
    model = fit(docs, labels, doc_id, text, label, **bounds)
    done = score(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model, ["doc_id"])
    return done.select("doc_id", (crc_remainder("doc_id", HOLD_OUT) == 0).alias("held_out"), "score", "predicted", "n_words", "n_segments")


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = 0.5, **bounds) -> DataFrame:
    """``docs`` without the documents whose score reaches ``threshold``."""
    model = fit(docs, labels, doc_id, text, label, **bounds)

    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = names.index(text)

    def keep(batches):
        seen = Weights(model["weights"])
        for batch in batches:
            for part in pieces(batch):
                ok = [probability(tokens(t), model, seen)[0] < threshold for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(ok, pa.bool_()))

    return inner.mapInArrow(keep, inner.schema).toDF(*names)
