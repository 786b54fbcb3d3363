"""Exact repeated-passage removal by distributed prefix doubling.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else (in this or another document) is removed. Positions are ranked by the
bytes that follow them, and only the equality of ranks matters, so a rank is a
fingerprint. Rounds at growing offsets drop the positions that are unique:

1. Rank at the first of ``GRAMS`` bytes. Only anchors are ranked: the anchor of
   a string of ``length`` bytes is the position in it whose gram has the
   smallest fingerprint, a choice that depends on the string alone, so equal
   strings have their anchors at equal places. A string whose anchor has a
   unique rank is unique. The strings left are ranked again at the next,
   doubled, gram.
2. Rank at longer spans: the runs of surviving positions with one anchor, with
   all the bytes that their strings cover. A run whose rank repeats is settled
   (all its strings repeat); one copy of it stays in play.
3. Rank at ``length`` bytes: the surviving positions of the runs still in play.
   Those whose rank repeats start a repeated string.

Equal texts are one text that repeats as a whole. Ranks are counted with
pre-aggregation, so a passage that many documents share makes no hot group.
Fingerprints have 64 bits in round 1 (where a collision only costs time), 128
in round 2 and 96 in round 3.

Defined results: null counts as the empty text; texts shorter than ``length``
keep all bytes; repeated rows are equal texts; null ids are passed on; other
columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import _BYTE, BASE_A, BASE_B, U64, checked, freeze, mix, pieces, powers, prefix_hash, span_hash, text_bytes

LENGTH = 400
GRAMS = (144, 288)
CHUNK = 1 << 19
_TOP = U64(0xFFFFFFFFFFFFFFFF)
#: Low bits that hold a place within a chunk (CHUNK plus a window fits).
_PLACE = U64((1 << 20) - 1)
_BYTE2 = mix(_BYTE ^ U64(0x5851F42D4C957F2D))


def gram_hashes(raw: np.ndarray, gram: int, table: np.ndarray = _BYTE, base: int = BASE_A) -> np.ndarray:
    """Fingerprint of the ``gram`` bytes at every position that has them."""
    prefix = prefix_hash(table[raw], base)
    n = len(raw) - gram + 1
    return mix((prefix[gram:] - prefix[:n]) * powers(base, n)[1])


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of w values (block prefixes and suffixes)."""
    n = len(x)
    y = np.full(-(-n // w) * w, _TOP, dtype=U64)
    y[:n] = x
    y = y.reshape(-1, w)
    before = np.minimum.accumulate(y, axis=1).ravel()
    after = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - w + 1], before[w - 1 : n])


def anchors(raw: np.ndarray, length: int = LENGTH, gram: int = GRAMS[0]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, rank, lo, hi) of a text's anchors, chunk by chunk.

    The strings that start at lo..hi have their smallest gram at ``place``
    (the leftmost among equals); ``rank`` is its fingerprint.
    """
    n = len(raw)
    parts: list[list[np.ndarray]] = [[], [], [], []]
    for s in range(0, n - length + 1, CHUNK):
        e = min(n - length + 1, s + CHUNK)
        h = gram_hashes(raw[s : e - 1 + length], gram)
        key = (h & ~_PLACE) | np.arange(len(h), dtype=U64)
        place = (_window_min(key, length - gram + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [len(place)]]) - 1
        for x, y in zip(parts, (place[first] + s, h[place[first]], first + s, last + s), strict=True):
            x.append(y)
    if not parts[0]:
        return (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64), *[np.zeros(0, dtype=np.int64)] * 2)
    return tuple(np.concatenate(x) for x in parts)


def _digest(data: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def live_starts(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of n starts lie in one of the ranges lo..hi."""
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, lo, 1)
    np.add.at(change, hi + 1, -1)
    return np.cumsum(change[:-1]) > 0


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The lists of a column; null is an empty one."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.split(column.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)[:-1])


def survivors(n: int, ranges: list[np.ndarray]) -> np.ndarray:
    """Which of n starts every round kept; ``ranges`` holds the first and the
    last starts of the kept anchors, round by round."""
    left = np.ones(n, dtype=bool)
    for lo, hi in zip(ranges[::2], ranges[1::2], strict=True):
        left &= live_starts(n, lo, hi)
    return left


def _anchor_batch(owner: str, rows: list[tuple]) -> pa.RecordBatch:
    """(owner, lo, hi, rank) of the anchors of some texts."""
    name = np.concatenate([np.full(len(p), x, dtype=np.int64) for x, p, *_ in rows])
    rank, lo, hi = (np.concatenate([r[i] for r in rows]) for i in range(2, 5))
    columns = [pa.array(name), *[pa.array(c.astype(np.int32)) for c in (lo, hi)], pa.array(rank.view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, [owner, "lo", "hi", "rank"])


def _first_round(length: int, gram: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                texts = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
                yield _anchor_batch("a", [(x, *anchors(np.frombuffer(t, dtype=np.uint8), length, gram)) for x, t in texts])

    return run


def _next_round(length: int, gram: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, 64):
                rows = []
                for x, t, *ranges in zip(*[c.to_pylist() for c in part.columns[:2]], *map(_lists, part.columns[2:]), strict=True):
                    left = np.concatenate([[0], np.cumsum(survivors(len(t) - length + 1, ranges))])
                    found = anchors(np.frombuffer(t, dtype=np.uint8), length, gram)
                    use = left[found[3] + 1] > left[found[2]]
                    rows.append((x, *[c[use] for c in found]))
                yield _anchor_batch("key", rows)

    return run


def runs(n: int, ranges: list[np.ndarray]) -> list[tuple[int, int]]:
    """(first, last) of the runs of surviving starts, cut where the first
    round's anchor changes."""
    left = survivors(n, ranges)
    edge = np.zeros(n + 1, dtype=bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = left[1:] != left[:-1]
    edge[ranges[0]] = True
    cut = np.flatnonzero(edge)
    return [(a, b - 1) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) if left[a]]


def _run_rows(length: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, 64):
                rows = []
                for x, t, *ranges in zip(*[c.to_pylist() for c in part.columns[:2]], *map(_lists, part.columns[2:]), strict=True):
                    rows += [(x, lo, hi, *_digest(t[lo : hi + length])) for lo, hi in runs(len(t) - length + 1, ranges)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["key", "lo", "hi", "r1", "r2"])

    return run


def _strings(sections: list[tuple], length: int) -> pa.RecordBatch:
    """(key, at, settled, r1, r2) of the strings of ``length`` bytes that start
    in the ranges of some sections (key, bytes, place in the text, lo, hi, settled)."""
    keys, bodies, first, *ranges = zip(*sections, strict=True)
    raw = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    n = [len(x) for x in ranges[0]]
    before = np.repeat(np.cumsum([0, *map(len, bodies)])[:-1], n)
    lo, hi, settled = map(np.concatenate, ranges)
    many = hi - lo + 1
    start = np.repeat(lo + before - (np.cumsum(many) - many), many) + np.arange(many.sum())
    r1, r2 = (mix(span_hash(prefix_hash(t[raw], b), start, start + length, b)) for t, b in ((_BYTE, BASE_A), (_BYTE2, BASE_B)))
    at = start - np.repeat(before - np.repeat(first, n), many)
    columns = [np.repeat(np.repeat(np.array(keys, dtype=np.int64), n), many), at.astype(np.int32), np.repeat(settled, many), r1.view(np.int64)]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array((r2 >> U64(32)).astype(np.uint32).view(np.int32))], ["key", "at", "settled", "r1", "r2"])


def _string_rows(length: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, 64):
                held: list[tuple] = []
                size = 0
                for x, t, lo, hi, known in zip(*[c.to_pylist() for c in part.columns[:2]], *map(_lists, part.columns[2:]), strict=True):
                    for s in range(0, len(t) - length + 1, CHUNK):
                        own = (lo < s + CHUNK) & (hi >= s)
                        if not own.any():
                            continue
                        body = t[s : s + CHUNK - 1 + length]
                        if held and size + len(body) > CHUNK:
                            yield _strings(held, length)
                            held, size = [], 0
                        held.append((x, body, s, np.maximum(lo[own] - s, 0), np.minimum(hi[own] - s, CHUNK - 1), known[own]))
                        size += len(body)
                if held:
                    yield _strings(held, length)

    return run


def _removal_rows(length: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, 32):
                rows = []
                for x, y, t, los, his, singles in zip(*[c.to_pylist() for c in part.columns[:3]], *map(_lists, part.columns[3:]), strict=True):
                    lo = np.concatenate([los, singles])
                    hi = np.concatenate([his, singles]) + length - 1
                    gone = live_starts(len(t), lo, hi)
                    starts = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1]]))
                    ends = np.flatnonzero(gone & ~np.concatenate([gone[1:], [False]])) + 1
                    kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
                    rows.append((x, y, int(gone.sum()), len(starts), hashlib.sha256(kept).hexdigest(), starts.tolist(), ends.tolist()))
                if rows:
                    kinds = [*[pa.int64()] * 4, pa.string(), *[pa.list_(pa.int64())] * 2]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["a", "b", "n_removed", "n_spans", "kept_sha256", "span_starts", "span_ends"]
                    )

    return run


def _repeated(ranked: DataFrame, owner: str) -> DataFrame:
    """(owner, alive): the ranges of starts whose anchor's rank stands at two
    places or more (a place that a chunk's end cuts counts as two, which only
    keeps more starts in play). The repeated ranks are stored before the join, so that Spark
    can split the partition of a rank that very many places share."""
    where = F.xxhash64(owner, "lo")
    twice = ranked.groupBy("rank").agg(F.min(where).alias("p"), F.max(where).alias("q")).where("p <> q").select("rank")
    kept = ranked.join(freeze(twice, "ranks"), "rank", "left_semi")
    return kept.groupBy(owner).agg(F.collect_set(F.struct("lo", "hi")).alias("alive"))


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, grams: tuple[int, ...] = GRAMS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans
    (starts and ends, in bytes) of every document."""
    body = text_bytes(text)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("a"), F.xxhash64(F.lit(7), body).alias("b"), body.alias("text"))
    long_enough = own.where(F.octet_length("text") >= length)
    # the first round ranks all texts; a text is named by 64 bits here, and two
    # texts of one name would only keep more starts in play
    ranked = freeze(long_enough.select("a", "text").mapInArrow(_first_round(length, grams[0]), "a long, lo int, hi int, rank long"), "anchors")
    alive = freeze(_repeated(ranked, "a").withColumnsRenamed({"alive": "alive0"}), "alive")
    some = long_enough.select("a", "b", "text").join(checked(alive.select("a"), 16), "a", "left_semi").dropDuplicates(["a", "b"])
    texts = some.join(alive, "a").withColumn("key", F.monotonically_increasing_id())
    texts = freeze(texts.select("key", "a", "b", "text", "alive0"), "texts")
    # further rounds rank what is left
    ranges = [F.col("alive0.lo").alias("lo0"), F.col("alive0.hi").alias("hi0")]
    for k in range(1, len(grams)):
        ranked = texts.select("key", "text", *ranges).mapInArrow(_next_round(length, grams[k]), "key long, lo int, hi int, rank long")
        alive = _repeated(freeze(ranked, "anchors"), "key").withColumnsRenamed({"alive": f"alive{k}"})
        ranges += [F.col(f"alive{k}.lo").alias(f"lo{k}"), F.col(f"alive{k}.hi").alias(f"hi{k}")]
        texts = freeze(texts.join(alive, "key"), "texts")
    # runs of surviving starts
    spans = freeze(texts.select("key", "text", *ranges).mapInArrow(_run_rows(length), "key long, lo long, hi long, r1 long, r2 long"), "runs")
    place = F.struct("key", "lo")
    counted = spans.groupBy("r1", "r2").agg(F.min(place).alias("p"), F.max(place).alias("q"))
    counted = counted.select("r1", "r2", (F.col("p") != F.col("q")).alias("settled"), "p")
    spans = freeze(spans.join(counted, ["r1", "r2"]).select("key", "lo", "hi", "settled", (place == F.col("p")).alias("first")), "ranked_runs")
    # single strings of the runs in play: those of settled runs count twice,
    # and need no answer themselves
    play = spans.where("first").groupBy("key").agg(F.collect_list(F.struct("lo", "hi", "settled")).alias("r"))
    strings = (
        texts.select("key", "text")
        .join(play, "key")
        .select("key", "text", "r.lo", "r.hi", "r.settled")
        .mapInArrow(_string_rows(length), "key long, at int, settled boolean, r1 long, r2 int")
    )
    twice = strings.groupBy("r1", "r2").agg(F.sum(F.when(F.col("settled"), 2).otherwise(1)).alias("n")).where("n > 1").select("r1", "r2")
    singles = strings.where("not settled").join(twice, ["r1", "r2"], "left_semi").groupBy("key").agg(F.collect_list("at").alias("singles"))
    settled = spans.where("settled").groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("r"))
    marks = settled.join(freeze(singles, "singles"), "key", "full_outer")
    removed = (
        texts.select("key", "a", "b", "text")
        .join(marks, "key")
        .select("a", "b", "text", "r.lo", "r.hi", "singles")
        .mapInArrow(_removal_rows(length), "a long, b long, n_removed long, n_spans long, kept_sha256 string, span_starts array<long>, span_ends array<long>")
    )
    removed = freeze(removed, "removed").select(F.col("a").alias("x"), F.col("b").alias("y"), "n_removed", "n_spans", "kept_sha256", "span_starts", "span_ends")
    copies = long_enough.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("a").alias("u"), F.col("b").alias("v"))
    rows = own.select("doc_id", "a", "b", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    rows = rows.join(freeze(copies, "copies"), (F.col("a") == F.col("u")) & (F.col("b") == F.col("v")), "left")
    rows = rows.join(removed, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left")
    copy = F.col("u").isNotNull()
    none = F.array().cast("array<long>")
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
        F.when(copy, F.array(F.lit(0).cast("long"))).otherwise(F.coalesce("span_starts", none)).alias("span_starts"),
        F.when(copy, F.array("n_bytes")).otherwise(F.coalesce("span_ends", none)).alias("span_ends"),
    )
