"""SimHash classes by a grid of segment bit counts.

A text's fingerprint is the bitwise majority of the XXH64 values (seed 42) of
its four-word shingles. Fingerprints of at most ``distance`` differing bits are
linked; classes are the connected components.

A fingerprint is cut into segments of ``SEGMENT`` bits and mapped to the vector
of their bit counts. One differing bit changes one count by one, so the
Manhattan distance of two vectors is a lower bound of the differing bits. The
segments form distance // 2 + 1 parts; two vectors within ``distance`` are
within one step in at least one part. So the join is a range join on a grid of
each part's counts: a fingerprint lies in its own cell and visits the cells one
step up along each axis; any pair within one step meets in a cell. Pairs that
meet are compared exactly, bit by bit.

Large groups: equal fingerprints are one node. A cell of over ``BLOCK`` rows is
dealt as pairs of blocks, each a group of its own; a task returns a spanning
forest of the links in a block, never all its pairs. A link left out joins two
nodes that the forest joins, so no component loses any.

Defined results: null counts as empty; a text without words has fingerprint
zero, which is linked like any other; a text of under four words is one
shingle; repeated rows are kept each; a row without an id takes part in links,
but a class is named by its smallest id (null if it has none); other columns
play no part.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import U64, freeze, pieces, text_bytes
from shiplog.llm.order_minhash import components

WORDS = 4
SEED = 42
DISTANCE = 4
SEGMENT = 2
BLOCK = 4096
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 16


def shingles(text: bytes, k: int = WORDS) -> list[bytes]:
    """All runs of ``k`` words (fewer words: one run), joined by spaces. Words
    are what white space of ASCII separates, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return []
    k = min(k, len(words))
    joined = b" ".join(words)
    ends = [n - 1 for n in accumulate(len(w) + 1 for w in words)]
    starts = [0, *[e + 1 for e in ends]]
    return [joined[s:e] for s, e in zip(starts, ends[k - 1 :], strict=False)]


def fingerprint(text: bytes) -> int:
    """Bits set in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest

    own = shingles(text)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(own), CHUNK):
        part = own[i : i + CHUNK]
        h = np.fromiter((xxh64_intdigest(s, SEED) for s in part), dtype="<u8", count=len(part))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(own), bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        for part in pieces(batch):
            prints = np.array([fingerprint(t) for t in part.column(1).to_pylist()], dtype=U64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints)], ["doc_id", "print"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, print) of every document; the fingerprint as a signed long."""
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), text_bytes(docs[text]).alias("text"))
    return own.mapInArrow(_fingerprints, "doc_id long, print long")


def embedding(prints: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Bit counts of the segments of every fingerprint."""
    bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(prints), 64 // segment, segment).sum(axis=2, dtype=np.int64)


def cells(prints: np.ndarray, distance: int = DISTANCE, segment: int = SEGMENT):
    """(cell, fingerprint, visits) rows: every fingerprint at home in its cell of
    each part's grid, and as a visitor in the cells one step up."""
    counts = embedding(prints, segment)
    for number, axes in enumerate(np.array_split(np.arange(counts.shape[1]), distance // 2 + 1)):
        own = counts[:, axes]
        weight = (segment + 1) ** np.arange(len(axes), dtype=np.int64)
        home = (own @ weight) * 64 + number
        yield home, prints, False
        for axis in range(len(axes)):
            up = own[:, axis] < segment
            yield home[up] + weight[axis] * 64, prints[up], True


def _cells(distance: int, segment: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, 8192):
                for cell, prints, visits in cells(part.column(0).to_numpy(), distance, segment):
                    columns = [pa.array(cell), pa.array(prints), pa.array(np.full(len(cell), visits))]
                    yield pa.RecordBatch.from_arrays(columns, ["cell", "print", "visits"])

    return run


def forest(home: np.ndarray, others: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """A spanning forest of the links of ``home`` with ``others``."""
    a, b = np.unique(home), np.unique(others)
    nodes = np.unique(np.concatenate([a, b]))
    label = np.arange(len(nodes))
    at_a, at_b = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    links = []
    for x, i in zip(a, at_a.tolist(), strict=True):
        near = at_b[np.bitwise_count(x ^ b) <= distance]
        named = label[near]
        found, first = np.unique(named, return_index=True)
        for name, k in zip(found.tolist(), near[first].tolist(), strict=True):
            if name != label[i]:
                links.append((int(x), int(nodes[k])))
        if len(found) and (len(found) > 1 or found[0] != label[i]):
            label[np.isin(label, found)] = label[i]
    return links


#: Sides of a row in its group: at home (met by all), visitor, asking only.
HOME, VISITOR, ASKS = 0, 1, 2


def _links(distance: int):
    """Over rows sorted by (cell, i, j): a spanning forest of each group."""

    def settle(side: np.ndarray, prints: np.ndarray):
        home, others = prints[side != VISITOR], prints[side != ASKS]
        return forest(home, others, distance) if len(home) and len(others) else []

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        last, links = None, []

        def out():
            x, y = zip(*links, strict=True) if links else ((), ())
            links.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)])
            side, prints = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                key = keys[:, s].tolist()
                if held and key != last:
                    links += settle(*map(np.concatenate, zip(*held, strict=True)))
                    held = []
                last = key
                held.append((side[s:e], prints[s:e]))
            if len(links) > 10_000:
                yield out()
        if held:
            links += settle(*map(np.concatenate, zip(*held, strict=True)))
        yield out()

    return run


def links(nodes: DataFrame, distance: int = DISTANCE, segment: int = SEGMENT) -> DataFrame:
    """(x, y): links of the distinct fingerprints ``nodes`` (print) that join
    the same components as all links of at most ``distance`` bits."""
    rows = nodes.select("print").mapInArrow(_cells(distance, segment), "cell long, print long, visits boolean")
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("visits").alias("v"))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    hot = sizes.where(F.col("n") > BLOCK)
    hot = freeze(hot.select("cell", blocks(F.col("n") - F.col("v")).alias("homes"), F.greatest(blocks(F.col("v")), F.lit(1)).alias("visitors")), "hot")
    # a cell without a home row holds no pair
    dealt = rows.join(hot, "cell", "left").where("homes is null or homes > 0")
    place = F.pmod(F.xxhash64("print"), F.when(F.col("visits"), F.col("visitors")).otherwise(F.col("homes"))).cast("int")
    every = lambda low, high: F.sequence(low, high)
    own, none = F.col("homes"), F.lit(None).cast("int")
    # group (i, j): block i of the home rows asks block j, which is one of the
    # home rows (j >= i) or, after those, one of the visitors
    met = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    asks = F.transform(every(F.col("p"), own + F.col("visitors") - 1), lambda j: met(F.col("p"), j, ASKS))
    answers = F.transform(every(F.lit(0), F.col("p")), lambda i: met(i, F.col("p"), VISITOR))
    visits = F.transform(every(F.lit(0), own - 1), lambda i: met(i, own + F.col("p"), VISITOR))
    split = F.when(F.col("visits"), visits).otherwise(F.concat(asks, answers))
    whole = F.when(F.col("visits"), F.array(met(F.lit(0), F.lit(0), VISITOR))).otherwise(F.array(met(F.lit(0), F.lit(0), HOME)))
    groups = dealt.withColumn("p", F.coalesce(place, none)).withColumn("m", F.explode(F.when(own.isNull(), whole).otherwise(split)))
    groups = groups.select("cell", "m.i", "m.j", "m.side", "print").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return groups.mapInArrow(_links(distance), "x long, y long")


def simhash_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE, segment: int = SEGMENT) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id that its links reach."""
    prints = freeze(fingerprints(docs, doc_id, text), "prints")
    nodes = freeze(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "nodes")
    found = freeze(links(nodes, distance, segment).distinct(), "links")
    labels = components(found).select(F.col("node").alias("print"), "label")
    named = nodes.join(labels, "print", "left").withColumn("label", F.coalesce("label", "print"))
    names = named.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = freeze(named.select("print", "label").join(names, "label").select("print", "component_id"), "classes")
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return prints.join(classes, "print").select("doc_id", hexed, "component_id")
