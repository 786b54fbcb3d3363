"""Near-duplicate documents by order MinHash and banded alignment.

A document is its sequence of five-word shingles, each labelled with how often
it has occurred before in the document. For each of ``sketches`` hash functions
the sketch keeps the ``KEEP`` smallest labelled shingles in text order; two
documents that agree on a sketch are candidates. Unlike plain MinHash this
rewards equal order, so it follows edit similarity.

A candidate pair is verified by a banded alignment of the two word sequences:
with c words aligned of n and m, the pair is linked when c / (n + m - c)
reaches ``min_similarity``. Classes are the connected components of the links;
a class is named by its smallest doc_id.

Large groups: equal texts are one node. Every bucket of equal sketches has a
pivot, the node that shares sketches with most others (in a group of copies the
likely source), and a node is compared with the first of its pivots only, so
pairs grow with the bucket, not with its square. Then the nodes of different
classes that share a bucket of up to ``SMALL`` nodes all meet; in a larger
bucket one node of each class is compared with a new pivot, ``PIVOTS`` times.
These rounds only save work. What they leave is settled in full: every large
bucket that still holds several classes is dealt as pairs of blocks of about
``BLOCK`` nodes, and all nodes of different classes meet, word profiles first;
pairs that the profiles cannot rule out are aligned in the same task, unless
links found there already join their classes. A task returns links that join
classes, never pairs. So any two nodes that share a bucket are in one class or
have been compared.

Defined results: equal texts are one class, null counts as empty, a text of
under five words is one shingle, a text without words only equals its copies,
repeated rows fall into one class, different texts under one doc_id are
documents of their own (and both stay if their classes differ), a null doc_id
has a null class, other columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import GOLDEN, MIN_SIMILARITY, U64, checked, freeze, mix, pieces, shingle_hashes, text_bytes, word_hashes

SKETCHES = 32
KEEP = 2
CHUNK = 512
BINS = 256
SMALL = 8
PIVOTS = 2
BLOCK = 2048
#: Nodes that a node tries of every other class and block before all the rest.
TRIES = 4
LEVELS = 4


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Shingle hashes mixed with their occurrence number in the text."""
    n = len(shingles)
    order = np.argsort(shingles, kind="stable")
    s = shingles[order]
    first = np.concatenate([[True], s[1:] != s[:-1]]) if n else np.zeros(0, dtype=bool)
    if first.all():
        return mix(shingles)
    at = np.arange(n)
    number = np.empty(n, dtype=U64)
    number[order] = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(U64)
    return mix(shingles + number * GOLDEN)


def profile(words: np.ndarray) -> bytes:
    """How many words fall into each of ``BINS`` hash bins, one byte each if
    they fit, else four."""
    counts = np.bincount((words >> U64(11)).astype(np.int64) % BINS, minlength=BINS)
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def may_reach(a: bytes, b: bytes, least: float) -> bool:
    """Whether two texts with these profiles can reach ``least``: no alignment
    has more pairs than the bins have words in common."""
    x, y = (np.frombuffer(p, dtype=np.uint8 if len(p) == BINS else np.uint32).astype(np.int64) for p in (a, b))
    both = int(x.sum() + y.sum())
    return int(np.minimum(x, y).sum()) >= least / (1 + least) * both - 1e-9


def sketch(words: np.ndarray, sketches: int = SKETCHES) -> np.ndarray:
    """One value per hash function (none for a text without words)."""
    x = labelled(shingle_hashes(words))
    n = len(x)
    if not n:
        return np.zeros(0, dtype=np.int64)
    odd = np.arange(sketches, dtype=U64) * U64(2) + U64(1)
    keep = min(n, KEEP)
    least = np.empty((sketches, keep), dtype=np.int64)
    step = max(1, 500_000 // n)
    for at in range(0, sketches, step):  # functions at a time, by memory
        own = odd[at : at + step, None]
        h = (x ^ (own * U64(0xA5A5A5A5A5A5A5A5))) * (own * GOLDEN)
        h ^= h >> U64(29)
        row = np.arange(len(h))
        for k in range(keep):
            i = h.argmin(axis=1)
            least[at : at + step, k] = i
            h[row, i] = U64(0xFFFFFFFFFFFFFFFF)
    least.sort(axis=1)  # text order
    value = odd
    for k in range(keep):
        value = mix(value * GOLDEN + x[least[:, k]])
    return value.view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Elements of the longest common subsequence whose partners lie within
    ``band`` places (bit-parallel, a chunk of rows against its band)."""
    n, m = len(a), len(b)
    state = (1 << n) - 1  # a zero bit is an aligned element of a
    for top in range(0, m, CHUNK):
        end = min(m, top + CHUNK)
        lo, hi = max(0, top - band), min(n, end + band)
        if lo >= hi:
            continue
        mask = (1 << (hi - lo)) - 1
        places: dict[int, int] = {}
        for i, x in enumerate(a[lo:hi].tolist()):
            places[x] = places.get(x, 0) | (1 << i)
        v = (state >> lo) & mask
        for y in b[top:end].tolist():
            p = places.get(y)
            if p:
                u = v & p
                v = ((v + u) | (v - u)) & mask
        state = (state & ~(mask << lo)) | (v << lo)
    return n - state.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = MIN_SIMILARITY) -> float:
    """c / (n + m - c) of two word sequences; 0 where it cannot reach
    ``least``, and a lower bound of it where that suffices."""
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    need = least / (1 + least) * (n + m) - 1e-9
    if min(n, m) < need:
        return 0.0
    k = min(n, m)
    same = a[:k] == b[:k]
    head = k if same.all() else int(np.argmin(same))
    k -= head
    same = a[n - k :][::-1] == b[m - k :][::-1]
    tail = k if same.all() else int(np.argmin(same))
    c = head + tail
    if c < need:
        x, y = a[head : n - tail], b[head : m - tail]
        u, cu = np.unique(x, return_counts=True)
        w, cw = np.unique(y, return_counts=True)
        _, i, j = np.intersect1d(u, w, assume_unique=True, return_indices=True)
        if c + int(np.minimum(cu[i], cw[j]).sum()) < need:
            return 0.0
        c += aligned(x, y, int(n + m - 2 * need) + 1)
    return c / (n + m - c) if c >= need else 0.0


def _sketches(sketches: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                texts = part.column(1).to_pylist()
                digest = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts), dtype=np.int64).reshape(-1, 2)
                words = [word_hashes(t.decode("utf-8", "replace")) for t in texts]
                columns = [
                    part.column(0),
                    part.column(2),
                    pa.array(digest[:, 0]),
                    pa.array(digest[:, 1]),
                    pa.array([sketch(w, sketches) for w in words], pa.list_(pa.int64())),
                    pa.array([profile(w) for w in words], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t", "a", "b", "sketch", "profile"])

    return run


def _verify(least: float):
    def run(batches):
        cache: dict[int, np.ndarray] = {}

        def words(doc: int, text: bytes) -> np.ndarray:
            got = cache.get(doc)
            if got is None:
                if len(cache) >= 32:
                    cache.clear()
                got = cache[doc] = word_hashes(text.decode("utf-8", "replace"))
            return got

        for batch in batches:
            for part in pieces(batch):
                x, y = part.column(0).to_pylist(), part.column(1).to_pylist()
                sims = [similarity(words(p, s), words(q, t), least) for p, q, s, t in zip(x, y, part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sims, pa.float64())], ["x", "y", "similarity"])

    return run


def _screen(least: float):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                ok = [may_reach(p, q, least) for p, q in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield part.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return run


def verify(pairs: DataFrame, profiles: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(x, y, similarity) of the pairs that reach ``least``. The word profiles
    rule out most pairs that cannot, so few texts meet."""
    p = profiles.select(F.col("node").alias("x"), F.col("profile").alias("p"))
    q = profiles.select(F.col("node").alias("y"), F.col("profile").alias("q"))
    likely = p.join(checked(pairs, 24), "x").join(q, "y").select("x", "y", "p", "q").mapInArrow(_screen(least), "x long, y long")
    likely = freeze(likely, "likely")
    left = texts.select(F.col("node").alias("x"), F.col("text").alias("s"))
    right = texts.select(F.col("node").alias("y"), F.col("text").alias("t"))
    right = right.join(checked(likely.select("y").distinct(), 16), "y", "left_semi")
    both = left.join(checked(likely, 24), "x").join(right, "y").select("x", "y", "s", "t")
    return both.mapInArrow(_verify(least), "x long, y long, similarity double").where(F.col("similarity") > 0)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component of every node that
    ``links`` (x, y) holds.

    Every node takes the smallest label next to it and then its label's label,
    until nothing changes; each round is stored, so its lineage is short.
    """
    both = freeze(links.select(F.col("x").alias("a"), F.col("y").alias("b")).union(links.select("y", "x")).distinct(), "both")
    labels = freeze(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("was"))
        own = labels.select("node", "label", F.col("label").alias("was"))
        step = near.union(own).groupBy("node").agg(F.min("label").alias("next"), F.max("was").alias("was"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        done = freeze(step.join(jump, "next", "left").select("node", F.least("next", "further").alias("label"), "was"), "labels")
        labels = done.select("node", "label")
        if not done.where("label <> was").limit(1).count():
            return labels


def _likely(nodes: np.ndarray, names: np.ndarray, seeks: np.ndarray, rest: np.ndarray, profiles: list[bytes], least: float, tries: int | None):
    """Row pairs (x, y) of a seeking node and another one of a different name that
    may reach ``least``; at most ``tries`` of a seeker with each name. Two
    nodes of the rest meet once, the smaller one as x.

    With a column per bin and level (count >= level) the words that two
    profiles have in common are a product, up to counts over ``LEVELS``."""
    counts = np.stack([np.frombuffer(p, dtype=np.uint8 if len(p) == BINS else np.uint32).astype(np.int32) for p in profiles])
    levels = np.concatenate([counts >= k for k in range(1, LEVELS + 1)], axis=1).astype(np.float32)
    over = np.maximum(counts - LEVELS, 0).sum(axis=1)
    need = least / (1 + least) * counts.sum(axis=1)
    s, t = np.flatnonzero(seeks), np.flatnonzero(~seeks)
    columns = levels[t].T
    for at in range(0, len(s), 256):
        own = s[at : at + 256]
        bound = levels[own] @ columns + np.minimum(over[own][:, None], over[t])
        ok = (bound >= need[own][:, None] + need[t] - 1e-3) & (names[own][:, None] != names[t])
        ok &= (nodes[own][:, None] < nodes[t]) | ~rest[t]
        i, j = np.nonzero(ok)
        i, j = own[i], t[j]
        for k in range(0, len(i), 4096):
            x, y = i[k : k + 4096], j[k : k + 4096]
            fine = np.minimum(counts[x], counts[y]).sum(axis=1) >= need[x] + need[y] - 1e-6
            ok_x, ok_y = x[fine], y[fine]
            if tries is not None and len(ok_x):
                order = np.lexsort((names[ok_y], ok_x))
                ok_x, ok_y = ok_x[order], ok_y[order]
                edge = np.concatenate([[True], (ok_x[1:] != ok_x[:-1]) | (names[ok_y[1:]] != names[ok_y[:-1]])])
                place = np.arange(len(ok_x))
                first = place - np.maximum.accumulate(np.where(edge, place, 0)) < tries
                ok_x, ok_y = ok_x[first], ok_y[first]
            if len(ok_x):
                yield ok_x, ok_y


def linked(table: pa.Table, least: float, tries: int | None) -> list[tuple[int, int, float]]:
    """A spanning forest of the links in a block, over its names: likely pairs
    are aligned unless links of the block already join their names. A pair that
    shares several sketches belongs to the bucket of the first of them."""
    column = lambda name: table.column(name).to_numpy()
    nodes, texts = column("node"), table.column("words")
    name = dict(zip(nodes.tolist(), column("name").tolist(), strict=True))
    above: dict[int, int] = {}
    words: dict[int, np.ndarray] = {}
    row = dict(zip(nodes.tolist(), range(len(nodes)), strict=True))
    sketches = table.column("sketch").combine_chunks()
    sketches = sketches.flatten().to_numpy().reshape(len(nodes), -1)
    cell = int(table.column("cell")[0].as_py())

    def root(x: int) -> int:
        while x in above:
            above[x] = x = above.get(above[x], above[x])
        return x

    def of(x: int) -> np.ndarray:
        if x not in words:
            words[x] = np.frombuffer(texts[row[x]].as_py(), dtype=U64)
        return words[x]

    found = []
    for i, j in _likely(nodes, column("name"), column("seeks"), column("rest"), table.column("profile").to_pylist(), least, tries):
        same = sketches[i] == sketches[j]
        own = sketches[i, same.argmax(axis=1)] == cell
        for x, y in zip(nodes[i[own]].tolist(), nodes[j[own]].tolist(), strict=True):
            p, q = root(name[x]), root(name[y])
            if p != q and (s := similarity(of(x), of(y), least)) > 0:
                above[max(p, q)] = min(p, q)
                found.append((x, y, s))
    return found


def _blocks(least: float, tries: int | None):
    """Over rows sorted by (cell, k, j): the links of every such block."""

    def settle(held: list[pa.RecordBatch]):
        rows = linked(pa.Table.from_batches(held), least, tries)
        if rows:
            x, y, s = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(s, pa.float64())], ["x", "y", "similarity"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                key = tuple(keys[:, a].tolist())
                if held and key != last:
                    yield from settle(held)
                    held = []
                last = key
                held.append(batch.slice(a, b - a))
        if held:
            yield from settle(held)

    return run


def _words(batches):
    for batch in batches:
        for part in pieces(batch):
            words = [word_hashes(t.decode("utf-8", "replace")).tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words, pa.binary())], ["node", "words"])


def block_links(members: DataFrame, profiles: DataFrame, texts: DataFrame, least: float, tries: int | None) -> DataFrame:
    """(x, y, similarity): links that join the different names in the buckets of
    ``members`` (cell, node, name), where any exist.

    The nodes outside a bucket's largest name are its rest; each block of the
    rest meets each block of the whole bucket in a task of its own, which
    aligns what the word profiles do not rule out and returns at most one link
    less than it has names. Buckets that are not in ``members`` any more hold no
    two names or have been compared in full, so a pair may be left to the
    bucket of its first common sketch."""
    kinds = members.groupBy("cell", "name").agg(F.count(F.lit(1)).alias("c"))
    cells = kinds.groupBy("cell").agg(F.sum("c").alias("n"), F.max(F.struct("c", "name")).alias("most")).where("n > most.c")
    parts = lambda n: F.ceil(n / F.lit(BLOCK)).cast("long")
    cells = cells.select("cell", F.col("most.name").alias("largest"), parts(F.col("n")).alias("all_j"), parts(F.col("n") - F.col("most.c")).alias("all_k"))
    mixed = freeze(members.join(cells, "cell"), "cells")
    involved = checked(freeze(mixed.select("node").distinct(), "involved"), 16)
    words = freeze(texts.join(involved, "node", "left_semi").select("node", "text").mapInArrow(_words, "node long, words binary"), "words")
    rows = mixed.join(profiles, "node").join(words, "node").withColumn("rest", F.col("name") != F.col("largest"))
    place = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    out = ["node", "name", "rest", "profile", "words", "sketch"]
    seekers = rows.where("rest").withColumn("k", place(1, "all_k")).select("cell", "k", every("all_j").alias("j"), F.lit(True).alias("seeks"), *out)
    others = rows.withColumn("j", place(2, "all_j")).select("cell", every("all_k").alias("k"), "j", F.lit(False).alias("seeks"), *out)
    dealt = seekers.unionByName(others).repartition("cell", "k", "j").sortWithinPartitions("cell", "k", "j")
    return dealt.mapInArrow(_blocks(least, tries), "x long, y long, similarity double")


def renamed(names: DataFrame, found: DataFrame) -> DataFrame:
    """``names`` after the links ``found``: linked names become one."""
    of = checked(names, 24).select(F.col("node").alias("n"), "name")
    ends = found.join(of, F.col("x") == F.col("n"), "left").select(F.coalesce("name", "x").alias("x"), "y")
    ends = ends.join(of, F.col("y") == F.col("n"), "left").select("x", F.coalesce("name", "y").alias("y"))
    new = components(freeze(ends.where("x <> y").distinct(), "ends")).select(F.col("node").alias("old"), F.col("label").alias("new"))
    alone = new.select(F.col("old").alias("node"), F.col("old").alias("name")).join(checked(names.select("node"), 16), "node", "left_anti")
    both = names.union(alone).join(checked(new, 24), F.col("name") == F.col("old"), "left")
    return freeze(both.select("node", F.coalesce("new", "name").alias("name")), "names")


def _unordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))


def _classes(docs: DataFrame, doc_id: str, text: str, min_similarity: float, sketches: int) -> tuple[DataFrame, DataFrame]:
    """(documents with the hash pair of their text, texts with their class)."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text")).withColumn("t", F.xxhash64("text"))
    sketched = freeze(own.mapInArrow(_sketches(sketches), "doc_id long, t long, a long, b long, sketch array<long>, profile binary"), "sketches")
    same = sketched.where("doc_id is not null").groupBy("a", "b")
    same = freeze(same.agg(F.min(F.struct("doc_id", "t")).alias("first"), F.first("sketch").alias("sketch"), F.first("profile").alias("profile")), "texts")
    # a text goes by its smallest doc_id; of several texts that share it, all
    # but one go by their hash
    holder = same.groupBy(F.col("first.doc_id").alias("id")).agg(F.min(F.struct("a", "b")).alias("h"))
    holds = F.col("h") == F.struct("a", "b")
    same = same.join(holder, F.col("first.doc_id") == F.col("id")).withColumn("node", F.when(holds, F.col("id")).otherwise(F.col("a"))).drop("id", "h")
    same = freeze(same, "nodes")
    cells = same.select("node", F.explode("sketch").alias("cell"))
    shared = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = freeze(cells.join(shared, "cell"), "members")
    # the text that agrees most with others is the likely source of its copies
    reach = members.groupBy("node").agg(F.sum("n").alias("reach"))
    members = freeze(members.join(reach, "node").select("cell", "node", "reach"), "reach")
    rank = F.struct("reach", F.xxhash64("node").alias("h"), "node")
    pivots = members.groupBy("cell").agg(F.max(rank).alias("pivot"))
    # a node meets the first of its pivots; the rounds below meet the others
    first = members.join(pivots, "cell").groupBy("node").agg(F.max("pivot").alias("pivot")).select("node", F.col("pivot.node").alias("pivot"))
    first = freeze(first, "first")
    wanted = same.join(checked(first.select("node"), 16), "node", "left_semi").select("node", "first.doc_id", "first.t")
    wanted = checked(freeze(wanted, "wanted"), 32)
    texts = freeze(own.join(wanted, ["doc_id", "t"]).select("node", "text").dropDuplicates(["node"]), "involved")
    pairs = first.where("node <> pivot").select(F.col("node").alias("x"), F.col("pivot").alias("y"))
    tested = _unordered(pairs)
    profiles = freeze(same.join(checked(first.select("node"), 16), "node", "left_semi").select("node", "profile", "sketch"), "profiles")
    links = freeze(verify(pairs, profiles, texts, min_similarity), "links")
    # a node goes by its pivot's name while buckets are compared; the classes
    # themselves are put together from all links at the end
    names = links.select(F.col("x").alias("node"), F.col("y").alias("name"))
    for turn in range(PIVOTS):
        # buckets that still hold several names, dealt by bucket once
        named = members.join(checked(names, 24), "node", "left").withColumn("name", F.coalesce("name", "node")).repartition("cell")
        mixed = named.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("p"), F.max("name").alias("q")).where("p <> q")
        members = freeze(named.join(mixed.select("cell", "n"), "cell").select("cell", "node", "reach", "name", "n"), "mixed")
        # the nodes of a small bucket all meet, once; in a large one a node of
        # each name meets a pivot, which goes by reach at first, then by chance
        large = members.where(F.col("n") > SMALL).repartition("cell")
        order = F.struct((F.xxhash64("node", F.lit(turn)) if turn else -F.col("reach")).alias("h"), F.col("node").alias("node"))
        heads = large.groupBy("cell", "name").agg(F.min(order).alias("head"))
        pivots = heads.groupBy("cell").agg(F.min("head").alias("pivot"))
        met = heads.join(pivots, "cell").select(F.col("head.node").alias("x"), F.col("pivot.node").alias("y"))
        if not turn:
            small = members.where(F.col("n") <= SMALL)
            other = small.select("cell", F.col("node").alias("y"), F.col("name").alias("other"))
            met = met.union(small.join(other, "cell").where("node < y and name <> other").select(F.col("node").alias("x"), "y"))
        fresh = met.where("x <> y").withColumns({"u": F.least("x", "y"), "v": F.greatest("x", "y")})
        fresh = fresh.groupBy("u", "v").agg(F.min(F.struct("x", "y")).alias("m"))
        fresh = freeze(fresh.join(checked(tested, 24), ["u", "v"], "left_anti").select("m.x", "m.y"), "pairs")
        found = freeze(verify(fresh, profiles, texts, min_similarity), "links")
        members = members.where(F.col("n") > SMALL).select("cell", "node", "reach")
        tested, links = tested.union(_unordered(fresh)), links.union(found)
        if not found.limit(1).count():
            break
        names = renamed(names, found)
    # what the pivots leave: a few nodes of each name first, since most that
    # have a link find one there, then all
    for tries in (TRIES, None):
        named = members.join(checked(names, 24), "node", "left").select("cell", "node", F.coalesce("name", "node").alias("name"))
        found = freeze(block_links(named, profiles, texts, min_similarity, tries), "links")
        if found.limit(1).count():
            names = renamed(names, found)
        links = links.union(found)
    labels = components(links).select(F.col("node").alias("__n"), "label")
    named = same.join(labels, F.col("node") == F.col("__n"), "left")
    return sketched.select("doc_id", "a", "b"), freeze(named.select("a", "b", "first", F.coalesce("label", "node").alias("label")), "classes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_similarity: float = MIN_SIMILARITY, sketches: int = SKETCHES) -> DataFrame:
    """One row per document: doc_id, class_id and copy_of (the smallest doc_id
    of its equal texts)."""
    rows, classes = _classes(docs, doc_id, text, min_similarity, sketches)
    names = classes.groupBy("label").agg(F.min("first.doc_id").alias("class_id"))
    out = classes.join(names, "label").select("a", "b", "class_id", F.col("first.doc_id").alias("copy_of"))
    known = F.col("doc_id").isNotNull()
    joined = rows.join(out, ["a", "b"], "left")
    return joined.select("doc_id", F.when(known, F.col("class_id")).alias("class_id"), F.when(known, F.col("copy_of")).alias("copy_of"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_similarity: float = MIN_SIMILARITY, sketches: int = SKETCHES) -> DataFrame:
    """One document of each class (its smallest doc_id; one row of repeated
    rows). Documents without a doc_id stay."""
    _, classes = _classes(docs, doc_id, text, min_similarity, sketches)
    kept = classes.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("__keep_id"), F.col("first.t").alias("__keep_t"))
    marked = docs.withColumn("__t", F.xxhash64(text_bytes(docs[text])))
    same = (docs[doc_id].cast("long") == F.col("__keep_id")) & (F.col("__t") == F.col("__keep_t"))
    rows = marked.join(freeze(kept, "kept"), same, "left_semi").dropDuplicates([doc_id, "__t"])
    return rows.drop("__t").unionByName(docs.where(F.col(doc_id).isNull()))
