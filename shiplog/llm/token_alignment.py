"""Alignment of two tokenizers over the same texts.

A text is encoded by a byte-level BPE (A, over a space and the text) and a
piece BPE (B, which adds that space itself). The byte offsets at which tokens
of A and tokens of B end are two dictionaries from end to index; the ends that
both hold, in order, slice the two id lists into groups, and inside a group
every A token is linked with every B token whose bytes overlap its own.

Both vocabularies end a token before a space that follows a non-space and
comes before a non-white character, so a text is encoded and aligned stretch
by stretch between such places, and a stretch that comes again is taken from a
bounded table. (The test compares this with whole-text encoding.)

A link's count is how many links of all texts hold its id pair. The pair table
is summed over Spark. Its most frequent pairs (a power of two of the count as
lower bound, at most ``FREQUENT`` pairs of 16 bytes) and the highest count of
each B id (one number per vocabulary entry) travel with the tasks; links of
all other pairs are joined with the table, whose keys are then rare each.

Defined results: texts that are null, empty, or whose joined token bytes differ
from a space and the text have no tokens, zeros everywhere and empty groups;
strings of special tokens inside a text are plain text; repeated rows count
each; rows without an id are kept; other columns play no part.
"""

from __future__ import annotations

import json
import os
import re
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.llm.common import freeze, pieces

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Fixed value: the parts that the merges of A stay within.
SPLIT_A = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pairs whose counts travel with the scoring tasks (8 bytes each way).
FREQUENT = 1 << 20
#: Stretches kept per worker, and the characters of the longest one kept.
CACHE = 300_000
LONGEST = 64
#: Distinct pairs that a counting task sums before it passes them on.
HELD = 1 << 21

#: White space at the start, or right after a space, or a space at the end.
_UNEVEN = re.compile(r"\A\s| (?:\s|\Z)")
#: Stretches of printable ASCII and Latin letters.
_PLAIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
_FIELD = (1 << 40) - 1
_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """The byte behind each character of byte-level vocabulary entries:
    printable Latin-1 characters are themselves, the other bytes follow each
    other from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(0x100 + i): b for i, b in enumerate(rest)}


def slices(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The common ends, in order, with how many tokens of A and of B end up to
    each."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1), strict=True))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1), strict=True))
    common = sorted(at_a.keys() & at_b.keys())
    return common, list(map(at_a.__getitem__, common)), list(map(at_b.__getitem__, common))


def overlaps(ends_a: list[int], ends_b: list[int], a: int, a2: int, b: int, b2: int):
    """Index pairs of one slice whose byte ranges overlap, in order."""
    i, j = a, b
    while i < a2 and j < b2:
        yield i, j
        # the ends differ inside a slice, but for its last tokens
        if ends_a[i] <= ends_b[j]:
            i += 1
        else:
            j += 1


class Aligner:
    """Aligned stretches of text, with a bounded table of them."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = _byte_of()
        size_a = self.a.get_vocab_size()
        entries = [self.a.id_to_token(i) or "" for i in range(size_a)]
        self.bytes_a = [bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else e.encode() for e in entries]
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            p = self.b.id_to_piece(i)
            hexa = _BYTE_PIECE.fullmatch(p)
            self.bytes_b.append(bytes([int(hexa[1], 16)]) if hexa else p.replace("▁", " ").encode())
        self.base = len(self.bytes_b)
        self.length_a, self.length_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.text_a, self.text_b = [f"{i}|" for i in range(size_a)], [str(i) for i in range(self.base)]
        self.plain = self._plain_encoder()
        self.dtype = "<u4" if size_a * self.base < 1 << 32 else "<u8"
        self.clear()

    def _plain_encoder(self):
        """A quicker encoder of A for plain stretches: the same merges, as the
        entries' ranks. None unless the ids after the bytes are the merges in
        order, which is what ranks mean."""
        import tiktoken

        model = json.loads(self.a.to_str())["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = model["vocab"]
        first = ids["".join(merges[0])] if merges else len(ids)
        if any(ids.get("".join(m)) != first + k for k, m in enumerate(merges)):
            return None
        ranks = {self.bytes_a[i]: i for i in range(first + len(merges))}
        if len(ranks) != first + len(merges):
            return None
        return tiktoken.Encoding("a", pat_str=SPLIT_A, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.numbers: list[int] = []  # tokens of A and B and groups, 40 bits each
        self.groups: list[str] = []
        self.codes: list[bytes] = []
        self.broken: set[int] = set()  # stretches whose bytes a vocabulary changes

    def _encode(self, text: str, plain: bool) -> tuple[list[int], list[int]] | None:
        """Ids of both, None if the bytes differ."""
        ids_a = self.plain(" " + text) if plain else self.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = self.b.encode(text)
        want = b" " + text.encode("utf-8", "replace")
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != want or b"".join(map(self.bytes_b.__getitem__, ids_b)) != want:
            return None
        return ids_a, ids_b

    def learn(self, stretches: list[str]) -> None:
        """Encode and align new stretches, many to a call where each may follow
        another."""
        kinds: tuple[list[str], list[str], list[str]] = ([], [], [])
        for s in stretches:
            if self.plain and _PLAIN.fullmatch(s):
                kinds[0].append(s)
            else:
                kinds[1 if s and s[-1] != " " and not s[0].isspace() else 2].append(s)
        chunks = [(k[i : i + n], j == 0) for j, (k, n) in enumerate(zip(kinds, (512, 512, 1), strict=True)) for i in range(0, len(k), n)]
        while chunks:
            own, plain = chunks.pop()
            found = self._encode(" ".join(own), plain)
            if found:
                self._align(own, *found)
            elif len(own) > 1:  # one by one, to find those that are changed
                chunks += [([s], plain) for s in own]
            else:
                self.broken.add(len(self.numbers))
                self._add(own[0], (0, 0, 0), [], b"")

    def _add(self, stretch: str, numbers: tuple[int, int, int], groups: list[str], codes: bytes) -> None:
        self.known[stretch] = len(self.numbers)
        self.numbers.append(numbers[0] | numbers[1] << 40 | numbers[2] << 80)
        self.groups.append(";".join(groups))
        self.codes.append(codes)

    def _align(self, stretches: list[str], ids_a: list[int], ids_b: list[int]) -> None:
        a, b = np.array(ids_a), np.array(ids_b)
        ends_a, ends_b = np.cumsum(self.length_a[a]).tolist(), np.cumsum(self.length_b[b]).tolist()
        ends, upto_a, upto_b = (np.array([0, *x]) for x in slices(ends_a, ends_b))
        from_a, from_b = upto_a[:-1], upto_b[:-1]
        # a slice of one token each is one link; the others are expanded
        single = (np.diff(upto_a) == 1) & (np.diff(upto_b) == 1)
        codes = a[from_a] * self.base + b[from_b]
        groups = list(map(add, map(self.text_a.__getitem__, a[from_a].tolist()), map(self.text_b.__getitem__, b[from_b].tolist())))
        more: list[int] = []
        upto_more = np.zeros(len(ends), dtype=np.int64)
        for k in np.flatnonzero(~single).tolist():
            i, i2, j, j2 = int(upto_a[k]), int(upto_a[k + 1]), int(upto_b[k]), int(upto_b[k + 1])
            groups[k] = f"{','.join(map(str, ids_a[i:i2]))}|{','.join(map(str, ids_b[j:j2]))}"
            more += [ids_a[x] * self.base + ids_b[y] for x, y in overlaps(ends_a, ends_b, i, i2, j, j2)]
            upto_more[k + 1] = len(more)
        upto_more = np.maximum.accumulate(upto_more).tolist()
        upto_one = np.cumsum([0, *single]).tolist()
        width = np.dtype(self.dtype).itemsize
        ones, others = codes[single].astype(self.dtype).tobytes(), np.array(more, dtype=self.dtype).tobytes()
        borders = np.cumsum([len(s.encode("utf-8", "replace")) + 1 for s in stretches])
        last = np.searchsorted(ends, borders).tolist()
        n_a, n_b = upto_a.tolist(), upto_b.tolist()
        k = 0
        for s, m in zip(stretches, last, strict=True):
            own = ones[upto_one[k] * width : upto_one[m] * width] + others[upto_more[k] * width : upto_more[m] * width]
            self._add(s, (n_a[m] - n_a[k], n_b[m] - n_b[k], m - k), groups[k:m], own)
            k = m

    @staticmethod
    def stretches(text: str) -> list[str]:
        """The text cut before single spaces (which are left out) that both
        vocabularies end a token at."""
        parts = text.split(" ")
        if not _UNEVEN.search(text):
            return parts
        out = [parts[0]]
        for before, p in zip(parts, parts[1:], strict=False):
            if before and p and not p[0].isspace():
                out.append(p)
            else:
                out[-1] += " " + p
        return out

    def align(self, texts: list[str]):
        """(n_a, n_b, n_groups, groups, codes) of each text."""
        if len(self.known) > CACHE:
            self.clear()
        get = self.known.get
        split = [self.stretches(t) if t else [] for t in texts]
        found = [list(map(get, parts)) for parts in split]
        new = {s for parts, at in zip(split, found, strict=True) if None in at for s, i in zip(parts, at, strict=True) if i is None}
        if new:
            self.learn(list(new))
        out = []
        for parts, at in zip(split, found, strict=True):
            if None in at:
                at = list(map(get, parts))
            if not at or not self.broken.isdisjoint(at):
                out.append((0, 0, 0, "", b""))
                continue
            n = sum(map(self.numbers.__getitem__, at))
            groups, codes = ";".join(map(self.groups.__getitem__, at)), b"".join(map(self.codes.__getitem__, at))
            out.append((n & _FIELD, n >> 40 & _FIELD, n >> 80, groups, codes))
        # long stretches hardly come again
        for s in new:
            if len(s) > LONGEST:
                i = self.known.pop(s)
                self.groups[i], self.codes[i] = "", b""
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, codes binary, times binary"


def _aligned(path_a: str, path_b: str):
    def run(batches):
        own = aligner(path_a, path_b)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in pieces(batch, 64):
                found = own.align([t or "" for t in part.column(1).to_pylist()])
                links = [np.frombuffer(f[4], dtype=own.dtype) for f in found]
                pairs = [np.unique(x, return_counts=True) for x in links]
                long = lambda values: pa.array(values, pa.int64())
                columns = [
                    long(range(row, row + len(found))),
                    part.column(0),
                    *[long([f[k] for f in found]) for k in range(3)],
                    long([len(x) for x in links]),
                    pa.array([f[3] for f in found], pa.string()),
                    pa.array([c.tobytes() for c, _ in pairs], pa.binary()),
                    pa.array([n.astype("<u4").tobytes() for _, n in pairs], pa.binary()),
                ]
                row += len(found)
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ALIGNED.split(", ")])

    return run


def alignments(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: token numbers, the groups as ``a1,a2|b1;...``, and
    its linked pairs (``codes``: A id times the size of B plus B id, ascending,
    with ``times``)."""
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return own.mapInArrow(_aligned(path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B)), ALIGNED)


def _layout(path_a: str | None, path_b: str | None) -> tuple[int, str]:
    """Size of vocabulary B and the type of the codes."""
    own = aligner(path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B))
    return own.base, own.dtype


def _summed(dtype: str):
    def merged(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        u, at = np.unique(np.concatenate(codes), return_inverse=True)
        return u, np.bincount(at, weights=np.concatenate(times), minlength=len(u)).astype(np.int64)

    def out(u: np.ndarray, n: np.ndarray):
        for i in range(0, len(u), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(u[i : i + 100_000].astype(np.int64)), pa.array(n[i : i + 100_000])], ["code", "n"])

    def run(batches):
        u, n = np.zeros(0, dtype=dtype), np.zeros(0, dtype=np.int64)
        for batch in batches:
            for part in pieces(batch, 2048):
                codes = [np.frombuffer(b"".join(part.column(0).to_pylist()), dtype=dtype)]
                times = [np.frombuffer(b"".join(part.column(1).to_pylist()), dtype="<u4").astype(np.int64)]
                u, n = merged([u, *codes], [n, *times])
                if len(u) > HELD:
                    yield from out(u, n)
                    u, n = u[:0], n[:0]
        yield from out(u, n)

    return run


def link_counts(aligned: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(code, a_id, b_id, n, is_best): every linked id pair with the number of
    its links in all texts, and whether no pair of its B id has more."""
    base, dtype = _layout(path_a, path_b)
    summed = aligned.select("codes", "times").mapInArrow(_summed(dtype), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    pairs = freeze(summed, "links").withColumn("b_id", F.col("code") % base)
    best = pairs.groupBy("b_id").agg(F.max("n").alias("best"))  # a row per entry of B
    rated = pairs.join(F.broadcast(best), "b_id").withColumn("a_id", F.floor(F.col("code") / base))
    return rated.select("code", "a_id", "b_id", "n", (F.col("n") == F.col("best")).alias("is_best"))


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes, counts and best flags of the pairs with at least ``least`` links;
    ``least`` is the smallest power of two that leaves up to FREQUENT pairs."""
    power = F.floor(F.log2("n")).cast("int").alias("power")
    sizes = {r["power"]: r["k"] for r in counts.groupBy(power).agg(F.count(F.lit(1)).alias("k")).collect()}  # a row per power of two
    least, held = max(sizes, default=0) + 1, 0
    while least and held + sizes.get(least - 1, 0) <= FREQUENT:
        least -= 1
        held += sizes.get(least, 0)
    table = counts.where(F.col("n") >= 1 << least).select("code", "n", "is_best").toArrow().sort_by("code")
    return (*(table.column(c).to_numpy() for c in ("code", "n", "is_best")), 1 << least)


SCORED = "row long, n_best long, count_sum long, rare_codes array<long>, rare_times array<long>"


def _scored(frequent, dtype: str):
    def run(batches):
        codes, counts, best = frequent.value
        for batch in batches:
            for part in pieces(batch, 256):
                found = []
                for c, n in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    own, times = np.frombuffer(c, dtype=dtype).astype(np.int64), np.frombuffer(n, dtype="<u4").astype(np.int64)
                    at = np.minimum(np.searchsorted(codes, own), max(len(codes) - 1, 0))
                    hit = codes[at] == own if len(codes) else np.zeros(len(own), dtype=bool)
                    at, t = at[hit], times[hit]
                    found.append((int(t[best[at]].sum()), int((t * counts[at]).sum()), own[~hit], times[~hit]))
                long, lists = pa.int64(), pa.list_(pa.int64())
                columns = [pa.array([f[k] for f in found], t) for k, t in enumerate((long, long, lists, lists))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], [c.split()[0] for c in SCORED.split(", ")])

    return run


def scored(aligned: DataFrame, counts: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(row, n_best, count_sum) of every row of the stored ``aligned``."""
    spark: SparkSession = aligned.sparkSession
    _, dtype = _layout(path_a, path_b)
    *table, least = _frequent(counts)
    near = aligned.select("row", "codes", "times").mapInArrow(_scored(spark.sparkContext.broadcast(tuple(table)), dtype), SCORED)
    near = freeze(near, "scored")
    links = near.select("row", F.explode(F.arrays_zip("rare_codes", "rare_times")).alias("x")).select("row", F.col("x.rare_codes").alias("code"), F.col("x.rare_times").alias("times"))
    rare = counts.where(F.col("n") < least).select("code", "n", "is_best")
    far = links.join(rare, "code").groupBy("row").agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("far_best"), F.sum(F.col("times") * F.col("n")).alias("far_sum"))
    both = near.select("row", "n_best", "count_sum").join(far, "row", "left")
    return both.select("row", (F.col("n_best") + F.coalesce("far_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("far_sum", F.lit(0))).alias("count_sum"))


def alignment_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: token, group and link numbers, links that are the
    best of their B id, the sum of all links' counts, and the groups' digest."""
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.lit(""))
    stored = freeze(alignments(docs, doc_id, text, path_a, path_b).withColumn("groups_sha256", digest).drop("groups"), "aligned")
    counts = freeze(link_counts(stored, path_a, path_b), "counts")
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return stored.drop("codes", "times").join(scored(stored, counts, path_a, path_b), "row").select(*out)
