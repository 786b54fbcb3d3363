"""Packing documents into sequences by order-preserving dynamic programming.

The documents of a partition, in order, form one run of tokens. Cuts may stand
at document ends (free), at sentence ends (``SENTENCE``) and, dearer, after
every ``STEP``-th token (``MIDDLE``); a sequence between two cuts costs its
padding up to ``size`` tokens. The cheapest set of cuts comes from a forward
recurrence over the cut places: cost(j) = min over i with j - i <= size of
cost(i) + size - (j - i) + penalty(j); as padding is linear, the best i is
the front of a queue kept monotone in cost(i) + i. What remains at the end of
a partition is cut into power-of-two lengths, which are not padded.

Runs longer than ``BLOCK`` tokens are solved block by block; the last sequence
of a block is carried into the next, so memory stays bounded.

Defined results: null and empty texts are documents of the end id alone;
documents longer than a sequence are cut; repeated rows are packed each; other
columns play no part. Sequence ids grow with the partition and are unique.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shiplog.llm.common import pieces, text_bytes

SIZE = 2048
END_ID = 1
SENTENCE = 2
MIDDLE = 24
STEP = 32
BLOCK = 400_000
VOCABULARY = "word_bpe_49k.json"
#: Parts in one of the encoder's two tables (some 230 bytes each).
GENERATION = 300_000
#: Tokens that end a sentence.
SENTENCE_ENDS = (".</w>", "!</w>", "?</w>", "...</w>", "!!</w>", "?!</w>")

#: ASCII marks that may follow letters (no apostrophe: contractions are tokens).
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_TOKENIZERS: dict[str, tuple] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts, as little-endian 32-bit integers.

    The vocabulary's rules lower the case, drop white space and let no token
    span it or join letters to marks, so the ids of a text are those of its
    parts between ASCII white space, and the ids of letters followed by marks
    are those of the letters and of the marks. Parts are kept in two tables: a
    full one becomes the older one, whose parts move to the new one when they
    are met again, so frequent words stay and a worker holds at most twice
    ``GENERATION`` parts and a call's own. Words of lower-case letters need no normalising and go to the
    vocabulary's merges alone.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {}
        ends = [self.whole.token_to_id(t) for t in SENTENCE_ENDS]
        self.ends = np.zeros(max(self.whole.get_vocab_size(), END_ID) + 1, dtype=bool)
        self.ends[[i for i in ends if i is not None]] = True

    def _ids(self, parts: list[bytes], words: bool) -> list[bytes]:
        """The ids of each part (none holds white space), many to a call."""
        out: list[bytes] = []
        for i in range(0, len(parts), 512):
            own = parts[i : i + 512]
            text = b" ".join(own).decode("utf-8", "replace")
            e = (self.merges if words else self.whole).encode(text, add_special_tokens=False)
            ids = np.array(e.ids, dtype="<u4").tobytes()
            if words:
                at = np.searchsorted(np.array(e.word_ids, dtype=np.int64), np.arange(len(own) + 1))
            else:
                first = np.cumsum([0, *[len(p.decode("utf-8", "replace")) + 1 for p in own]])
                at = np.searchsorted(np.array([o[0] for o in e.offsets], dtype=np.int64), first)
            at = (at * 4).tolist()
            out += [ids[lo:hi] for lo, hi in zip(at, at[1:], strict=False)]
        return out

    def learn(self, parts: list[bytes]) -> None:
        plain: list[bytes] = []  # letters alone
        marked: list[tuple[bytes, bytes, bytes]] = []  # letters and marks
        others: list[bytes] = []
        for p in parts:
            core = p.rstrip(MARKS)
            if (core.isalpha() and core.islower()) or _lower_letters(core):
                if len(core) == len(p):
                    plain.append(p)
                else:
                    marked.append((p, core, p[len(core) :]))
            else:
                others.append(p)
        known, marks = self.known, self.marks
        plain += {c for _, c, _ in marked if c not in known}.difference(plain)
        known.update(zip(plain, self._ids(plain, True), strict=True))
        new = list({m for *_, m in marked if m not in marks})
        marks.update(zip(new, self._ids(new, False), strict=True))
        for p, core, mark in marked:
            known[p] = known[core] + marks[mark]
        known.update(zip(others, self._ids(others, False), strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > GENERATION:
            self.known, self.older = {}, self.known
        if len(self.marks) > GENERATION:
            self.marks = {}
        known, older = self.known, self.older
        # a special token's text keeps its case, as the vocabulary reads it
        split = [t.split() if b"<|" in t else t.lower().split() for t in texts]
        out = [list(map(known.get, s)) for s in split]
        lacking = [(s, o, [k for k, x in enumerate(o) if x is None]) for s, o in zip(split, out, strict=True) if None in o]
        if lacking:
            new = {s[k] for s, _, at in lacking for k in at}
            known.update((p, older[p]) for p in new if p in older)
            self.learn([p for p in new if p not in older])
            for s, o, at in lacking:
                for k in at:
                    o[k] = known[s[k]]
        return [b"".join(o) for o in out]


def _lower_letters(core: bytes) -> bool:
    """Letters that lower-casing and composing leave as they are."""
    if core.isascii():
        return False
    text = core.decode("utf-8", "replace")
    return text.isalpha() and text.islower() and unicodedata.is_normalized("NFC", text)


def encoder(path: str) -> Encoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Encoder(path)
    return _TOKENIZERS[path]


def cuts(places: np.ndarray, kinds: np.ndarray, size: int) -> list[int]:
    """The cheapest cut places. ``places`` ascend and end with the run's end;
    ``kinds`` holds each place's penalty. No two neighbours (and 0) are more
    than ``size`` apart."""
    at = [0, *places.tolist()]
    penalty = [0, *kinds.tolist()]
    n = len(at)
    cost = [0] * n
    back = [0] * n
    queue: deque[int] = deque([0])
    for j in range(1, n):
        p = at[j]
        while p - at[queue[0]] > size:
            queue.popleft()
        i = queue[0]
        back[j] = i
        c = cost[j] = cost[i] + at[i] + size - p + penalty[j]
        key = c + p
        while queue and cost[queue[-1]] + at[queue[-1]] > key:
            queue.pop()
        queue.append(j)
    out = []
    j = n - 1
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


def powers_of_two(n: int) -> list[int]:
    """Lengths that add up to n, longest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Packs one partition's documents; rows come out as blocks are solved."""

    def __init__(self, first_sequence: int, size: int, ends: np.ndarray):
        self.size, self.ends, self.sequence = size, ends, first_sequence
        self.docs: list[tuple] = []  # (doc_id, ids, start of what is left)
        self.tokens = 0

    def add(self, doc_id, ids: bytes):
        self.docs.append((doc_id, ids, 0))
        self.tokens += len(ids) // 4
        if self.tokens >= BLOCK:
            yield from self.solve(False)

    def solve(self, last: bool):
        if not self.docs:
            return
        size, docs = self.size, self.docs
        lengths = np.array([len(d[1]) // 4 - d[2] for d in docs])
        ends = np.cumsum(lengths)
        ids = np.frombuffer(b"".join(d[1][d[2] * 4 :] if d[2] else d[1] for d in docs), dtype="<u4")
        kind = np.full(len(ids) + 1, -1, dtype=np.int64)
        kind[np.flatnonzero(self.ends[np.minimum(ids, len(self.ends) - 1)]) + 1] = SENTENCE
        kind[ends] = 0
        middle = np.arange(STEP, len(ids), STEP)
        kind[middle[kind[middle] < 0]] = MIDDLE
        places = np.flatnonzero(kind >= 0)
        found = cuts(places, kind[places], size)
        if not last:  # the end of the block is no true end
            found = found[:-1]
        elif found:
            start = found[-2] if len(found) > 1 else 0
            rest = found[-1] - start
            found[-1:] = (start + np.cumsum(powers_of_two(rest))).tolist()
        yield from self.emit(found, ends)
        done = found[-1] if found else 0
        keep = int(np.searchsorted(ends, done, side="right"))
        left = docs[keep:]
        if left:
            used = int(done - (ends[keep] - lengths[keep]))
            d, b, s = left[0]
            left[0] = (d, b, s + max(0, used))
        self.docs, self.tokens = left, int(ends[-1]) - done

    def emit(self, found: list[int], ends: np.ndarray):
        docs, i, at = self.docs, 0, 0
        for cut in found:
            offset = 0
            while at < cut:
                while ends[i] <= at:
                    i += 1
                d, b, s = docs[i]
                begin = s + (at - (int(ends[i - 1]) if i else 0))
                stop = min(cut, int(ends[i]))
                n = stop - at
                yield d, begin, n, zlib.crc32(b[begin * 4 : (begin + n) * 4]), len(b) // 4, self.sequence, offset
                offset += n
                at = stop
            self.sequence += 1


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _pack(path: str, size: int, id_type: pa.DataType):
    def run(batches):
        # a worker may come from another stage: give back what that one's batches took
        pa.default_memory_pool().release_unused()
        enc = encoder(path)
        packer = Packer(TaskContext.get().partitionId() << 40, size, enc.ends)
        end = np.array([END_ID], dtype="<u4").tobytes()
        rows: list[tuple] = []

        def flush():
            cols = list(zip(*rows, strict=True))
            types = [id_type, *[pa.int64()] * 6]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], COLUMNS)

        for batch in batches:
            for part in pieces(batch, 128):
                for doc_id, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist()), strict=True):
                    rows.extend(packer.add(doc_id, ids + end))
                if len(rows) >= 10_000:
                    yield flush()
        rows.extend(packer.solve(True))
        if rows:
            yield flush()
        pa.default_memory_pool().release_unused()

    return run


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, size: int = SIZE) -> DataFrame:
    """One row per piece of a document: where it starts there, its length, the
    CRC32 of its ids, the document's tokens, its sequence and offset."""
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), text_bytes(docs[text]).alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return own.mapInArrow(_pack(path or vocabulary_path(), size, pa.int64()), schema)
