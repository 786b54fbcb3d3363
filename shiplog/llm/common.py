"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.session import freeze  # noqa: F401  (re-exported for the operators)

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
#: Words per shingle and similarity of a near copy, for every shingle operator.
SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Largest side, in bytes, that an operator asks Spark to broadcast.
BROADCAST_BYTES = 32 << 20


def checked(side: DataFrame, row_bytes: int) -> DataFrame:
    """``side`` (a stored table) marked for broadcast if its rows, of at most
    ``row_bytes`` each, fit the bound; otherwise as it is, for a shuffle join."""
    return F.broadcast(side) if side.count() * row_bytes <= BROADCAST_BYTES else side


def share_package(spark: SparkSession) -> None:
    """Let Python workers of this session import the library.

    On a cluster the library is installed or shipped with ``--py-files``; in a
    local session the workers only need the folder on their ``PYTHONPATH``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([root, *parts])


def text_bytes(column: str | Column) -> Column:
    """UTF-8 bytes of a text column; null counts as the empty text."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col.cast("string"), F.lit("")).cast("binary")


def crc_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (xor-shift multiply)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base odd)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.full(size, U64(b), dtype=U64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _POWERS[base] = have = (out[0], out[1])
    return have[0][:n], have[1][:n]


def prefix_hash(values: np.ndarray, base: int) -> np.ndarray:
    """H with H[j] - H[i] = sum of values[i:j] times base**position."""
    p, _ = powers(base, len(values))
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * p, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Position-free hash of the spans [start, end)."""
    _, inv = powers(base, len(prefix))
    return (prefix[end] - prefix[start]) * inv[start]


BASE_A = 0x9E3779B97F4A7C55
BASE_B = 0xD6E8FEB86659FD93
_BYTE = mix(np.arange(1, 257, dtype=U64) * GOLDEN)
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text: runs of letters, digits and any
    non-ASCII characters of the lower-cased text."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=U64)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = _WORD[raw]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = span_hash(prefix_hash(_BYTE[raw], BASE_A), start, end, BASE_A)
    return mix(h ^ ((end - start).astype(U64) * GOLDEN))


def shingle_hashes(words: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of every run of ``k`` words; a shorter text is one shingle."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    at = np.arange(n - k + 1)
    return mix(span_hash(prefix_hash(words, BASE_B), at, at + k, BASE_B))


def pieces(batch: pa.RecordBatch, step: int = 256):
    """Slices of a record batch, so that Python lists stay small."""
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)
