"""Secret scan: keyword automaton, anchored expressions, embedded checksums.

An Aho-Corasick automaton finds the keywords of all kinds in one pass over the
text (ASCII letters in either case); a kind's expression is then matched only
at its keyword's place. Kinds that carry a checksum count only if it holds.
Long hexadecimal runs have no keyword; they are found by one scan for runs.

Kinds ``assign``, ``access`` and ``hex`` take the leftmost matches that do not
overlap within the kind and drop those that are too short afterwards. Further
kinds: ``github`` and ``npm`` tokens (last six characters are the base-62 CRC32
of the thirty before them), ``card`` (payment card numbers after a card word,
Luhn digit), ``iban`` (account numbers, modulo-97 check), ``key`` (private-key
header lines).

Defined results: null and empty texts have no span; positions count code
points; repeated rows are scanned each; other columns play no part.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import pieces

# Kinds, keywords and formats.
KINDS = ("assign", "access", "hex", "github", "npm", "card", "iban", "key")
BASE_KINDS = KINDS[:3]
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
NPM = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
CARD = re.compile(r"(?i:card|visa|mastercard|amex)(?i:\x20*(?:number|no\.?|nr\.?))?\x20*[:=#]?\x20*((?:[0-9][\x20-]?){12,18}[0-9])(?![0-9])", re.A)
IBAN = re.compile(r"(?i:iban)\x20*[:=]?\x20*([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})", re.A)
KEY = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign", "apikey": "assign",
    "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm",
    "card": "card", "visa": "card", "amex": "card", "iban": "iban", "-----begin ": "key",
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
EXPRESSIONS = {"assign": ASSIGN, "access": ACCESS, "github": GITHUB, "npm": NPM, "card": CARD, "iban": IBAN, "key": KEY}


def crc_tail_ok(token: str) -> bool:
    """Six base-62 digits of the CRC32 of the thirty characters before them."""
    body, want = token[-36:-6], token[-6:]
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out == want


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _valid(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[1]) >= 6
    if kind == "access":
        return len(m[0]) >= 20
    if kind in ("github", "npm"):
        return crc_tail_ok(m[0])
    if kind == "card":
        return luhn_ok(re.sub(r"[^0-9]", "", m[1]))
    if kind == "iban":
        return iban_ok(m[1])
    return True


_AUTOMATON: list = []


def automaton():
    """The keyword automaton, built once per worker."""
    if not _AUTOMATON:
        import ahocorasick

        a = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            a.add_word(word, (kind, len(word)))
        a.make_automaton()
        _AUTOMATON.append(a)
    return _AUTOMATON[0]


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start and then in the order of ``KINDS``."""
    # ASCII letters only, so that positions stay
    low = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    free = dict.fromkeys(EXPRESSIONS, 0)
    found = []
    hits = [(end - n + 1, kind) for end, (kind, n) in automaton().iter(low)]
    hits.sort()
    for at, kind in hits:
        if at < free[kind]:
            continue
        m = EXPRESSIONS[kind].match(text, at)
        if m:
            free[kind] = m.end()
            if _valid(kind, m):
                found.append((at, m.end(), kind))
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found


def render(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long"


def _scan(batches):
    for batch in batches:
        for part in pieces(batch):
            got = [spans(t) for t in part.column(1).to_pylist()]
            base = [[s for s in g if s[2] in BASE_KINDS] for g in got]
            count = lambda kind: pa.array([sum(s[2] == kind for s in b) for b in base], pa.int64())  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    *map(count, BASE_KINDS),
                    pa.array([hashlib.sha256(render(b).encode()).hexdigest() for b in base], pa.string()),
                    pa.array([render(g) for g in got], pa.string()),
                    pa.array([len(g) for g in got], pa.int64()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans"],
            )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its spans."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return own.mapInArrow(_scan, SCHEMA)
