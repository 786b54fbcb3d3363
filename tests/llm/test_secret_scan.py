"""Secret scan against plain expressions."""

import hashlib
import random
import re
import zlib

from shiplog.llm import secret_scan as S

BASE = {
    "assign": re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def brute(text):
    out = []
    for kind, x in BASE.items():
        for m in x.finditer(text):
            if (kind == "assign" and len(m[2]) >= 6) or (kind == "access" and len(m[0]) >= 20) or (kind == "hex" and len(m[0]) >= 24):
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda x: (x[0], list(BASE).index(x[2])))


def token(prefix, body):
    n, tail = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        tail = S.BASE62[d] + tail
    return prefix + body + tail


def test_base_kinds_match_plain_expressions():
    r = random.Random(1)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc", "a1b2c3d4", "deadbeef" * 3, "AKIA", "ABCD1234" * 2, "é", "İ", "ſecret", "\n", "Kelvin", "x=="]
    for _ in range(3000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert [s for s in S.spans(text) if s[2] in S.BASE_KINDS] == brute(text), text


def test_checksums():
    good = token("ghp_", "aZ" * 15)
    assert [k for *_, k in S.spans(f"x {good} y")] == ["github"]
    assert S.spans(good[:-1] + ("0" if good[-1] != "0" else "1")) == []
    assert [k for *_, k in S.spans(token("npm_", "Zx9" * 10))] == ["npm"]
    assert [k for *_, k in S.spans("Card number: 4111 1111 1111 1111.")] == ["card"]
    assert S.spans("card 4111 1111 1111 1112") == []
    assert [k for *_, k in S.spans("IBAN: GB82 WEST 1234 5698 7654 32")] == ["iban"]
    assert S.spans("IBAN: GB82 WEST 1234 5698 7654 33") == []
    assert [k for *_, k in S.spans("-----BEGIN RSA PRIVATE KEY-----")] == ["key"]


def test_rows(spark, odd, empty):
    df = spark.createDataFrame([(1, 'é "token": "abcdef1" AKIA' + "A" * 16)], "doc_id long, text string")
    x = S.scan(df).first()
    assert (x.n_assign, x.n_access, x.n_hex) == (1, 1, 0)
    assert x.spans == "assign:3:19,access:21:41"
    assert x.base_sha256 == hashlib.sha256(x.spans.encode()).hexdigest()
    rows = S.scan(odd).collect()
    assert len(rows) == 8 and all(r.spans == "" for r in rows)
    assert S.scan(empty).count() == 0
