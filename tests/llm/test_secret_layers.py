"""op4: payloads with bad bytes, other encodings, runs over window borders, and layers against a plain unwrapper."""

import base64
import bz2
import gzip
import lzma
import random
import re
import zlib
from urllib.parse import quote, unquote_to_bytes

import pytest

from cohortkit.llm import secrets as S

SECRET = "password=hunter2222 AKIA" + "Z" * 16
PACKS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress]


@pytest.mark.parametrize("pack", PACKS)
@pytest.mark.parametrize("bad", [b"caf\xe9 ", b"\x00\x01\x02\x03\xff", b"\xff\xfe\xff "])
def test_one_bad_byte_loses_no_layer(pack, bad):
    filler = " ".join(str(i * 7919 % 1000) for i in range(60)).encode()
    for data in (bad + SECRET.encode() + b" tail", filler + b" " + SECRET.encode() + b" " + bad + filler):
        coded = base64.b64encode(pack(data)).decode()
        for text in (f"a {coded} b", f"a /run/{coded} b", "a " + "".join(f"%{x:02x}" for x in pack(data)) + " b"):
            spans = S.scan(text)[1]
            assert {k for k, _, _ in spans} >= {0, 1}, text
            assert all(2 <= s < e <= len(text) - 2 for _, s, e in spans)


@pytest.mark.parametrize("code", ["utf-16-le", "utf-16-be", "utf-16"])
def test_utf_16_payloads(code):
    data = f"é {SECRET} and some more words 日本".encode(code)
    for wrapped in (base64.b64encode(data).decode(), base64.b64encode(b"\x80\x81\x02" + data).decode(), "".join(f"%{x:02X}" for x in data),
                    base64.b64encode(gzip.compress(data)).decode(), "blob_" + base64.b64encode(data).decode()):
        text = f"before {wrapped} after"
        spans = S.scan(text)[1]
        assert {k for k, _, _ in spans} >= {0, 1}, wrapped
        assert all(7 <= s < e <= len(text) - 6 for _, s, e in spans)


def test_utf_16_spans_point_at_their_characters():
    coded = base64.b64encode(("x" * 60 + " " + SECRET + " " + "y" * 60).encode("utf-16-le")).decode()
    start = min(s for k, s, _ in S.scan(coded)[1] if k == 0)
    assert abs(start - 61 * 2 * 4 // 3) <= 4


@pytest.mark.parametrize("pack", PACKS)
def test_runs_over_a_window_border(pack, monkeypatch):
    """A nested payload keeps its secret wherever the border of a window falls."""
    monkeypatch.setattr(S, "EXPAND_BYTES", 4096)
    monkeypatch.setattr(S, "CHUNK", 500)
    monkeypatch.setattr(S, "OVERLAP", 100)
    r = random.Random(1)
    noise = "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=4400))
    inner = base64.b64encode(gzip.compress(f"{noise} {SECRET} ".encode()))
    assert 3000 < len(inner) < 4200
    for before in (0, 500, 1000, 2000, 3000, 3800, 4096, 9000):
        data = (". " * before)[:before].encode() + b" " + inner + b" " + b"z. " * 3000
        text = "a " + base64.b64encode(pack(data)).decode() + " b"
        assert {k for k, _, _ in S.scan(text)[1]} >= {0, 1}, before


def test_a_run_of_many_windows_is_one(monkeypatch):
    monkeypatch.setattr(S, "EXPAND_BYTES", 2000)
    monkeypatch.setattr(S, "CHUNK", 300)
    monkeypatch.setattr(S, "OVERLAP", 50)
    inner = base64.b64encode(random.Random(2).randbytes(30_000) + SECRET.encode() + b"\xff" * 9)
    text = base64.b64encode(gzip.compress(b"x " * 700 + inner + b" y" * 900)).decode()
    assert {k for k, _, _ in S.scan(text)[1]} >= {0, 1}


# ---- whole layers against a plain unwrapper ----------------------------------

def plain_layers(text):
    """Texts reached by decoding whole tokens (URL, Unicode escapes, base64, compressed) until nothing is new."""
    seen, work = set(), [text]
    while work:
        t = work.pop()
        if t in seen:
            continue
        seen.add(t)
        if "%" in t:
            work.append(unquote_to_bytes(t).decode("utf-8", "replace"))
        work.append(re.sub(r"\\u([0-9a-f]{4})", lambda m: chr(int(m[1], 16)), t))
        for token in re.findall(r"[A-Za-z0-9+/]{16,}={0,2}", t):
            if len(token) % 4 == 0:
                data = base64.b64decode(token)
                for unpack in (lambda d: d, gzip.decompress, zlib.decompress, bz2.decompress, lzma.decompress):
                    try:
                        work.append(unpack(data).decode())
                    except Exception:
                        continue
    return seen


def test_every_layer_of_random_nestings_is_scanned():
    r = random.Random(4)
    wraps = [lambda s: quote(s, safe=""), lambda s: "".join(f"%{b:02x}" for b in s.encode()),
             lambda s: "".join(f"\\u{ord(c):04x}" for c in s), lambda s: base64.b64encode(s.encode()).decode(),
             *[lambda s, p=p: base64.b64encode(p(s.encode())).decode() for p in PACKS]]
    for n in range(60):
        inner = f"n{n} secret=abc{n:06d}x AKIA{n:016d}"
        text = inner
        for _ in range(r.randint(1, 4)):
            text = r.choice(wraps)(text)
        text = f"start {text} end"
        want = {S.KINDS.index(k) for t in plain_layers(text) for k in ("assign", "access")
                if re.search({"assign": r"secret=[a-z0-9]{6,}", "access": r"AKIA[0-9]{16}"}[k], t)}
        assert want == {0, 1}
        spans = S.scan(text)[1]
        assert {k for k, _, _ in spans} >= want
        assert all(0 <= s < e <= len(text) for _, s, e in spans)


def test_redaction_keeps_own_columns(spark):
    docs = spark.createDataFrame([(1, "token=abcdefgh", "mine", 5)], "doc_id long, text string, secret_spans string, base_spans int")
    assert [tuple(r) for r in S.redact(docs).collect()] == [(1, "[REDACTED]", "mine", 5)]
