"""Secret scans: a worklist of decoded layers, each scanned again, spans mapped to the text.

A text is the first layer. Every layer is scanned with the three patterns; then its URL escapes,
Unicode escapes, base64 runs and compressed payloads are unwrapped into new layers until none is new
(a digest of each layer and its place are kept, so cycles end). A decoded character carries the span of the text
that it came from, so what is found in any layer is reported in code points of the text itself.

Cases: a null text is empty and has no spans; repeated documents are scanned alike; other columns
pass through; base64 is read line by line and over line breaks, and of a run that is not text as a whole
the parts that are text or compressed at any of the four alignments; of other escapes, the valid ones
are decoded; payloads are read as UTF-8 or UTF-16, and of one that is neither as a whole (one bad byte is
enough) the runs that are text; a payload that holds no text is left alone.  A compressed payload is expanded
member by member, and beyond ``EXPAND_BYTES`` in overlapping windows of that size, each a layer of its own; an
encoded run at the end of a window is carried into the next one whole, so memory is a window and the longest
such run (one of over ``LONGEST_RUN`` is read in overlapping windows of that size).
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, prepare, set_aside, table, texts_of

KINDS = ("assign", "access", "hex")
EXPAND_BYTES = 64 << 20
#: Bytes expanded at a time, bytes that windows overlap by at least, and characters of encoded runs.
CHUNK = 1 << 20
OVERLAP = 1 << 16
LONGEST_RUN = 1 << 30
RUN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\{}&#;\r\n"

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9a-fA-F]{4}|\\u\{[0-9a-fA-F]{1,6}\}|\\U[0-9a-fA-F]{8}|\\x[0-9a-fA-F]{2}"
                    r"|&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};)")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: The same over line breaks (possessive, and from the start of a run only, so that the time stays linear).
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
BREAK = re.compile(r"\s+")
_WIDE = (rb"[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
         rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}")
VALID = re.compile(rb"(?:[\x00-\x7f]|" + _WIDE + rb")+")
#: Text inside other bytes, in UTF-8: twelve characters, as the shortest secret has.
TEXT = re.compile(rb"(?:[\t\n\r\f\x20-\x7f]|" + _WIDE + rb"){12,}")
#: The same in UTF-16, of characters of the first 127.
LITTLE = re.compile(rb"(?:[\t\n\r\f\x20-\x7e]\x00){12,}")
BIG = re.compile(rb"(?:\x00[\t\n\r\f\x20-\x7e]){12,}")
TEXTS = {TEXT: "utf-8", LITTLE: "utf-16-le", BIG: "utf-16-be"}
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def find(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the matches in one layer."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "key" in low:
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return out


class Layer:
    """A decoded text; character i came from code points first[i]..last[i] of the document (below 2^31)."""

    def __init__(self, text: str, first: np.ndarray | None = None, last: np.ndarray | None = None):
        self.text, self.first, self.last = text, first, last

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.first is None:
            return start, end
        return int(self.first[start]), int(self.last[end - 1])

    def cut(self, pieces: list[tuple[int, int, str, np.ndarray | None]]) -> Layer:
        """This layer with the spans of ``pieces`` (start, end, new text, source index) replaced."""
        texts, sources, at = [], [], 0
        for s, e, new, offsets in pieces:
            texts += [self.text[at:s], new]
            sources += [np.arange(at, s), np.full(len(new), s)] if offsets is None else [np.arange(at, s), s + offsets[:, 0]]
            at = e
        texts.append(self.text[at:])
        sources.append(np.arange(at, len(self.text)))
        begin = np.concatenate(sources).astype(np.int32)
        ends, at = [], 0
        for s, e, new, offsets in pieces:
            ends += [np.arange(at + 1, s + 1), np.full(len(new), e) if offsets is None else s + offsets[:, 1]]
            at = e
        ends.append(np.arange(at + 1, len(self.text) + 1))
        end = np.concatenate(ends).astype(np.int32)
        if self.first is not None:
            begin, end = self.first[begin], self.last[end - 1]
        return Layer("".join(texts), begin, end)

    def parts(self, pieces: list[tuple[int, int, str, np.ndarray]]) -> Layer:
        """The new texts of ``pieces`` alone, one after the other."""
        begin = np.concatenate([s + offsets[:, 0] for s, _, _, offsets in pieces]).astype(np.int32)
        end = np.concatenate([s + offsets[:, 1] for s, _, _, offsets in pieces]).astype(np.int32)
        if self.first is not None:
            begin, end = self.first[begin], self.last[end - 1]
        return Layer("".join(new for _, _, new, _ in pieces), begin, end)

    def wide(self, large: list[tuple[int, int, bytes]]) -> Iterator[Layer]:
        """The windows of compressed payloads (start, end, bytes), each character from the whole payload."""
        for s, e, data in large:
            first, last = self.span(s, e)
            for text in windows(data):
                yield Layer(text, np.broadcast_to(np.int32(first), len(text)), np.broadcast_to(np.int32(last), len(text)))


def _opener(data: bytes):
    """A decompressor for a gzip, zlib, bzip2 or xz payload; None for anything else."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 6 and (data[0] * 256 + data[1]) % 31 == 0:
        return zlib.decompressobj(15)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if data[:6] == b"\xfd7zXZ\x00" else None


def chunks(data: bytes, left: list[int]) -> Iterator[bytes]:
    """The content of a compressed payload, member by member; ``left`` gets the number of bytes behind it."""
    whole = 0
    while (d := _opener(data)) is not None:
        fed = data
        try:
            while not d.eof:
                out = d.decompress(fed, CHUNK)
                fed = getattr(d, "unconsumed_tail", b"")
                if out:
                    yield out
                elif not fed:
                    left[:] = [0]
                    return  # a torn member
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            if not whole:
                raise
            break
        whole += 1
        left[:] = [len(d.unused_data)]
        data = d.unused_data.lstrip(b"\0")  # members may be padded


def expand(data: bytes) -> tuple[bytes | None, int]:
    """The content of a compressed payload and its end in ``data``; of a content over a window, the first bytes over it.

    None for anything else.
    """
    if _opener(data) is None:
        return None, 0
    left, parts, size = [0], [], 0
    try:
        for part in chunks(data, left):
            parts.append(part)
            size += len(part)
            if size > EXPAND_BYTES:
                break
    except (zlib.error, OSError, EOFError, lzma.LZMAError):
        return None, 0
    return b"".join(parts), len(data) - left[0]


def windows(data: bytes) -> Iterator[str]:
    """The texts of a compressed payload of any size, in windows that overlap by OVERLAP or by the whole run at their end."""
    held, fresh, run, more = bytearray(), 0, 0, chunks(data, [])
    while more is not None:
        try:
            part = next(more, None)
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            part = None
        if part is None:
            more = None
        else:
            held += part
            fresh += len(part)
            rest = len(part.rstrip(RUN))
            run = len(part) - rest if rest else run + len(part)  # bytes of the run that ends here
        # a window that is one run so far goes on until the run ends
        if fresh and (more is None or (fresh >= EXPAND_BYTES and run < fresh) or len(held) >= LONGEST_RUN + EXPAND_BYTES):
            start = next((i for i in range(min(4, len(held))) if held[i] & 0xC0 != 0x80), 0)
            window = bytes(held[start:])
            if text := as_text(window, False) or loose_text(window):
                yield text
            held, fresh = held[-max(min(run, LONGEST_RUN), OVERLAP):], 0
            run = min(run, len(held))


def as_text(data: bytes, final: bool = True) -> str | None:
    """Decoded bytes if they are text (UTF-8 without control characters other than white space).

    ``final``: a character that is not whole at the end counts as an error.
    """
    try:
        text = codecs.getincrementaldecoder("utf-8")().decode(data, final)
    except UnicodeDecodeError:
        return None
    odd = sum(1 for c in text if ord(c) < 32 and c not in "\t\n\r\f")
    return text if text and odd * 20 <= len(text) else None


def as_wide(data: bytes) -> str | None:
    """Decoded bytes if they are text in UTF-16 (told by a mark, or by zeros in every other byte of most characters)."""
    if len(data) < 8 or len(data) % 2:
        return None
    low, high = data[::2].count(0), data[1::2].count(0)
    if data[:2] == b"\xff\xfe" or (high * 4 >= len(data) and high > 2 * low):
        code = "utf-16-le"
    elif data[:2] == b"\xfe\xff" or (low * 4 >= len(data) and low > 2 * high):
        code = "utf-16-be"
    else:
        return None
    try:
        text = data.decode(code)
    except UnicodeDecodeError:
        return None
    odd = sum(1 for c in text if ord(c) < 32 and c not in "\t\n\r\f")
    return text if odd * 20 <= len(text) else None


def text_runs(data: bytes) -> list[re.Match]:
    """The runs of text inside other bytes, by place; of overlapping ones the first."""
    out: list[re.Match] = []
    for m in sorted((m for p in TEXTS for m in p.finditer(data)), key=lambda m: (m.start(), -m.end())):
        if not out or m.start() >= out[-1].end():
            out.append(m)
    return out


def loose_text(data: bytes) -> str | None:
    """The runs of text inside other bytes, what is between them as one mark each."""
    return "\ufffd".join(m[0].decode(TEXTS[m.re]) for m in text_runs(data)) or None


def _payload(data: bytes, step: tuple[int, int], large: list[bytes]) -> tuple[str, np.ndarray | None] | None:
    """(text, offsets of each character in the encoded run or None for the whole run) of decoded bytes.

    A compressed payload of more than a window is no text here, but put into ``large``.
    """
    inner, _ = expand(data)
    if inner is not None:
        if len(inner) > EXPAND_BYTES:
            large.append(data)
            return None
        text = as_text(inner) or as_wide(inner) or loose_text(inner)
        return None if text is None else (text, None)
    if (text := as_text(data)) is not None:
        return text, _offsets(text, step)
    return None if (text := as_wide(data)) is None else (text, _offsets(text, step, "utf-16-le"))


def _sizes(text: str, code: str) -> np.ndarray:
    """Bytes of each character."""
    return np.array([len(c.encode(code)) for c in text], np.int64)


def _offsets(text: str, step: tuple[int, int], code: str = "utf-8") -> np.ndarray:
    """First and last offset of each character in the encoded run."""
    sizes = _sizes(text, code)
    ends = np.cumsum(sizes)
    per, width = step  # so many decoded bytes come from so many characters
    return np.stack([(ends - sizes) // per * width, -(-ends // per) * width], 1)


def _url(m: re.Match, large: list[tuple[int, int, bytes]]) -> tuple[int, int, str, np.ndarray | None] | None:
    data, much = bytes.fromhex(m[0].replace("%", "")), []
    found = _payload(data, (1, 3), much)
    if found is not None:
        return m.start(), m.end(), *found
    large += [(m.start(), m.end(), x) for x in much]
    texts, offsets, at = [], [], 0  # the valid characters decoded, other bytes as they stand
    for part in [*VALID.finditer(data), None]:
        start, good = (part.start(), part[0].decode()) if part else (len(data), "")
        places = np.arange(at * 3, start * 3)
        texts += [m[0][at * 3:start * 3], good]
        offsets += [np.stack([places, places + 1], 1), _offsets(good, (1, 3)) + start * 3]
        at = part.end() if part else start
    text = "".join(texts)
    return None if text == m[0] else (m.start(), m.end(), text, np.concatenate(offsets))


def _code(s: str) -> int:
    return int(s[3:-1], 16) if s[1] in "uU#" and s[2] in "{xX" and s[-1] in "};" else int(s[2:-1]) if s[0] == "&" else int(s[2:], 16)


def _escape(run: list[re.Match]) -> tuple[int, int, str, np.ndarray | None]:
    units, offsets, base = [], [], run[0].start()
    for m in run:
        code = _code(m[0])
        if 0xDC00 <= code < 0xE000 and units and 0xD800 <= units[-1] < 0xDC00:
            units[-1] = 0x10000 + ((units[-1] - 0xD800) << 10) + (code - 0xDC00)
            offsets[-1][1] = m.end() - base
        else:
            units.append(code)
            offsets.append([m.start() - base, m.end() - base])
    text = "".join("�" if 0xD800 <= u < 0xE000 else chr(u) for u in units)
    return base, run[-1].end(), text, np.array(offsets)


def _decoded(body: str) -> bytes:
    body = body[:len(body) - (len(body) % 4 == 1)].replace("-", "+").replace("_", "/")
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _base64(body: str, at: np.ndarray, end: int, large: list[tuple[int, int, bytes]]) -> tuple[int, int, str, np.ndarray | None] | None:
    """A whole base64 run that is text; ``at``: places of its characters in the layer, which it leaves at ``end``."""
    much: list[bytes] = []
    if len(body) % 4 == 1 or (found := _payload(_decoded(body), (3, 4), much)) is None:
        large += [(int(at[0]), end, x) for x in much]
        return None
    text, offsets = found
    if offsets is not None:
        ends = np.append(at[1:], end)
        offsets = np.stack([at[offsets[:, 0]], np.where(offsets[:, 1] > len(body), end, ends[np.minimum(offsets[:, 1], len(body)) - 1])], 1) - at[0]
    return int(at[0]), end, text, offsets


def _aligned(body: str, at: np.ndarray, end: int, skip: int, large: list[tuple[int, int, bytes]]) -> tuple[int, int, str, np.ndarray | None] | None:
    """The texts and compressed payloads inside a base64 run from its character ``skip`` on; what is between is one mark."""
    data = _decoded(body[skip:])
    texts, offsets, done = [], [], 0

    def place(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return np.stack([at[skip + first // 3 * 4], at[np.minimum(skip - (-last // 3) * 4, len(body)) - 1] + 1], 1) - at[0]

    def take(start: int, stop: int, text: str, code: str | None) -> None:
        nonlocal done
        texts.append("�" + text)
        offsets.append(place(np.array([min(done, start)]), np.array([max(start, 1)])))
        sizes = _sizes(text, code) if code else np.zeros(len(text), np.int64)
        ends = start + np.cumsum(sizes)
        offsets.append(place(ends - sizes, ends) if code else place(np.full(len(text), start), np.full(len(text), stop)))
        done = stop

    for m in sorted([*text_runs(data), *MAGIC.finditer(data)], key=lambda m: (m.start(), m.end())):
        if m.re is MAGIC and m.start() >= done:
            inner, stop = expand(data[m.start():])
            if inner and len(inner) > EXPAND_BYTES:
                if skip or m.start() or len(body) % 4 == 1:  # else it is known as a whole
                    first, last = place(np.array([m.start()]), np.array([len(data)]))[0] + at[0]
                    large.append((int(first), int(last), data[m.start():]))
            elif inner and (text := as_text(inner) or as_wide(inner) or loose_text(inner)):
                take(m.start(), m.start() + stop, text, None)
        elif m.re is not MAGIC and m.start() >= done:
            take(m.start(), m.end(), m[0].decode(TEXTS[m.re]), TEXTS[m.re])
    return (int(at[0]), end, "".join(texts), np.concatenate(offsets)) if texts else None


def _runs(runs: list[tuple[str, np.ndarray, int]], layer: Layer) -> Iterator[Layer]:
    """The layers of base64 runs: those that are text as a whole, and the parts of the others at the four alignments."""
    large: list[tuple[int, int, bytes]] = []
    found = [_base64(*x, large) for x in runs]
    if pieces := [p for p in found if p]:
        yield layer.cut(pieces)
    rest = [x for x, p in zip(runs, found, strict=True) if not p]
    if pieces := [p for x in rest for skip in range(4) if (p := _aligned(*x, skip, large))]:
        yield layer.parts(pieces)
    yield from layer.wide(large)


def _unbroken(m: re.Match) -> tuple[str, np.ndarray, int]:
    body = m[0].rstrip("=")
    return body, np.arange(m.start(), m.start() + len(body)), m.end()


def _joined_lines(m: re.Match) -> tuple[str, np.ndarray, int]:
    lines, places, at = [], [], 0
    body = m[0].rstrip("=")
    for b in [*BREAK.finditer(body), None]:
        stop = b.start() if b else len(body)
        lines.append(body[at:stop])
        places.append(np.arange(m.start() + at, m.start() + stop))
        at = b.end() if b else stop
    return "".join(lines), np.concatenate(places), m.end()


def unwrap(layer: Layer) -> Iterator[Layer]:
    """The layers directly inside one layer: of each kind of wrapping, and each reading of base64, that it holds."""
    t = layer.text
    if "%" in t:
        large: list[tuple[int, int, bytes]] = []
        if pieces := [p for m in URL.finditer(t) if (p := _url(m, large))]:
            yield layer.cut(pieces)
        yield from layer.wide(large)
    if ("\\" in t or "&#" in t) and (found := [m for m in ESCAPE.finditer(t) if _code(m[0]) <= 0x10FFFF]):
        runs: list[list[re.Match]] = []
        for m in found:
            if runs and runs[-1][-1].end() == m.start():
                runs[-1].append(m)
            else:
                runs.append([m])
        yield layer.cut([_escape(x) for x in runs])
    if runs64 := [_unbroken(m) for m in BASE64.finditer(t)]:
        yield from _runs(runs64, layer)
        if lines := [_joined_lines(m) for m in WRAPPED.finditer(t)]:
            yield from _runs(lines, layer)


def scan(text: str) -> tuple[list[tuple[int, int, int]], set[tuple[int, int, int]]]:
    """(spans of the text itself, spans of all layers), as (kind number, start, end) in code points."""
    base = find(text)
    spans, work, seen = set(base), [Layer(text)], {(hashlib.md5(text.encode("utf-8", "surrogatepass")).digest(), 0, len(text))}
    while work:
        for inner in unwrap(work.pop()):
            mark = (hashlib.md5(inner.text.encode("utf-8", "surrogatepass")).digest(), *inner.span(0, len(inner.text)))
            if mark not in seen:
                seen.add(mark)
                spans |= {(k, *inner.span(s, e)) for k, s, e in find(inner.text)}
                work.append(inner)
    return base, spans


def _listed(spans) -> list[dict]:
    return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(spans, key=lambda x: (x[1], x[0], x[2]))]


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``base_spans`` and ``secret_spans``: arrays of (kind, start, end) by start, then kind."""
    prepare(docs.sparkSession)
    docs, back = set_aside(docs.drop("base_spans", "secret_spans"))
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    kind = "array<struct<kind:string,start:int,end:int>>"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            base, every = [], []
            for t in texts_of(b, text):
                plain, spans = scan(t)
                base.append(_listed(plain))
                every.append(_listed(spans))
            more = [pa.field("base_spans", pa.list_(SPAN)), pa.field("secret_spans", pa.list_(SPAN))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(base, more[0].type), pa.array(every, more[1].type)],
                                             schema=pa.schema([*b.schema, *more]))

    return docs.mapInArrow(run, f"{own}, base_spans {kind}, secret_spans {kind}").select(*back, "base_spans", "secret_spans")


def redact(docs: DataFrame, text: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span (overlaps merged) replaced by ``mark`` and ``n_chars`` renewed; all own columns stay."""
    docs, own = set_aside(docs, "base_spans", "secret_spans")
    merged = F.expr("""aggregate(secret_spans, cast(array() as array<struct<start:int,end:int>>), (m, s) ->
        if(size(m) > 0 and s.start <= element_at(m, -1).end,
           concat(slice(m, 1, size(m) - 1), array(named_struct('start', element_at(m, -1).start,
                  'end', greatest(element_at(m, -1).end, s.end)))),
           concat(m, array(named_struct('start', s.start, 'end', s.end)))))""")
    cut = F.aggregate(F.reverse(merged), F.col(text), lambda t, s: F.concat(
        F.substring(t, F.lit(1), s["start"]), F.lit(mark), F.substring(t, s["end"] + 1, F.length(t))))
    out = find_secrets(docs, text).withColumn(text, F.when(F.size("secret_spans") > 0, cut).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("secret_spans") > 0, F.length(text)).otherwise(F.col("n_chars")))
    return out.select(*own)


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts by kind and a digest of the plain spans, and all spans with those of decoded layers."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS),
                        F.sha2(_joined("base_spans").cast("binary"), 256).alias("base_sha256"),
                        _joined("secret_spans").alias("spans"))
