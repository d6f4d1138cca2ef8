"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraph cells.

A text is cut into paragraph cells (lines, cut again after sentence ends and at ``CELL`` characters);
the k-th copy of a cell is an element of its own, so a text is a set of 64-bit digests, which hold the
cell's length in their low bits.  A sketch adds each digest to one cell of each of three ranges.  Two
sketches are subtracted and peeled: a cell that holds one digest gives it up, which frees others.  The
recovered digests are exactly the cells that only one text has, and give the likeness of the texts (shared
characters over all characters).  Where peeling stops early, both sketches are built four times larger; once they
are several times larger than both texts' cells and still don't peel (equal digests), the digests are compared as they are.

``neighbours`` pairs every document with the next one in ascending order of ids in one shuffle: ids
alone give range bounds, texts go to their range once, and the first document of each range is also
sent to the range before it.  An id with more rows than a range (the null id, say) is cut into ranges by a hash of
the texts.  Nothing is gathered but the bounds, one or two numbers per ``ROWS`` documents.

Cases: a null text is empty; a null id comes before all ids; rows with equal ids are ordered by a hash of their text,
so rows that are equal in both stand together, in one range; ids are BIGINT (other types are cast); a single
document is its own next one; two empty texts are alike (1.0); an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, prepare, table, to_arrow

#: Documents in one range, and ranges at most (their bounds are held by the driver).
ROWS, RANGES = 256, 200_000
#: Ranges that a task gets on average, so that its share does not depend on the size of the input.
TASK_RANGES = 24
CELL = 96
#: Cells of the stored sketch; growth on failure; sketch cells that one peeling holds in memory.
BASE, GROWTH, HELD = 24, 4, 1 << 21
PIECE = re.compile(rf"[^\n.!?]{{1,{CELL}}}[\n.!?]{{0,{CELL}}}\s?|[\n.!?]{{1,{CELL}}}\s?")
U = np.uint64
LEAST = -(1 << 63)
SEEDS = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0x27D4EB2F165667C5))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def digests(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(digests, first position per text) of lists of pieces; equal pieces of a text are numbered."""
    sizes = [len(t) for t in texts]
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    flat = [p for t in texts for p in t]
    h = np.fromiter((xxhash.xxh64_intdigest(p.encode()) for p in flat), np.uint64, len(flat))
    owner = np.repeat(np.arange(len(texts)), sizes)
    order = np.lexsort((h, owner))
    ho, oo = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (ho[1:] != ho[:-1]) | (oo[1:] != oo[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
    copy = np.empty(len(h), np.uint64)
    copy[order] = (np.arange(len(h)) - start).astype(np.uint64)
    length = np.fromiter((min(len(p), 65535) for p in flat), np.uint64, len(flat))
    return (mix(h + copy * SEEDS[0]) & ~U(0xFFFF)) | length, first


def places(keys: np.ndarray, size: int) -> np.ndarray:
    """(3, keys): the cell of each digest in each third of a sketch."""
    third = size // 3
    return np.stack([(mix(keys ^ (SEEDS[j] + U(size))) % U(third)).astype(np.int64) + j * third for j in range(3)])


def sketch(keys: np.ndarray, owner: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, digest sums, check sums), each n x size, of the digests of n texts."""
    count, total, check = np.zeros(n * size, np.int64), np.zeros(n * size, U), np.zeros(n * size, U)
    mark = mix(keys ^ SEEDS[3])
    for at in places(keys, size):
        at = owner * size + at
        np.add.at(count, at, 1)
        np.add.at(total, at, keys)
        np.add.at(check, at, mark)
    return count, total, check


def peel(count: np.ndarray, total: np.ndarray, check: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Peel n differences of sketches: (owner, digest, sign) of what is recovered, and the n successes."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    count, total, check = count.copy(), total.copy(), check.copy()
    cells = np.flatnonzero(np.abs(count) == 1)
    while len(cells):
        sign = count[cells]
        key = np.where(sign > 0, total[cells], U(0) - total[cells])
        mark = mix(key ^ SEEDS[3])
        pure = np.where(sign > 0, check[cells], U(0) - check[cells]) == mark
        owner, key, sign = cells[pure] // size, key[pure], sign[pure]
        _, once = np.unique(np.stack([owner.astype(U), key]), axis=1, return_index=True)
        owner, key, sign = owner[once], key[once], sign[once]
        if not len(owner):
            break
        found.append((owner, key, sign))
        mark, signed = mix(key ^ SEEDS[3]), sign > 0
        touched = []
        for at in places(key, size):
            at = owner * size + at
            np.subtract.at(count, at, sign)
            np.subtract.at(total, at, np.where(signed, key, U(0) - key))
            np.subtract.at(check, at, np.where(signed, mark, U(0) - mark))
            touched.append(at)
        cells = np.unique(np.concatenate(touched))
        cells = cells[np.abs(count[cells]) == 1]
    clear = ((count == 0) & (total == 0) & (check == 0)).reshape(-1, size).all(1)
    joined = [np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else ((), (), ()))]
    return (*joined, clear)


def take(keys: np.ndarray, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digests, position in ``rows``) of some texts."""
    sizes = first[rows + 1] - first[rows]
    owner = np.repeat(np.arange(len(rows)), sizes)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return keys[np.repeat(first[rows], sizes) + inside], owner


def differing(a: tuple, b: tuple, rows_a: np.ndarray, rows_b: np.ndarray, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Characters that only the first, and only the second text of each pair has, from peeled sketches."""
    only_a, only_b = np.zeros(len(rows_a), np.int64), np.zeros(len(rows_a), np.int64)
    todo, size = np.arange(len(rows_a)), base
    while len(todo):
        failed = []
        step = max(1, HELD // size)
        for s in range(0, len(todo), step):
            part = todo[s:s + step]
            xa = sketch(*take(*a, rows_a[part]), len(part), size)
            xb = sketch(*take(*b, rows_b[part]), len(part), size)
            owner, key, sign, clear = peel(*(p - q for p, q in zip(xa, xb, strict=True)), size)
            length = (key.astype(U) & U(0xFFFF)).astype(np.int64)
            good = clear[owner] if len(owner) else np.zeros(0, bool)
            np.add.at(only_a, part[owner[good & (sign > 0)]], length[good & (sign > 0)])
            np.add.at(only_b, part[owner[good & (sign < 0)]], length[good & (sign < 0)])
            failed.append(part[~clear])
        todo = np.concatenate(failed)
        cells = (a[1][rows_a[todo] + 1] - a[1][rows_a[todo]]) + (b[1][rows_b[todo] + 1] - b[1][rows_b[todo]])
        for i in todo[size > GROWTH * cells + base]:  # more room than any set of different digests needs
            only_a[i], only_b[i] = exactly(take(*a, rows_a[i:i + 1])[0], take(*b, rows_b[i:i + 1])[0])
        todo, size = todo[size <= GROWTH * cells + base], size * GROWTH
    return only_a, only_b


def exactly(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Characters that only the first, and only the second list of digests has, repeated ones counted as such."""
    keys, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    more = np.bincount(number[:len(a)], minlength=len(keys)) - np.bincount(number[len(a):], minlength=len(keys))
    length = (keys & U(0xFFFF)).astype(np.int64)
    return int((np.maximum(more, 0) * length).sum()), int((np.maximum(-more, 0) * length).sum())


def likeness(chars_a: np.ndarray, chars_b: np.ndarray, only_a: np.ndarray, only_b: np.ndarray) -> np.ndarray:
    """Shared characters over the characters of both texts; 1 for two empty texts."""
    union = chars_a + only_b
    return np.where(union > 0, (chars_a - only_a) / np.maximum(union, 1), 1.0)


def as_strings(keys: np.ndarray, first: np.ndarray) -> list[str]:
    """The stored sketches: counts (32 bits), digest sums (64) and check sums (32) of BASE cells, base64."""
    n = len(first) - 1
    count, total, check = sketch(keys, np.repeat(np.arange(n), np.diff(first)), n, BASE)
    rows = np.concatenate([x.reshape(n, -1).view(np.uint8) for x in (
        count.astype("<i4").reshape(n, BASE), total.astype("<u8").reshape(n, BASE), check.astype("<u4").reshape(n, BASE))], 1)
    return [base64.b64encode(r.tobytes()).decode() for r in rows]


def edited(text: str, other: str) -> tuple[str, int]:
    """The text with its last quarter replaced by as many first code points of the other; where that begins."""
    n = len(text) // 4
    return text[:len(text) - n] + other[:n], len(text) - n


def edited_pieces(pieces: list[str], text: str, cut: int) -> list[str]:
    """Pieces of an edited text: those before the change are kept, the rest is cut anew."""
    end, k = 0, 0
    while k < len(pieces) and end + len(pieces[k]) < cut:
        end += len(pieces[k])
        k += 1
    return pieces[:k] + PIECE.findall(text, end)


def _inside(keyed: DataFrame, bounds: list[int]) -> list[tuple[int, int]]:
    """(key, hash) bounds inside the keys that fill several ranges: as many as the key occurs in ``bounds``."""
    times = {k: n for k, n in Counter(bounds).items() if n > 1}
    if not times:
        return []
    most = max(times.values())
    found = keyed.where(F.col("key").isin(*times)).groupBy("key").agg(F.percentile_approx(
        "hash", [i / most for i in range(1, most)], max(10_000, 4 * most)).alias("hashes")).collect()
    return [(r["key"], h) for r in found for h in r["hashes"][::max(1, most // times[r["key"]])]]


def neighbours(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """Rows (part, guest, key, doc_id, text) such that each document is followed, within its part, by the
    next one; ``guest`` rows close a part and belong to another."""
    spark = prepare(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    ids = docs.select(key.alias("key"))
    n = ids.count()
    parts = max(1, min(RANGES, -(-n // rows)))
    bounds = sorted(ids.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)], max(10_000, 4 * parts))).first()[0] or []
                    ) if parts > 1 and n else []
    own = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    edges = sorted({(k, LEAST) for k in bounds} | set(_inside(docs.select(key.alias("key"), own.alias("hash")), bounds)))
    edge_key, edge_hash = np.array([k for k, _ in edges], np.int64), np.array([h for _, h in edges], np.int64)
    cut = own if len(edges) > len(set(bounds)) else F.lit(LEAST)  # without such ids, the texts aren't read for the bounds

    @F.pandas_udf("long")
    def part_of(k: pd.Series, h: pd.Series) -> pd.Series:
        low, high = np.searchsorted(edge_key, k.to_numpy(), "left"), np.searchsorted(edge_key, k.to_numpy(), "right")
        part = high.copy()
        for x in np.unique(low[high - low > 1]):
            rows = np.flatnonzero((low == x) & (high - low > 1))
            part[rows] = x + np.searchsorted(edge_hash[x:high[rows[0]]], h.to_numpy()[rows], "right")
        return pd.Series(part)

    dealt = docs.select(key.alias("key"), cut.cast("long").alias("cut"))
    firsts = sorted((r["part"], r["key"], r["cut"]) for r in dealt.groupBy(part_of("key", "cut").alias("part")).agg(
        F.min(F.struct("key", "cut")).alias("first")).select("part", "first.key", "first.cut").collect())
    before = {(k, h): firsts[i - 1][0] for i, (_, k, h) in enumerate(firsts)}

    @F.pandas_udf("long")
    def guest_of(k: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([before.get(x) for x in zip(k.tolist(), h.tolist(), strict=True)], dtype="Int64")

    home = F.struct(part_of("key", "cut").alias("part"), F.lit(0).alias("guest"))
    away = F.struct(guest_of("key", "cut").alias("part"), F.lit(1).alias("guest"))
    return (docs.select(key.alias("key"), cut.cast("long").alias("cut"), own.alias("hash"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("to", F.explode(F.array(home, away)))
            .where("to.part is not null").select("to.part", "to.guest", "key", "hash", "doc_id", "text")
            .repartition(max(1, -(-parts // TASK_RANGES)), "part").sortWithinPartitions("part", "guest", "key", "hash", "text"))


OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                 ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _fingerprints(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int | None, str, int]] = []
    for b in batches(it):
        rows = held + list(zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("guest").to_pylist(), strict=True))
        held = rows[-1:]
        own = np.array([i for i, r in enumerate(rows[:-1]) if not r[2]], np.int64)
        if not len(own):
            continue
        pieces = [PIECE.findall(r[1]) for r in rows]
        plain = digests(pieces)
        new, new_pieces = [], []
        for i in own:
            text, cut = edited(rows[i][1], rows[i + 1][1])
            new.append(text)
            new_pieces.append(edited_pieces(pieces[i], text, cut))
        changed = digests(new_pieces)
        chars = np.array([len(r[1]) for r in rows])
        mine, there = np.arange(len(own)), np.array([len(t) for t in new])
        near_edited = likeness(chars[own], there, *differing(plain, changed, own, mine))
        near_next = likeness(chars[own], chars[own + 1], *differing(plain, plain, own, own + 1))
        prints = as_strings(*plain)
        yield to_arrow({
            "doc_id": [rows[i][0] for i in own], "n_chars": chars[own].tolist(),
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in new],
            "fingerprint": [prints[i] for i in own], "edited_fingerprint": as_strings(*changed),
            "near_edited": near_edited.tolist(), "near_next": near_next.tolist()}, OUT)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: sketches of its text and its edited text, and the likenesses read from peeled sketches."""
    return neighbours(docs).mapInArrow(_fingerprints, DDL)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
