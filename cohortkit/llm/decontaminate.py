"""Benchmark decontamination: a broadcast set of normalised test n-grams, scanned over token windows.

The windows of the benchmark are broadcast as a sorted array of 64-bit hashes beside the items' normalised
words; a document window whose hash is in the set is compared with the item's words, so hits are exact.  What
is broadcast is bounded (``BLOCK_BYTES``, by the bytes of the arrays): a larger benchmark is cut into blocks by
a hash of its items, each block is one pass over the documents, and its hits alone are written; the hits of a
document are merged at the end.  One block, the usual case, is a single scan without a shuffle.

Cases: a null or word-free text has no words and no hits; a null or word-free item has no windows; an
item with a null id counts for hits and spans, but is in no list of ids;
repeated items and repeated documents are reported as they are (items by distinct id, documents one
row each); an empty table gives an empty or hit-free result; other columns pass through untouched, in
``find_leaks`` columns named as the results are replaced.  A block is whole items, so one item is the least
that is broadcast.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, kept, prepare, scratch, set_aside, staged, table, texts_of, to_arrow

#: Words in one window; an item of fewer words is one window.
WINDOW = 10
#: Bytes of one broadcast block: per word its text, its place and a window's hash and place, per item its id.
BLOCK_BYTES = 32 << 20
WORD_BYTES, ITEM_BYTES = 4 + 8 + 4 + 4, 96
#: Words whose hashes a worker keeps.
CACHE_WORDS = 300_000
#: Buckets of the hash by which items are dealt to blocks.
BUCKETS = 64
#: Words of lower-cased text: digits, a-z and all code points above 127 (in UTF-8: all bytes above 127).
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: The same for Spark, to count them.
WORDS_IN_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
U = np.uint64

HIT_FIELDS = ("bench_words int, bench_hit int, bench_items array<string>, "
              "bench_spans array<struct<start:int,end:int>>")
OUT = [pa.field("bench_words", pa.int32()), pa.field("bench_hit", pa.int32()),
       pa.field("bench_items", pa.list_(pa.string())),
       pa.field("bench_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]


def words_of(data: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased (bytes.lower touches ASCII only)."""
    return WORD.findall(data.lower())


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def window_hashes(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of ``size`` words that begin at ``starts``, from the hashes of the words."""
    out = np.full(len(starts), size, U)
    for k in range(size):
        out = mixed(out * U(0x9E3779B97F4A7C15) + words[starts + k])
    return out


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


@dataclass
class Block:
    """Windows of some items: compact arrays, a few times the size of the items' texts."""

    ids: list[str | None]
    text: bytes  # the items' words, with a blank after each
    begin: np.ndarray  # int64: where each word begins in ``text`` (one more at the end)
    first: np.ndarray  # int64: the first word of each item (one more at the end)
    vocabulary: np.ndarray  # uint64, sorted: hashes of the words
    hashes: dict[int, np.ndarray]  # window length -> sorted hashes
    places: dict[int, np.ndarray]  # window length -> first word of each window, in the order of the hashes

    def window(self, place: int, size: int) -> bytes:
        return self.text[self.begin[place]:self.begin[place + size]]

    def item(self, place: int) -> str | None:
        return self.ids[int(np.searchsorted(self.first, place, "right")) - 1]

    def nbytes(self) -> int:
        arrays = [self.begin, self.first, self.vocabulary, *self.hashes.values(), *self.places.values()]
        return len(self.text) + sum(a.nbytes for a in arrays) + 64 * len(self.ids)


def ngram_set(items: list[tuple[str | None, str]], window: int = WINDOW) -> Block:
    """The windows of one benchmark block."""
    kept_items = [(i, w) for i, w in ((i, words_of((t or "").encode())) for i, t in items) if w]
    flat = [w for _, words in kept_items for w in words]
    first = np.cumsum([0, *(len(w) for _, w in kept_items)])
    begin = np.cumsum([0, *(len(w) + 1 for w in flat)])
    numbers = {w: word_hash(w) for w in set(flat)}
    hashed = np.fromiter(map(numbers.__getitem__, flat), U, len(flat))
    by_size: dict[int, list[np.ndarray]] = defaultdict(list)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = min(window, b - a)
        by_size[n].append(np.arange(a, b - n + 1))
    hashes, places = {}, {}
    for n, parts in by_size.items():
        at = np.concatenate(parts)
        h = window_hashes(hashed, at, n)
        order = np.argsort(h, kind="stable")
        hashes[n], places[n] = h[order], at[order].astype(np.uint32 if len(flat) < 1 << 32 else np.int64)
    return Block([i for i, _ in kept_items], b"".join(w + b" " for w in flat), begin, first,
                 np.array(sorted(set(numbers.values())), U), hashes, places)


def scan(data: bytes, block: Block, cache: dict[bytes, int]) -> tuple[int, np.ndarray, set]:
    """(number of words, hit mark per word, ids of the items that occur) of one document.

    ``cache`` keeps the hash of each word in the block's vocabulary, 0 for others.
    """
    words = words_of(data)
    n, hit, found = len(words), np.zeros(len(words), bool), set()
    new = sorted(set(words).difference(cache))
    if new:
        own = np.fromiter(map(word_hash, new), U, len(new))
        at = np.minimum(np.searchsorted(block.vocabulary, own), max(len(block.vocabulary) - 1, 0))
        known = block.vocabulary[at] == own if len(block.vocabulary) else np.zeros(len(new), bool)
        cache.update(zip(new, np.where(known, own, U(0)).tolist(), strict=True))
    hashed = np.fromiter(map(cache.__getitem__, words), U, n)
    before = np.concatenate(([0], np.cumsum(hashed != 0)))
    for size, hashes in block.hashes.items():
        if size > n:
            continue
        starts = np.flatnonzero(before[size:] - before[:-size] == size)  # all words known
        if not len(starts):
            continue
        h = window_hashes(hashed, starts, size)
        low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        seen: dict[bytes, bool] = {}
        for k in np.flatnonzero(high > low).tolist():
            s = int(starts[k])
            own = b" ".join(words[s:s + size]) + b" "
            if own not in seen:  # exact: the window's own words
                same = [p for p in block.places[size][low[k]:high[k]].tolist() if block.window(p, size) == own]
                seen[own] = bool(same)
                found.update(map(block.item, same))
            if seen[own]:
                hit[s:s + size] = True
    return n, hit, found


def spans_of(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point spans of the runs of hit words."""
    if not hit.any():
        return []
    data, out, previous = text.encode(), [], False
    for m, h in zip(WORD.finditer(data.lower()), hit.tolist(), strict=True):
        if h and previous:
            out[-1][1] = m.end()
        elif h:
            out.append([m.start(), m.end()])
        previous = h
    chars = lambda b: len(data[:b].decode())
    return [(chars(a), chars(b)) for a, b in out]


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans by place, those that overlap or touch as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _words_in(text: str, spans: list[tuple[int, int]]) -> int:
    """Words inside united spans (spans begin and end at word borders)."""
    return sum(len(words_of(text[a:b].encode())) for a, b in spans)


def benchmark_blocks(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """(block, item_id, text) of the items that have a text, and the number of blocks.

    Items stand in the order of a hash; the broadcast bytes of those before an item give its block, so a block
    has ``block_bytes`` and its last item at most.  The running sums are taken within buckets of the hash.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    words = F.regexp_count(F.col("text"), F.lit(WORDS_IN_SQL))
    sized = items.select("item_id", "text", (F.octet_length("text") + words * WORD_BYTES + ITEM_BYTES).cast("long").alias("bytes"),
                         F.xxhash64("item_id", "text").alias("hash")).withColumn("bucket", F.pmod("hash", F.lit(BUCKETS)))
    sums = {r["bucket"]: r["bytes"] for r in sized.groupBy("bucket").agg(F.sum("bytes").alias("bytes")).collect()}
    total = sum(sums.values())
    if total <= block_bytes:
        return items.withColumn("block", F.lit(0)), 1
    before = dict(zip(sorted(sums), np.cumsum([0, *(sums[k] for k in sorted(sums))])[:-1].tolist(), strict=True))
    start = F.element_at(F.create_map(*[F.lit(x) for k in sorted(sums) for x in (k, before[k])]), F.col("bucket"))
    inside = F.sum("bytes").over(Window.partitionBy("bucket").orderBy("hash", "item_id", "text").rowsBetween(Window.unboundedPreceding, 0))
    block = F.floor((start + inside - F.col("bytes")) / block_bytes).cast("int")
    return sized.select(block.alias("block"), "item_id", "text"), -(-total // block_bytes)


def _held(spark: SparkSession, items: DataFrame, k: int, window: int):
    return spark.sparkContext.broadcast(ngram_set([(r["item_id"], r["text"]) for r in items.where(F.col("block") == k).collect()], window))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus ``bench_words``, ``bench_hit``, ``bench_items`` (ids as text) and ``bench_spans``.

    ``benchmark`` has ``item_id`` and ``text``. One pass over the documents for each block.
    """
    spark = prepare(docs.sparkSession)
    docs, back = set_aside(docs.drop(*RESULTS))
    items, blocks = benchmark_blocks(benchmark, block_bytes)
    if blocks == 1:
        return docs.mapInArrow(_scanner(_held(spark, items, 0, window), text), _schema(docs)).select(*back, *RESULTS)
    with scratch(spark) as made:
        items = staged(items, "benchmark-blocks")
        row = staged(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*docs.columns).alias("row"), F.col(text).alias("own")), "scanned")
        hits = None
        for k in range(blocks):
            held = _held(spark, items, k, window)
            part = staged(row.select("rid", "own").mapInArrow(_hit_rows(held), HIT_DDL), "hits")
            held.destroy()
            hits = part if hits is None else hits.unionByName(part)
        found = hits.groupBy("rid").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        joined = row.join(found, "rid", "left").mapInArrow(_merged, f"row {row.schema['row'].dataType.simpleString()}, {HIT_FIELDS}")
        return kept(joined.select(*[F.col("row")[c].alias(c) for c in docs.columns], *RESULTS), "leaks", made).select(*back, *RESULTS)


RESULTS = [f.name for f in OUT]
HIT_DDL = "rid long, items array<string>, spans array<struct<start:int,end:int>>"
HITS = pa.schema([("rid", pa.int64()), ("items", pa.list_(pa.string())), ("spans", OUT[3].type)])


def _schema(df: DataFrame) -> str:
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return f"{own}, {HIT_FIELDS}"


def _scanner(held, text: str):
    """Results beside all columns of a document."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, cache = held.value, {}
        for b in batches(it):
            cols: list[list] = [[], [], [], []]
            for t in texts_of(b, text):
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                n, hit, found = scan(t.encode(), block, cache)
                spans = [{"start": x, "end": y} for x, y in _united(spans_of(t, hit))]
                for c, v in zip(cols, (n, int(hit.sum()), sorted(found - {None}), spans), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, f.type) for c, f in zip(cols, OUT, strict=True))],
                                             schema=pa.schema([*b.schema, *OUT]))
    return run


def _hit_rows(held):
    """The hits of the documents that have any, for one block of several."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, cache = held.value, {}
        for b in batches(it):
            rows: dict[str, list] = {f.name: [] for f in HITS}
            for rid, t in zip(b.column("rid").to_pylist(), texts_of(b, "own"), strict=True):
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                _, hit, found = scan(t.encode(), block, cache)
                if hit.any():
                    rows["rid"].append(rid)
                    rows["items"].append(sorted(found - {None}))
                    rows["spans"].append([{"start": x, "end": y} for x, y in spans_of(t, hit)])
            yield to_arrow(rows, HITS)
    return run


def _merged(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The results of documents from the hits of all blocks."""
    for b in batches(it):
        cols: list[list] = [[], [], [], []]
        for t, items, spans in zip(texts_of(b, "own"), b.column("items").to_pylist(), b.column("spans").to_pylist(), strict=True):
            united = _united([(x["start"], x["end"]) for x in spans or ()])
            values = (len(words_of(t.encode())), _words_in(t, united), items or [], [{"start": x, "end": y} for x, y in united])
            for c, v in zip(cols, values, strict=True):
                c.append(v)
        yield pa.RecordBatch.from_arrays([b.column("row"), *(pa.array(c, f.type) for c, f in zip(cols, OUT, strict=True))],
                                         schema=pa.schema([b.schema.field("row"), *OUT]))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns as they are."""
    inner, own = set_aside(docs, *RESULTS)
    return find_leaks(inner, benchmark).where("bench_hit = 0").select(*own)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the hit spans cut out (the rest joined by a line break each), all own columns kept."""
    inner, own = set_aside(docs, *RESULTS)
    cut = F.expr(f"""aggregate(reverse(bench_spans), coalesce(`{text}`, ''), (t, s) ->
        concat(substring(t, 1, s.start), '\n', substring(t, s.end + 1)))""")
    return find_leaks(inner, benchmark, text).withColumn(text, F.when(F.size("bench_spans") > 0, cut)
                                                         .otherwise(F.col(text))).select(*own)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, hit words and the benchmark items whose windows occur in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id", F.col("bench_words").cast("long").alias("n_words"), F.col("bench_hit").cast("long").alias("n_hit"),
        F.size("bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("bench_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("bench_hit") > 0).alias("contaminated"))


OP9_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
grams AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT rid, w, s.size, unnest(range(1, len(w) - s.size + 2)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM windows) s WHERE len(w) >= s.size)),
found AS (SELECT g.rid, g.i, g.size, x.item_id FROM grams g JOIN windows x USING (size, gram)),
hits AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS pos FROM found) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items,
          string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(x.n_items, 0)::BIGINT AS n_items, sha256(coalesce(x.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (rid) LEFT JOIN items x USING (rid)
"""
