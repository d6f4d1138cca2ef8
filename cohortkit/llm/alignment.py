"""Cross-tokenizer alignment by divide and conquer at shared cuts, with corpus-wide counts of linked id pairs.

Two tokenizers cut the same bytes.  A range of tokens is divided at a common end near its middle: the ends of
the first tokenizer are tried from the middle outward, in doubling steps, each looked up among the ends of the
second by bisection; both sides of the cut that is found are divided in turn, and a range without any is a leaf.
What was tried on the way belongs to neither side, so each end is looked up about twice at most.  All ranges of
many texts are divided together, one step at a time.  The leaves are the groups, and all pairs of tokens of a group are links.

A task writes, for each text, its counts, a digest of its groups, and its distinct linked id pairs with how often
each is linked.  Spark counts the pairs (a grouped count, combined on the map side, so that no common pair is hot).
The counts of the most frequent pairs, a bounded number, are broadcast, and the written pairs are summed in place;
the rest are rare pairs by their order, and their occurrences are joined by a shuffle.  Nothing is cut: a text whose
links exceed ``PAIRS_AT_ONCE`` is done in parts by the first id, in rows of their own.

Cases: a null or empty text, or one that a tokenizer does not give back byte by byte, has no tokens (zeros, and
an empty digest); repeated rows are separate documents and count each; a null id is a row like others; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, prepare, staged, table, texts_of, to_arrow, worker_state
from cohortkit.llm.packing import CACHE_ENTRIES, TOKENIZER, Encoder

PIECES = "piece_bpe_32k.model"
#: Bytes of text that are aligned together, and id pairs that are held at once.
RUN_BYTES, PAIRS_AT_ONCE = 1 << 20, 4 << 20
#: Id pairs whose counts are broadcast (16 bytes each).
BROADCAST_PAIRS = 1 << 20
#: Groups of more links than this are reduced to their distinct ids first.
SMALL_GROUP = 64
BITS = 24  # of an id in a pair

OUT = pa.schema([("rid", pa.int64()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                 ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                 ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
DDL = ("rid long, part int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
       "pairs array<long>, times array<long>")
SUMMED = "rid long, part int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class Pieces:
    """Ids of texts by a piece model, which sets a blank before each; through a cache of words where that is exact."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.data = [bytes([int(n[3:-1], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.by_word = self._blanks_lead(path, names)
        self.cache: dict[str, bytes | None] = {}
        self.entries = entries

    @staticmethod
    def _blanks_lead(path: str, names: list[str]) -> bool:
        """Whether a word's pieces depend on the word alone: text is left as it is, and no piece goes on over a blank."""
        try:
            from sentencepiece import sentencepiece_model_pb2 as proto
        except ImportError:
            return False
        spec = proto.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        n, t = spec.normalizer_spec, spec.trainer_spec
        as_is = not n.precompiled_charsmap and n.add_dummy_prefix and not n.remove_extra_whitespaces
        return (as_is and n.escape_whitespaces and not t.treat_whitespace_as_suffix and t.model_type == t.BPE
                and not any("▁" in x[1:] and x.strip("▁") for x in names))

    def _slow(self, texts: list[str]) -> list[bytes | None]:
        """Ids, or None where the pieces' bytes are not those of a blank and the text."""
        out = []
        for t, ids in zip(texts, self.model.encode(texts, num_threads=1), strict=True):
            same = b"".join(map(self.data.__getitem__, ids)) == b" " + t.encode()
            out.append(np.asarray(ids, "<u4").tobytes() if same else None)
        return out

    def encode(self, texts: list[str]) -> list[bytes | None]:
        if len(self.cache) > self.entries:
            self.cache.clear()
        cache, cut = self.cache, [t.split(" ") if self.by_word else [""] for t in texts]
        missing = sorted({p for parts in cut for p in set(parts).difference(cache)} - {""})
        if missing:
            cache.update(zip(missing, self._slow(missing), strict=True))
        whole = [i for i, parts in enumerate(cut) if "" in parts]  # runs of blanks are pieces of their own
        entire = dict(zip(whole, self._slow([texts[i] for i in whole]), strict=True)) if whole else {}
        out = []
        for i, parts in enumerate(cut):
            if i in entire:
                out.append(entire[i])
                continue
            ids = list(map(cache.__getitem__, parts))
            out.append(None if None in ids else b"".join(ids))
        return out


class Tokenizers:
    """Both tokenizers of a worker, the bytes of each id, and the ids as texts with what may follow them."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Encoder(path_a), Pieces(path_b)
        known = self.a.token_bytes()
        size = 1 + max(known)
        self.bytes_a = [known.get(i, b"") for i in range(size)]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.b.data], np.int64)
        ids_a, ids_b = range(size), range(len(self.b.data))
        self.marks = ([f"{i}," for i in ids_a] + [f"{i}|" for i in ids_a] + [f"{i}," for i in ids_b] + [f"{i};" for i in ids_b])

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The ids of both, or None where a text has no tokens."""
        out = []
        for t, a, b in zip(texts, self.a.encode_after_blank(texts), self.b.encode(texts), strict=True):
            # a's bytes are the text's by its byte alphabet; an id outside of it leaves a gap
            same = t and b is not None and self.length_a[np.frombuffer(a, "<u4")].sum() == 1 + len(t.encode())
            out.append((a, b) if same else None)
        return out


def spread(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) of the ranges first[i] .. first[i] + sizes[i]."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner]


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Those of the tokens low[i] .. high[i] - 1 of the first tokenizer whose end is an end of the second, by divide and conquer."""
    found = []
    low, high = low[low < high], high[low < high]
    mid, tried, reach = (low + high) // 2, np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
    while len(low):
        # ends at distances tried .. reach from the middle that lie in the range
        a, b = np.maximum(low, mid - reach), np.minimum(high, mid + reach + 1)
        left = np.maximum(mid - tried + 1 - a, 0)
        start = mid + np.maximum(tried, 1)
        owner, at = spread(np.concatenate([a, start]), np.concatenate([left, np.maximum(b - start, 0)]))
        owner %= len(low)
        place = np.searchsorted(ends_b, ends_a[at])
        hit = ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[at]
        owner, at = owner[hit], at[hit]
        nearest = np.full(len(low), np.iinfo(np.int64).max)
        np.minimum.at(nearest, owner, 2 * np.abs(at - mid[owner]) + (at > mid[owner]))
        cut = nearest < np.iinfo(np.int64).max
        far, right = nearest[cut] // 2, nearest[cut] % 2
        m = mid[cut]
        found.append(np.where(right == 1, m + far, m - far))
        # on the left what lies before the cut, on the right what lies behind it, without the ends tried between
        new_low = np.concatenate([low[cut], np.where(right == 1, m + far + 1, m + np.maximum(far, 1))])
        new_high = np.concatenate([m - far, high[cut]])
        keep = new_low < new_high
        new_low, new_high = new_low[keep], new_high[keep]
        go = ~cut & ((mid - reach > low) | (mid + reach + 1 < high))
        zero = np.zeros(len(new_low), np.int64)
        tried = np.concatenate([zero, reach[go] + 1])
        reach = np.concatenate([zero, 2 * reach[go] + 1])
        mid = np.concatenate([(new_low + new_high) // 2, mid[go]])
        low, high = np.concatenate([new_low, low[go]]), np.concatenate([new_high, high[go]])
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


class Aligned:
    """The groups of some texts, given the ids of both tokenizers (texts with tokens only)."""

    def __init__(self, tokens: list[tuple[bytes, bytes]], tools: Tokenizers):
        self.a = np.frombuffer(b"".join(x for x, _ in tokens), "<u4").astype(np.int64)
        self.b = np.frombuffer(b"".join(y for _, y in tokens), "<u4").astype(np.int64)
        self.n_a = np.array([len(x) // 4 for x, _ in tokens], np.int64)
        self.n_b = np.array([len(y) // 4 for _, y in tokens], np.int64)
        ends_a, ends_b = np.cumsum(tools.length_a[self.a]), np.cumsum(tools.length_b[self.b])
        last = np.cumsum(self.n_a) - 1  # the end of each text is a shared cut
        self.cuts = np.sort(np.concatenate([last, shared_cuts(ends_a, ends_b, last - self.n_a + 1, last)]))
        cuts_b = np.searchsorted(ends_b, ends_a[self.cuts])
        self.size_a, self.size_b = np.diff(self.cuts, prepend=-1), np.diff(cuts_b, prepend=-1)
        self.owner = np.searchsorted(last, self.cuts)  # the text of each group
        self.group_a, self.group_b = np.repeat(np.arange(len(self.cuts)), self.size_a), np.repeat(np.arange(len(self.cuts)), self.size_b)
        self.marks, self.ids = tools.marks, (len(tools.length_a), len(tools.length_b))

    def digests(self) -> list[str]:
        """SHA-256 of the groups of each text, as ``a1,a2|b1;a3|b2,b3``."""
        ids_a, ids_b = self.ids
        before_b, before_a = np.cumsum(self.size_b) - self.size_b, np.cumsum(self.size_a)
        code = np.empty(len(self.a) + len(self.b), np.int64)
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[before_a - 1] = 1
        last_b[np.cumsum(self.size_b) - 1] = 1
        code[np.arange(len(self.a)) + before_b[self.group_a]] = self.a + ids_a * last_a
        code[np.arange(len(self.b)) + before_a[self.group_b]] = self.b + 2 * ids_a + ids_b * last_b
        out, at, marks = [], 0, self.marks.__getitem__
        for n in (self.n_a + self.n_b).tolist():
            text = "".join(map(marks, code[at:at + n].tolist()))
            out.append(hashlib.sha256(text[:-1].encode()).hexdigest())
            at += n
        return out

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(groups, links) of each text."""
        links = np.zeros(len(self.n_a), np.int64)
        np.add.at(links, self.owner, self.size_a * self.size_b)
        return np.bincount(self.owner, minlength=len(self.n_a)), links

    def linked(self, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, id pair, times linked), each pair of a text once, in parts by the first id."""
        large = self.size_a * self.size_b > SMALL_GROUP
        group_a, a, times_a = reduced(self.group_a, self.a, large)
        group_b, b, times_b = reduced(self.group_b, self.b, large)
        size_b = np.bincount(group_b, minlength=len(self.cuts))
        first_b = np.cumsum(size_b) - size_b
        parts = int(-(-size_b[group_a].sum() // at_once)) or 1
        mixed = a * 0x9E3779B1 % 0xFFFFFFFB % parts
        for p in range(parts):
            use = np.flatnonzero(mixed == p) if parts > 1 else np.arange(len(a))
            g = group_a[use]
            i, j = spread(first_b[g], size_b[g])
            pair = (self.owner[g][i] << (2 * BITS)) | (a[use][i] << BITS) | b[j]
            if large.any():
                order = np.argsort(pair, kind="stable")
                pair, times = pair[order], (times_a[use][i] * times_b[j])[order]
                new = np.flatnonzero(np.diff(pair, prepend=-1))
                pair, times = pair[new], np.add.reduceat(times, new) if len(new) else times
            else:
                pair, times = np.unique(pair, return_counts=True)
            yield pair >> (2 * BITS), pair & ((1 << 2 * BITS) - 1), times


def reduced(group: np.ndarray, ids: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times) by group: large groups with each id once, others as they are."""
    if not large.any():
        return group, ids, np.ones(len(ids), np.int64)
    much = large[group]
    key, n = np.unique((group[much] << BITS) | ids[much], return_counts=True)
    every = np.concatenate([group[~much], key >> BITS])
    order = np.argsort(every, kind="stable")
    return every[order], np.concatenate([ids[~much], key & ((1 << BITS) - 1)])[order], np.concatenate(
        [np.ones(int((~much).sum()), np.int64), n])[order]


def _rows(rids: list, doc_ids: list, tokens: list, tools: Tokenizers, at_once: int) -> Iterator[pa.RecordBatch]:
    """The output rows of some texts."""
    have = [i for i, t in enumerate(tokens) if t]
    columns = {f.name: [0] * len(rids) for f in OUT} | {
        "rid": rids, "doc_id": doc_ids, "groups_sha256": [""] * len(rids), "pairs": [[]] * len(rids), "times": [[]] * len(rids)}
    if not have:
        yield to_arrow(columns, OUT)
        return
    aligned = Aligned([tokens[i] for i in have], tools)
    groups, links = aligned.counts()
    for name, values in zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256"), (
            aligned.n_a, aligned.n_b, groups, links, aligned.digests()), strict=True):
        for i, v in zip(have, values, strict=True):
            columns[name][i] = v
    for part, (owner, pairs, times) in enumerate(aligned.linked(at_once)):
        ends = np.searchsorted(owner, np.arange(len(have) + 1))
        cut = [slice(x, y) for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        if part:
            some = [k for k, s in enumerate(cut) if s.start < s.stop]
            columns = {f.name: [0] * len(some) for f in OUT} | {
                "rid": [rids[have[k]] for k in some], "part": [part] * len(some), "doc_id": [None] * len(some),
                "groups_sha256": [None] * len(some), "pairs": [pairs[cut[k]] for k in some], "times": [times[cut[k]] for k in some]}
        else:
            columns["pairs"], columns["times"] = list(columns["pairs"]), list(columns["times"])
            for i, s in zip(have, cut, strict=True):
                columns["pairs"][i], columns["times"][i] = pairs[s], times[s]
        yield to_arrow(columns, OUT)


def aligned_rows(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """A row for each document (``part`` 0): counts, digest of its groups, and its distinct linked id pairs (first id
    above, second in the low 24 bits) with their times; further pairs of very long texts in rows of parts 1 ..."""
    prepare(docs.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers

        paths = path_a or public_tokenizers.path(TOKENIZER), path_b or public_tokenizers.path(PIECES)
        state = worker_state()
        if ("alignment", *paths) not in state:
            state["alignment", *paths] = Tokenizers(*paths)
        tools = state["alignment", *paths]
        for b in batches(it):
            texts, rids, ids = texts_of(b, "text"), b.column("rid").to_pylist(), b.column("doc_id").to_pylist()
            tokens, start, held = tools.encode(texts), 0, 0
            for i, t in enumerate(texts):
                held += len(t)
                if held >= RUN_BYTES or i + 1 == len(texts):
                    yield from _rows(rids[start:i + 1], ids[start:i + 1], tokens[start:i + 1], tools, at_once)
                    start, held = i + 1, 0

    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                       "text").mapInArrow(run, DDL)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many documents an id pair is linked, and whether no pair of its first id is in more."""
    counts = staged(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")), "pair-counts")
    first = F.shiftright("pair", BITS)
    top = counts.groupBy(first.alias("a")).agg(F.max("docs").alias("top"))  # as many rows as the first vocabulary at most
    return counts.withColumn("a", first).join(F.broadcast(top), "a").select("pair", "docs", (F.col("docs") == F.col("top")).alias("best"))


def least_broadcast(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs have counts from it on; 1 if all pairs do."""
    level = F.floor(F.log2("docs")).cast("int")
    sizes = {r["level"]: r["n"] for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    total, least = 0, max(sizes, default=-1) + 1
    for k in range(least - 1, -1, -1):
        total += sizes.get(k, 0)
        if total > most:
            break
        least = k
    return 1 << least


def _summed(rows: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Rows with ``n_best`` and ``count_sum`` over the pairs of ``hot`` (pairs, 2 x count + best), and the other pairs."""
    held = rows.sparkSession.sparkContext.broadcast(hot)
    more = [pa.field("n_best", pa.int64()), pa.field("count_sum", pa.int64()),
            pa.field("pairs", pa.list_(pa.int64())), pa.field("times", pa.list_(pa.int64()))]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = held.value
        for b in batches(it):
            n = b.num_rows
            lists = b.column("pairs")
            pairs, times = lists.flatten().to_numpy(), b.column("times").flatten().to_numpy()
            owner = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            value = values[at[known]] if len(keys) else np.zeros(0, np.int64)
            best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(best, owner[known], times[known] * (value & 1))
            np.add.at(total, owner[known], times[known] * (value >> 1))
            rest = ~known
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner[rest], minlength=n))]).astype(np.int32)
            other = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[rest])) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(best), pa.array(total), *other],
                                             schema=pa.schema([b.schema.field(i) for i in range(b.num_columns - 2)] + more))

    return rows.mapInArrow(run, f"{SUMMED}, n_best long, count_sum long, pairs array<long>, times array<long>")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, at_once: int = PAIRS_AT_ONCE,
          broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per document: counts of tokens, groups and links, digest of the groups, and the sums over the links of their
    pairs' corpus-wide counts (``count_sum``) and of whether they are the highest of their first id (``n_best``)."""
    rows = staged(aligned_rows(docs, path_a, path_b, at_once), "aligned")
    counts = staged(pair_counts(rows), "pair-ranks")
    least = least_broadcast(counts, broadcast_pairs)
    hot = counts.where(F.col("docs") >= least).select("pair", (F.col("docs") * 2 + F.col("best").cast("long")).alias("value")).orderBy("pair").toArrow()
    summed = _summed(rows, tuple(hot[c].to_numpy() for c in ("pair", "value")))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if least == 1 and rows.where("part > 0").isEmpty():
        return summed.select(*columns)
    summed = staged(summed, "summed")
    rare = (summed.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("rid", "x.pairs", "x.times")
            .join(counts.where(F.col("docs") < least).withColumnRenamed("pair", "pairs"), "pairs")
            .groupBy("rid").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                F.sum(F.col("times") * F.col("docs")).alias("count_sum")))
    parts = summed.where("part > 0").select("rid", "n_best", "count_sum")
    more = rare.unionByName(parts).groupBy("rid").agg(F.sum("n_best").alias("more_best"), F.sum("count_sum").alias("more_sum"))
    return (summed.where("part = 0").join(more, "rid", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).select(*columns))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of both tokenizers over all documents."""
    return align(table(spark, sf_dir, "documents").select("doc_id", "text"))
