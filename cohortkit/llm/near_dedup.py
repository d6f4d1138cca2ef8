"""MinHash near-dedup with DartMinHash signatures, banded joins and exact checks.

A text is the set of its five-word shingles, and two texts are near copies from a Jaccard similarity of 0.8 on.
The signatures weight a shingle 1 + ln(occurrences) / 10, so that repeated ones count a little more while the
weighted similarity stays close to the plain one that decides.  DartMinHash throws hashed darts into the plane
(weight x rank) of each element: the plane is cut into cells, each cell's number of darts and their places follow
from a hash of (element, cell), and only darts below the element's weight count.  Darts of rank up to a bound that
falls with the total weight are thrown (about k ln k + 2k of them, whatever the size of the text); each is hashed
to one of k coordinates, and the earliest dart of a coordinate is its value.  Two texts agree in a coordinate with
the probability of their weighted similarity.  A text whose darts leave a coordinate empty throws up to twice the rank.

Equal word sequences are one node from the start (a grouped aggregate) with one text of theirs.  Bands of
coordinates deal the nodes into buckets.  A bucket of two is a pair; a larger one is cut into blocks of bounded
size, dealt by a hash, and each block finds its classes on the whole shingle sets: a class grows from its smallest
node, and only members that have no class yet are compared.  Then, in buckets of several blocks, the members
outside the bucket's commonest class meet all members of other classes, block by block.  So each pair of a bucket
is either compared or already in one class, no pairs are written (a block returns one link for each member that it
places), and a group of near copies of any size is spread over many tasks.  Links make classes by propagating the
smallest node with pointer jumping; a class is named by its smallest document id.  Only ids and hashes are shuffled
until the checks; the sets of texts that share a bucket are built once.

Cases: word-free texts are one node if they are equal (null as the empty text); a text of fewer than five words
is one shingle; ids are BIGINT (other types are cast); repeated rows of an id are one document, and if their texts
differ, it is linked by each of them, so that its classes are one; null ids are left out of the classes and
returned as they came, without a class; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, kept, prepare, scratch, set_aside, staged, table, texts_of, to_arrow

WORDS = 5
SIMILAR = 0.8
#: How much the logarithm of a shingle's occurrences adds to its weight in the signature.
SLOPE = 0.1
BANDS, ROWS = 24, 6
#: Members of one block (buckets up to this size are compared whole), and bytes of their shingle sets.
BLOCK, BLOCK_BYTES = 256, 16 << 20
#: Borders of the rank columns of cells: fine near 0, where long texts throw all their darts.
COLUMNS = np.array([0.0, *(2.0**e for e in range(-4, 12))])
WORD = re.compile(r"\w+")
U = np.uint64

SIGNATURE = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("same", pa.binary()), ("bands", pa.list_(pa.int64()))])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in [0, 1)."""
    return (x >> U(11)).astype(np.float64) * 2.0**-53


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles(words: list[str], size: int = WORDS) -> np.ndarray:
    """Hashes of the five-word shingles, one for each occurrence, from the hashes of their words in order."""
    if not words:
        return np.zeros(0, U)
    own = {w: xxhash.xxh64_intdigest(w.encode()) for w in set(words)}
    h = np.fromiter(map(own.__getitem__, words), U, len(words))
    n = max(1, len(words) - size + 1)
    out = np.zeros(n, U)
    for k in range(min(size, len(words))):
        out = mix(out * U(0x9E3779B97F4A7C15) + h[k:k + n])
    return out


def weights(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles, weights) of one text, as the signature sees it."""
    keys, n = np.unique(hashes, return_counts=True)
    return keys, 1 + SLOPE * np.log(n)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of distinct shingles; two empty ones are alike."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - shared
    return shared / total if total else 1.0


def poisson_steps(mean: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... darts in a cell of this area."""
    out, p, k = [], math.exp(-mean), 0
    total = p
    while total < 1 - 1e-12 and k < 20 + 20 * mean:
        out.append(total)
        k += 1
        p *= mean / k
        total += p
    return np.array(out)


STEPS = [poisson_steps(float(b - a)) for a, b in zip(COLUMNS[:-1], COLUMNS[1:], strict=True) if b <= 512]


def darts(keys: np.ndarray, weight: np.ndarray, owner: np.ndarray, bound: np.ndarray, after: np.ndarray) -> tuple:
    """(owner, rank, hash) of the darts of rank in (after, bound] (per owner) below the elements' weights.

    Cells are a column of ranks by a unit of weight; a wide column beyond the table is cut into parts of
    the widest one, so a cell's darts depend on the element and the cell alone.
    """
    found = []
    top = float(bound.max()) if len(bound) else 0.0
    column, low = 0, 0.0
    while low < top:
        j = min(column, len(STEPS) - 1)
        width = float(COLUMNS[j + 1] - COLUMNS[j])
        use = np.flatnonzero((bound[owner] > low) & (after[owner] < low + width))
        level = 0
        while len(use):
            cell = mix(keys[use] ^ mix(np.full(len(use), column * 4096 + level + 1, np.uint64) * U(0x9E3779B97F4A7C15)))
            n = np.searchsorted(STEPS[j], unit(cell), "right")
            rows = np.repeat(use, n)
            number = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            h = mix(np.repeat(cell, n) + (number + 1).astype(U) * U(0xD1B54A32D192ED03))
            rank = low + width * unit(mix(h ^ U(0xA0761D6478BD642F)))
            high = level + unit(mix(h ^ U(0xE7037ED1A0B428DB)))
            own = owner[rows]
            hit = (high < weight[rows]) & (rank <= bound[own]) & (rank > after[own])
            found.append((own[hit], rank[hit], h[hit]))
            level += 1
            use = use[weight[use] > level]
        column += 1
        low += width
    if not found:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, U)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """(texts, k) dart hashes: the earliest dart of each coordinate; empty sets have zeros."""
    out = np.zeros((len(sets), k), U)
    full = [i for i, s in enumerate(sets) if len(s[0])]
    if not full:
        return out
    keys = np.concatenate([sets[i][0] for i in full])
    weight = np.concatenate([sets[i][1] for i in full])
    owner = np.repeat(np.arange(len(full)), [len(sets[i][0]) for i in full])
    total = np.bincount(owner, weight)
    bound, after = (k * math.log(k) + 2 * k) / total, np.full(len(full), -1.0)
    value, todo = np.zeros((len(full), k), U), np.arange(len(full))
    have = np.zeros((len(full), k), bool)
    while len(todo):
        open_ = np.zeros(len(full), bool)
        open_[todo] = True
        part = open_[owner]
        own, rank, h = darts(keys[part], weight[part], owner[part], np.where(open_, bound, 0), after)
        place = own * k + (mix(h ^ U(0x8EBC6AF09C88C6E3)) % U(k)).astype(np.int64)
        new = ~have.ravel()[place]
        late_first = np.argsort(-rank[new], kind="stable")  # the earliest dart is written last and stays
        place = place[new][late_first]
        value.ravel()[place] = h[new][late_first]
        have.ravel()[place] = True
        todo = todo[~have[todo].all(1)]
        after, bound = after.copy(), bound.copy()
        after[todo] = bound[todo]
        bound[todo] *= 2
    out[full] = value
    return out


def band_hashes(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(texts, bands): one hash for each band's coordinates."""
    out = np.zeros((len(values), bands), U)
    for r in range(rows):
        out = mix(out * U(0x9E3779B97F4A7C15) + values[:, r::rows][:, :bands] + U(r + 1))
    return out.view(np.int64)


def hashed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text, hash) of the rows with an id: null texts as empty ones, and a hash of the text."""
    own = F.coalesce(F.col(text), F.lit(""))
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), own.alias("text"), F.xxhash64(own).alias("hash"))


def sign(texts: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, hash, same, bands) of :func:`hashed` rows: a digest of the word sequence (of a text without words, of
    the text), and the band hashes (none without words)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            own = texts_of(b, "text")
            words = [words_of(t) for t in own]
            values = band_hashes(signatures([weights(shingles(w)) for w in words], bands * rows), bands, rows)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("hash"),
                pa.array([hashlib.md5((" ".join(w) or "\0" + t).encode()).digest() for w, t in zip(words, own, strict=True)], pa.binary()),
                pa.array([h.tolist() if w else [] for h, w in zip(values, words, strict=True)], pa.list_(pa.int64()))], schema=SIGNATURE)

    return texts.select("doc_id", "hash", "text").mapInArrow(run, "doc_id long, hash long, same binary, bands array<long>")


def nodes_of(signed: DataFrame) -> DataFrame:
    """(node, same, doc_id, hash, bands): one row for each different word sequence, with the id and hash of one of its
    texts (the smallest id).  Numbers of nodes come from the written rows, so the table is to be staged."""
    firsts = signed.groupBy("same").agg(F.min(F.struct("doc_id", "hash")).alias("first"), F.min("bands").alias("bands"))
    return firsts.select(F.monotonically_increasing_id().alias("node"), "same", "first.doc_id", "first.hash", "bands")


def shingle_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, size, data): the distinct shingle hashes of the texts that ``wanted`` (node, doc_id, hash) names."""
    schema = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("data", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            sets = [np.unique(shingles(words_of(t))) for t in texts_of(b, "text")]
            yield to_arrow({"node": b.column("node").to_pylist(), "size": [len(s) for s in sets],
                            "data": [s.tobytes() for s in sets]}, schema)

    # one plan at every size: the nodes grow with the documents, so they are never broadcast
    rows = texts.join(wanted.hint("merge"), ["doc_id", "hash"]).groupBy("node").agg(F.min("text").alias("text"))
    return rows.mapInArrow(run, "node long, size long, data binary")


def set_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, U)


def checked(pairs: DataFrame, sets: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar, from their shingle sets."""
    rows = (pairs.join(sets.select(F.col("node").alias("a"), F.col("data").alias("data_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("data").alias("data_b")), "b"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            alike = [similarity(set_of(x.as_py()), set_of(y.as_py())) >= least
                     for x, y in zip(b.column("data_a"), b.column("data_b"), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    return rows.mapInArrow(run, "a long, b long")


class Block:
    """The shingle sets of one block's members, for one against many."""

    def __init__(self, data: list[bytes]):
        sets = [set_of(d) for d in data]
        keys, self.ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.total = np.array([len(x) for x in sets])
        self.ends = np.cumsum(self.total)
        self.starts = self.ends - self.total
        self.mine = np.zeros(len(keys), bool)

    def similar(self, x: int, others: np.ndarray, least: float) -> np.ndarray:
        """Those of ``others`` that are similar to member x."""
        low, high = np.minimum(self.total[others], self.total[x]), np.maximum(self.total[others], self.total[x])
        others = others[low >= least * high]  # the similarity cannot exceed the ratio of the sizes
        if not len(others):
            return others
        size = self.total[others]
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(self.starts[others] - first, size)
        own = self.ids[self.starts[x]:self.ends[x]]
        self.mine[own] = True
        shared = np.add.reduceat(self.mine[self.ids[at]].astype(np.int64), first)
        self.mine[own] = False
        return others[shared >= least * (size + self.total[x] - shared)]


def _pairs(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([min(p) for p in found], pa.int64()), "b": pa.array([max(p) for p in found], pa.int64())})


def _classes_within(least: float):
    """A block's links: from the smallest node of each of its classes to the others."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        ids, block, found = rows["node"].to_numpy(), Block(rows["data"].to_pylist()), []
        left = np.arange(len(ids))
        while len(left):
            root, left = left[0], left[1:]
            work = [root]
            while work and len(left):
                hit = block.similar(work.pop(), left, least)
                left = np.setdiff1d(left, hit, assume_unique=True)
                found += [(int(ids[root]), int(ids[y])) for y in hit]
                work += hit.tolist()
        return _pairs(found)
    return run


def _links_across(least: float):
    """Links of the asking members of a block with members of other classes: one for each class met."""
    def run(rows: pa.Table) -> pa.Table:
        ids, classes = rows["node"].to_numpy(), rows["class_id"].to_numpy()
        asks = rows["asks"].to_numpy(zero_copy_only=False)
        block, members, found = Block(rows["data"].to_pylist()), np.flatnonzero(~asks), []
        for x in np.flatnonzero(asks):
            met = {int(classes[y]): int(ids[y]) for y in block.similar(x, members[classes[members] != classes[x]], least)}
            found += [(int(ids[x]), y) for y in met.values()]
        return _pairs(found)
    return run


def _blocks(rows: DataFrame, small: int) -> DataFrame:
    """(band, hash, blocks): the number of blocks that a bucket's rows need."""
    return rows.groupBy("band", "hash").agg(F.greatest(
        F.ceil(F.count("*") / small), F.ceil(F.sum("size") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))


def links(nodes: DataFrame, texts: DataFrame, least: float = SIMILAR, small: int = BLOCK) -> DataFrame:
    """Checked links (a, b), a < b, that connect what is similar among nodes of a common bucket.

    ``nodes`` is the staged table of :func:`nodes_of`, ``texts`` that of :func:`hashed`; ``small`` is the size of a block.
    """
    key = ["band", "hash"]
    dealt = nodes.select("node", F.posexplode("bands").alias(*key))
    buckets = staged(dealt.groupBy(*key).agg(F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"))
                     .where("n > 1"), "buckets")
    pairs = staged(buckets.where("n = 2").select("a", "b").distinct(), "pairs")
    crowds = staged(dealt.join(buckets.where("n > 2").select(*key), key), "crowds")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowds.select("node")).distinct()
    wanted = nodes.select("node", "doc_id", "hash").join(ids, "node", "left_semi")
    sets = staged(shingle_sets(texts, wanted), "shingle-sets")
    data = sets.select("node", "data")
    sized = crowds.join(sets.select("node", "size"), "node")
    members = staged(sized.join(_blocks(sized, small), key).withColumn(
        "block", F.expr("cast(pmod(xxhash64(node, band, 0), blocks) as int)")), "members")
    within = members.select("node", *key, "block").join(data, "node").groupBy(*key, "block").applyInArrow(
        _classes_within(least), "a long, b long")
    found = staged(checked(pairs, sets, least).unionByName(within).distinct(), "links")
    cut = members.where("blocks > 1")
    if cut.isEmpty():
        return found
    named = cut.join(components(found).select("node", "class_id"), "node", "left").withColumn(
        "class_id", F.coalesce("class_id", "node"))
    named = staged(named, "named-members")
    common = named.groupBy(*key, "class_id").agg(F.count("*").alias("n")).groupBy(*key).agg(
        F.max(F.struct("n", "class_id"))["class_id"].alias("common"))
    asking = staged(named.join(common, key).where("class_id <> common"), "asking")
    asked = _blocks(asking, small)
    number = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    own = ["node", "class_id", *key]
    ask = asking.join(asked.withColumnRenamed("blocks", "parts"), key).withColumn("block", number).select(
        *own, "block", F.expr("cast(pmod(xxhash64(node, band, 1), parts) as int)").alias("part"), F.lit(True).alias("asks"))
    meet = named.drop("blocks").join(asked, key).select(*own, "block", number.alias("part"), F.lit(False).alias("asks"))
    across = ask.unionByName(meet).join(data, "node").groupBy(*key, "block", "part").applyInArrow(
        _links_across(least), "a long, b long")
    return found.unionByName(staged(across.distinct(), "links-across"))


def components(edges: DataFrame) -> DataFrame:
    """(node, class_id): the smallest node that links lead to, by propagation with pointer jumping."""
    both = staged(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
        edges.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(), "edges")
    label = staged(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("to")), "labels")
    while True:
        near = (both.join(label.select(F.col("x").alias("y"), F.col("to").alias("other")), "y")
                .groupBy("x").agg(F.min("other").alias("other")))
        jump = label.select(F.col("x").alias("to"), F.col("to").alias("further"))
        new = staged(label.join(near, "x", "left").join(jump, "to", "left").select(
            "x", F.least("to", "other", "further").alias("to"), F.col("to").alias("old")), "labels")
        if new.where("to <> old").isEmpty():
            return new.select(F.col("x").alias("node"), F.col("to").alias("class_id"))
        label = new.select("x", "to")


def near_classes(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id): the class of each document, named by its smallest id."""
    spark = prepare(docs.sparkSession)
    with scratch(spark) as made:
        texts = hashed(docs)
        signed = staged(sign(texts), "signatures")
        nodes = staged(nodes_of(signed), "nodes")
        owned = staged(signed.select("doc_id", "same").distinct().join(nodes.select("same", "node"), "same").select("doc_id", "node"), "owned")
        # an id with several texts joins their classes
        several = owned.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last")
        by_id = owned.join(several.select("doc_id", "a"), "doc_id").where("a < node").select("a", F.col("node").alias("b"))
        found = staged(components(links(nodes, texts, least).unionByName(by_id)), "classes")
        first = nodes.select("node", F.col("doc_id").alias("first"))
        named = found.join(first, "node").groupBy("class_id").agg(F.min("first").alias("name"))
        names = found.join(named, "class_id").select("node", "name")
        every = first.join(names, "node", "left").select("node", F.coalesce("name", "first").alias("class_id"))
        return kept(owned.join(every, "node").groupBy("doc_id").agg(F.min("class_id").alias("class_id")), "near-classes", made)


def keep_one(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """One document of each class (that of the smallest id), and the rows without an id.

    Repeated rows of a kept id are one row for each different text; all columns stay as they are.
    """
    found = near_classes(docs, least).where("doc_id = class_id").select("doc_id")
    docs, back = set_aside(docs)
    row = F.struct(*docs.columns)
    rows = docs.select("doc_id", row.alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    one = rows.where("doc_id is not null").join(found, rows.doc_id.cast("long") == found.doc_id, "left_semi").dropDuplicates(["doc_id", "hash"])
    return one.unionByName(rows.where("doc_id is null")).select("row.*").select(*back)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the class of near copies that it is in, and whether it represents the class; rows without an
    id have no class and represent themselves (as in ``keep_one``)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    alone = docs.where("doc_id is null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"))
    return near_classes(docs).select("doc_id", "class_id").unionByName(alone).select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("is_representative"))
