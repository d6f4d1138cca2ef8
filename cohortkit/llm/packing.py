"""Sequence packing by best-fit decreasing, with a segment tree indexed by remaining capacity.

Documents are tokenised, closed with the end id and cut into full windows; what is left of each is
packed. A task packs its own rows in blocks of bounded size, so nothing is shuffled and memory does
not grow: a block's few open windows are the only padding that splitting adds.

Cases: a null text is the empty text (one end id); repeated rows are separate documents; other
columns are ignored; an empty table gives no pieces. ``sequence_id`` holds the number of the
partition in its upper bits, so it is unique without any exchange between tasks.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, prepare, table, texts_of, to_arrow, worker_state

SEQUENCE = 2048
END_ID = 1
#: Tokens that one block of a task holds before it is packed (32 MB of ids).
BLOCK_TOKENS = 8 << 20
#: Entries of a worker's chunk cache; it is emptied when full.
CACHE_ENTRIES = 500_000
TOKENIZER = "byte_bpe_50k.json"
#: Fixed value: the pre-token pattern of byte-level BPE, which both libraries split by.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
DDL = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def byte_characters() -> dict[str, int]:
    """Fixed rule of byte-level vocabularies: printable bytes stand for themselves, others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}


def merges_by_rank(spec: dict) -> bool:
    """Whether a tokenizer file merges as its ids rank the tokens, so that the ids alone tell every merge.

    So it is if the model is plain BPE over the byte alphabet, each token but the bytes is made by one merge, the
    merges stand in the order of their tokens' ids, and texts are split by the byte-level pattern alone.
    """
    model, split, vocab = spec["model"], spec.get("pre_tokenizer") or {}, spec["model"].get("vocab", {})
    plain = not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                           "byte_fallback", "ignore_merges"))
    if model.get("type", "BPE") != "BPE" or not plain or spec.get("normalizer"):
        return False
    if split.get("type") != "ByteLevel" or not split.get("use_regex", True) or split.get("add_prefix_space"):
        return False
    alphabet, special = byte_characters(), {t["content"] for t in spec.get("added_tokens", ())}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [a + b for a, b in pairs]
    ids = [vocab.get(t, -1) for t in made]
    return (all(x < y for x, y in zip(ids, ids[1:], strict=False)) and (not ids or ids[0] >= 256)
            and {t for t in vocab if t not in special} == set(alphabet) | set(made)
            and all(a in vocab and b in vocab and max(vocab[a], vocab[b]) < i for (a, b), i in zip(pairs, ids, strict=True)))


class Encoder:
    """Byte-level BPE ids (little-endian unsigned 32-bit) of whole texts, through a cache of chunks.

    The tokenizer never merges across a blank between two visible characters: the blank opens the next
    pre-token.  A text is therefore the concatenation of its blank-led chunks, whose ids depend on the chunk
    alone; a text with any other blank goes through the tokenizer whole.  New chunks are encoded together,
    with line breaks between (a token of their own), by a second library that reads the vocabulary of the
    same file and is faster.  It is used only if the file itself shows that both give the same ids
    (:func:`merges_by_rank`), for characters that both split alike; otherwise the tokenizer does the work.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.cache: dict[str, bytes] = {}
        self.entries = entries
        self.alike: set[str] = set()
        self.unlike: set[str] = set()  # characters whose chunks go through the tokenizer
        self.fast = self._second()
        self.line_break = self._slow(["\n"])[0]

    def _second(self):
        """The faster encoder of the same vocabulary (None where it cannot be built or could differ)."""
        try:
            import tiktoken
        except ImportError:
            return None
        if not merges_by_rank(json.loads(self.tokenizer.to_str())):
            return None
        ranks = {data: i for i, data in self.token_bytes().items()}
        return tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def token_bytes(self) -> dict[int, bytes]:
        """The bytes that each id stands for, special tokens left out."""
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        byte_of = byte_characters()
        return {i: bytes(byte_of[c] for c in t) for t, i in self.tokenizer.get_vocab().items() if t not in special}

    def _slow(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _classify(self, characters: set[str]) -> None:
        """Sort characters by whether both libraries split next to them alike (their tables of letters may differ)."""
        for c in characters:
            probes = [f"{x}{c}{x}" for x in ("x", "1", "!", " ")]
            same = self._slow(probes) == [np.asarray(self.fast.encode_ordinary(x), "<u4").tobytes() for x in probes]
            (self.alike if same else self.unlike).add(c)

    def _learn(self, parts: list[str]) -> None:
        """Ids of blank-led chunks without white space at their ends."""
        if self.fast is not None:
            self._classify(set().union(*parts) - self.alike - self.unlike)
        slow = parts if self.fast is None else [p for p in parts if not self.unlike.isdisjoint(p)] if self.unlike else []
        self.cache.update(zip(slow, self._slow([" " + p for p in slow]), strict=True))
        if slow:
            parts = sorted(set(parts).difference(slow))
        if not parts:
            return
        inner = [p for p in parts if "\n" in p]
        self.cache.update((p, np.asarray(self.fast.encode_ordinary(" " + p), "<u4").tobytes()) for p in inner)
        lines = [p for p in parts if "\n" not in p]
        ids = np.asarray(self.fast.encode_ordinary("\n".join([" " + p for p in lines])), "<u4")
        cuts = (np.flatnonzero(ids == np.frombuffer(self.line_break, "<u4")[0]) * 4).tolist()
        data = ids.tobytes()
        self.cache.update((p, data[x:y]) for p, x, y in zip(lines, [0, *(c + 4 for c in cuts)], [*cuts, len(data)], strict=True))

    def _known(self, cut: list[list[str]]) -> set[str]:
        """Put the chunks of texts into the cache; those with white space at an end, or empty, are returned instead."""
        if len(self.cache) > self.entries:
            self.cache.clear()
        missing = {p for parts in cut for p in set(parts).difference(self.cache)}
        odd = {p for p in missing if not p or p[0].isspace() or p[-1].isspace()}
        if missing := sorted(missing - odd):
            self._learn(missing)
        return odd

    def encode_after_blank(self, texts: list[str]) -> list[bytes]:
        """The ids of a blank and each text."""
        cut = [t.split(" ") for t in texts]
        odd, get = self._known(cut), self.cache.__getitem__
        whole = [i for i, parts in enumerate(cut) if odd and not odd.isdisjoint(parts)]
        entire = dict(zip(whole, self._slow([" " + texts[i] for i in whole]), strict=True)) if whole else {}
        return [entire[i] if i in entire else b"".join(map(get, parts)) for i, parts in enumerate(cut)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        cut = [t.split(" ") for t in texts]
        odd, cache = self._known([parts[1:] for parts in cut]), self.cache
        out, whole, heads = [], [], {}
        for i, (t, parts) in enumerate(zip(texts, cut, strict=True)):
            if t and (not parts[0] or parts[0][-1].isspace() or (odd and not odd.isdisjoint(parts[1:]))):
                whole.append(i)
            elif t:
                heads[i] = parts[0]
        first = dict(zip(heads, self._slow(list(heads.values())), strict=True)) if heads else {}
        entire = dict(zip(whole, self._slow([texts[i] for i in whole]), strict=True)) if whole else {}
        for i, parts in enumerate(cut):
            out.append(first[i] + b"".join(map(cache.__getitem__, parts[1:])) if i in first else entire.get(i, b""))
        return out


class OpenWindows:
    """Open windows by remaining capacity: a segment tree of counts over 0..size."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, by: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """(remaining capacity, window) of the window that a piece fills best; it is taken out."""
        count, i = self.count, need + self.leaves
        if not count[i]:
            while i > 1 and not (i % 2 == 0 and count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        self._add(capacity, -1)
        return capacity, self.windows[capacity].pop()


def best_fit_decreasing(lengths: list[int], size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(window, offset) of each piece; pieces are placed longest first, ties in given order."""
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    tree, opened = OpenWindows(size), 0
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        n = lengths[k]
        found = tree.tightest(n)
        if found is None:
            found = (size, opened)
            opened += 1
        free, window = found
        placed[k] = (window, size - free)
        if free > n:
            tree.put(free - n, window)
    return placed


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE,
         block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their ids and their place in a sequence."""
    prepare(docs.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        path = tokenizer or public_tokenizers.path(TOKENIZER)
        state = worker_state()
        if path not in state:
            state[path] = Encoder(path)
        encoder = state[path]
        end, next_id = np.asarray([END_ID], "<u4").tobytes(), TaskContext.get().partitionId() << 40
        full: list[tuple] = []
        rest: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal full, rest, held, next_id
            rows = [(*p, next_id + i, 0) for i, p in enumerate(full)]
            next_id += len(full)
            places = best_fit_decreasing([p[2] for p in rest], size)
            rows += [(*p, next_id + w, at) for p, (w, at) in zip(rest, places, strict=True)]
            next_id += 1 + max((w for w, _ in places), default=-1)
            full, rest, held = [], [], 0
            return to_arrow(dict(zip(SCHEMA.names, map(list, zip(*rows, strict=True)), strict=True)), SCHEMA)

        for b in batches(it):
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), encoder.encode(texts_of(b, "text")), strict=True):
                ids += end
                n = len(ids) // 4
                for s in range(0, n, size):
                    length = min(size, n - s)
                    (full if length == size else rest).append((doc_id, s, length, ids[4 * s:4 * (s + length)], n))
                held += n
                if held >= block_tokens:
                    yield flush()
        if held:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, DDL)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents, their ids as a checksum, and their place in a sequence."""
    return digest(pack(table(spark, sf_dir, "documents")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
