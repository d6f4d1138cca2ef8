"""op11: groups, links and corpus-wide counts against a plain version, and the edge cases."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cohortkit.llm import alignment as A
from cohortkit.llm.packing import byte_characters

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "a", "  two  blanks \n\n end ", "Ünï cödé ﬁ 日本語 🙂🙂", "a▁b", "<|endoftext|> <s></s> <0x41>", "x" * 3000,
         "\t\tif (x):\r\n\treturn 0x1F  # ok", "same text here", "same text here", "mañana ​ zero", "0123456789" * 30, "\x00 nul"]


def plain(texts):
    """Per text the result columns, from lists, sets and dictionaries alone."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    sp = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    alphabet = byte_characters()

    def bytes_b(i):
        piece = sp.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()

    links, groups, sizes = [], [], []
    for t in texts:
        whole = b" " + (t or "").encode()
        a = [(i, bytes(alphabet[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + (t or ""), add_special_tokens=False).ids]
        b = [(i, bytes_b(i)) for i in sp.encode(t or "")]
        if not t or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a = b = []
        ends = []
        for side in (a, b):
            at, out = 0, []
            for _, x in side:
                at += len(x)
                out.append(at)
            ends.append(out)
        found, done = [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            stop = [ends[k].index(cut, done[k]) + 1 for k in (0, 1)]
            found.append(tuple([i for i, _ in side[done[k]:stop[k]]] for k, side in enumerate((a, b))))
            done = stop
        groups.append(found)
        links.append(Counter((x, y) for ga, gb in found for x in ga for y in gb))
        sizes.append((len(a), len(b)))
    counts = Counter(p for c in links for p in c)
    top = defaultdict(int)
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    out = []
    for (n_a, n_b), g, c in zip(sizes, groups, links):
        text = ";".join("|".join(",".join(map(str, side)) for side in x) for x in g)
        out.append((n_a, n_b, len(g), sum(c.values()), sum(n for p, n in c.items() if counts[p] == top[p[0]]),
                    sum(n * counts[p] for p, n in c.items()), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, n_a string, part int")
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in A.align(docs, **options).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts)


def test_documents_equal_plain_version(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    check(spark, [r["text"] for r in rows])


@pytest.mark.parametrize("options", [{}, {"at_once": 50}, {"broadcast_pairs": 3}, {"at_once": 50, "broadcast_pairs": 40}, {"broadcast_pairs": 0}])
def test_edges_and_bounds(spark, options):
    check(spark, TEXTS, **options)


def test_empty_table_and_null_id(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert A.align(docs.limit(0)).collect() == []
    got = A.align(docs).collect()
    assert [r["doc_id"] for r in got] == [None, None] and got[0]["count_sum"] == 2 * got[0]["n_links"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(61, 70)), min_size=1, max_size=4))
def test_cuts_equal_intersection(texts):
    ends_a, ends_b, low, high, base = [], [], [], [], 0
    for a, b, n in texts:
        low.append(len(ends_a))
        ends_a += [base + x for x in sorted(a | {n})]
        ends_b += [base + x for x in sorted(b | {n})]
        high.append(len(ends_a) - 1)
        base += n
    got = A.shared_cuts(np.array(ends_a), np.array(ends_b), np.array(low), np.array(high))
    last = {h for h in high}
    assert got.tolist() == [i for i, x in enumerate(ends_a) if x in set(ends_b) and i not in last]


def test_cuts_at_the_rim_cost_few_lookups(monkeypatch):
    """A long range without cuts between short ones with many: each end is looked up a few times at most."""
    n, rim = 200_000, 300
    ends_a = np.arange(1, n + 1) * 2
    ends_b = np.sort(np.concatenate([ends_a[:rim], ends_a[-rim:], ends_a[rim:-rim] + 1]))
    looked = []
    search = np.searchsorted
    monkeypatch.setattr(A.np, "searchsorted", lambda x, v, *k: looked.append(np.size(v)) or search(x, v, *k))
    got = A.shared_cuts(ends_a, ends_b, np.array([0]), np.array([n - 1]))
    assert len(got) == 2 * rim - 1 and sum(looked) < 4 * n
