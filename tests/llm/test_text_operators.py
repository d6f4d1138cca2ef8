"""op4, op8, op9, op10, op3: against brute force written another way, and the edge cases."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import zlib
from urllib.parse import quote

import numpy as np
import pytest

from cohortkit.llm import decontaminate as D
from cohortkit.llm import fingerprint as FP
from cohortkit.llm import html_text as H
from cohortkit.llm import packing as P
from cohortkit.llm import secrets as S
from cohortkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "a", "Ünï cödé", "x" * 70_000, "same", "same", "two  blanks \n\n end "]


def documents(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "extra", 5) for i, t in enumerate(texts)], "doc_id long, text string, score string, length int")


# ---- secrets -----------------------------------------------------------------

def plain_spans(text):
    """The three patterns as the rule states them: match, then drop the short ones."""
    prefix = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    api = "[aA][pP][iI]_?[kK][eE][yY]"
    assign = re.compile(rf"""({prefix}|{api})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))


def test_plain_secrets_equal_brute_force(spark):
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op4_secret_worklist"](spark, SF).collect()}
    for i, t in rows.items():
        want = plain_spans(t)
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert got[i]["n_hex"] == sum(k == "hex" for k, _, _ in want)
        assert set(filter(None, text.split(","))) <= set(got[i]["spans"].split(","))


@pytest.mark.parametrize("text", ["token=token:abcdef123", "API_KEY : 'abc' apikey=\"abcdef\"", "AKIAAKIA" + "A" * 12, "ſecret=abcdefg",
                                  "f" * 23 + " " + "0" * 24, "password=aé", "TOKEN  ==  abcdef"])
def test_plain_patterns(text):
    assert sorted(S.find(text), key=lambda x: (x[1], x[0])) == [(S.KINDS.index(k), s, e) for k, s, e in plain_spans(text)]


def layered(secret):
    yield quote(secret, safe="")
    yield "".join(f"\\u{ord(c):04x}" for c in secret)
    yield base64.b64encode(secret.encode()).decode()
    yield base64.b64encode(gzip.compress(secret.encode())).decode()
    yield base64.b64encode(base64.b64encode(quote(secret, safe="").encode())).decode()
    yield quote("".join(f"%{b:02x}" for b in secret.encode()), safe="")


def test_layers_are_unwrapped_and_mapped():
    secret = "password=hunter2secret AKIA" + "Z" * 16
    for wrapped in layered(secret):
        text = f"é before {wrapped} after"
        base, spans = S.scan(text)
        a, b = text.index(wrapped), text.index(wrapped) + len(wrapped)
        added = spans - set(base)
        assert {k for k, _, _ in spans} >= {0, 1} and added, wrapped
        assert all(a <= s < e <= b for _, s, e in added)
    url = "x %70assword=hunter2secret"
    assert (0, 2, len(url)) in S.scan(url)[1]


def wrapped_or_torn(secret):
    noise = " ".join(hashlib.sha512(bytes([i])).hexdigest()[:23] for i in range(9))
    plain = f"{noise} {secret} {noise}".encode()
    coded = base64.b64encode(plain).decode()
    for width, br in ((64, "\n"), (76, "\r\n"), (50, "\n  ")):
        yield br.join(coded[i:i + width] for i in range(0, len(coded), width))
        for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
            packed = base64.b64encode(pack(plain)).decode()
            yield br.join(packed[i:i + width] for i in range(0, len(packed), width))
            yield "/run/" + packed
    for prefix in ("/run/", "blob_", "a-", "ab+", "/", "path/to/some/"):
        yield prefix + coded
        yield prefix + base64.urlsafe_b64encode(plain).decode().rstrip("=") + "/" + "x" * 20
    yield "".join(f"%{b:02x}" for b in b"\xff" + secret.encode() + b"\xe9\x00")
    yield "\\U00110000" + "".join(f"\\u{ord(c):04x}" for c in secret)


def test_wrapped_prefixed_and_torn_layers():
    secret = "password=hunter2secret AKIA" + "Z" * 16
    for wrapped in wrapped_or_torn(secret):
        text = f"é before\n{wrapped} after"
        spans = S.scan(text)[1]
        a, b = text.index(wrapped), text.index(wrapped) + len(wrapped)
        assert {k for k, _, _ in spans} >= {0, 1}, wrapped
        assert all(a <= s < e <= b for _, s, e in spans), wrapped


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zlib.compress])
def test_all_of_a_compressed_layer_is_scanned(pack, monkeypatch):
    secret = b"password=hunter2secret AKIA" + b"Z" * 16 + b" "
    joined = base64.b64encode(pack(b"first member ") + pack(b"second ") + pack(secret)).decode()
    assert {k for k, _, _ in S.scan(f"a {joined} b")[1]} == {0, 1}
    monkeypatch.setattr(S, "EXPAND_BYTES", 300_000)
    monkeypatch.setattr(S, "CHUNK", 10_000)
    for before in (70_000, 299_990, 299_980 + 7, 299_999, 1_000_003):
        filler = ("é. " * (before // 4 + 1)).encode()[:before]
        filler = filler.decode(errors="ignore").encode()
        for inner in (secret, base64.b64encode(b"x" * 40 + b" " + secret) + b" "):
            coded = base64.b64encode(pack(filler + b" " * (before - len(filler)) + inner + "ü ".encode() * 200_000)).decode()
            for run in (coded, "/run/" + coded, "".join(f"%{b:02x}" for b in base64.b64decode(coded))):
                text = f"a {run} b {run} c"
                spans = S.scan(text)[1]
                second = len(run) + 5
                assert {k for k, _, e in spans if e < second} == {k for k, s, _ in spans if s >= second} == {0, 1}
                assert all(2 <= s < e <= len(text) - 2 for _, s, e in spans)


def test_redaction_and_edges(spark):
    docs = documents(spark, [*TEXTS, "see token=abcdefgh ok", "k " + quote("secret=abcdefgh", safe="") + "."])
    out = {r["doc_id"]: r["text"] for r in S.redact(docs).collect()}
    assert out[0] is None and out[7] == "same"
    assert out[len(TEXTS)] == "see [REDACTED] ok"
    assert "abcdefgh" not in out[len(TEXTS) + 1] and out[len(TEXTS) + 1].startswith("k ")
    assert S.redact(docs).columns == docs.columns
    assert S.redact(docs.where("false")).count() == 0


# ---- packing -----------------------------------------------------------------

def test_pieces_hold_every_id_once(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    texts += [*TEXTS, "it's 'll don't\tx  y\n z <|endoftext|>", "a\u0085 b, c. d.", "½., ²"]
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = P.pack(docs, block_tokens=40_000).collect()
    got, seqs = {}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] <= P.SEQUENCE and r["start"] == len(got.get(r["doc_id"], []))
        assert r["doc_tokens"] == len(want[r["doc_id"]])
        got.setdefault(r["doc_id"], []).extend(ids)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= P.SEQUENCE
    assert P.pack(docs.where("false")).count() == 0


def test_best_fit_is_the_tightest_window():
    r = random.Random(2)
    for _ in range(30):
        lengths = [r.randint(1, 60) for _ in range(r.randint(0, 80))]
        placed = P.best_fit_decreasing(lengths, 64)
        free = []
        for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
            fits = [f for f in free if f >= lengths[k]]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - lengths[k])
            else:
                free.append(64 - lengths[k])
        used = {}
        for (w, at), n in zip(placed, lengths, strict=True):
            used[w] = used.get(w, 0) + n
        assert sorted(64 - u for u in used.values()) == sorted(free)


# ---- decontamination ---------------------------------------------------------

def test_blocks_give_the_same_as_one_set(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    one = sorted(map(str, D.find_leaks(docs.select("doc_id", "text"), items).collect()))
    for block in (20_000, 9_000):
        assert 1 < D.benchmark_blocks(items, block)[1] < 12
        many = sorted(map(str, D.find_leaks(docs.select("doc_id", "text"), items, block_bytes=block).collect()))
        assert one == many


def test_blocks_are_bounded_in_bytes(spark):
    """What is broadcast is a few times the text, measured, and the estimate that deals items to blocks covers it."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(str(r["item_id"]), r["text"]) for r in items.collect()] * 40
    block = D.ngram_set(rows)
    text = sum(len(t.encode()) for _, t in rows)
    words = sum(len(D.words_of(t.encode())) for _, t in rows)
    assert block.nbytes() <= text + words * (D.WORD_BYTES + 12) + len(rows) * D.ITEM_BYTES
    assert block.nbytes() < 8 * text
    dealt, blocks = D.benchmark_blocks(items, 9_000)
    sizes = {}
    for r in dealt.collect():
        sizes.setdefault(r["block"], []).append((r["item_id"], r["text"]))
    largest = max(D.ngram_set([x]).nbytes() for x in rows)
    assert all(D.ngram_set(x).nbytes() <= 1.5 * 9_000 + largest for x in sizes.values())
    assert max(sizes) < blocks and sum(map(len, sizes.values())) == items.distinct().count()


def test_equal_hashes_are_no_hits(spark, monkeypatch):
    """With every word hashed alike, only windows of the same words count."""
    monkeypatch.setattr(D, "word_hash", lambda w: 5)
    block = D.ngram_set([("1", "alpha beta"), ("2", "gamma delta")])
    assert [D.scan(t, block, {})[2] for t in (b"x alpha beta", b"beta alpha", b"gamma delta alpha beta")] == [{"1"}, set(), {"1", "2"}]


def test_results_named_as_own_columns(spark):
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x alpha beta y", "mine", 7, 1.5), (2, "clean", None, 8, None)],
                                 "doc_id long, text string, bench_hit string, bench_spans int, row double")
    for block in (D.BLOCK_BYTES, 150):
        more = items.unionByName(spark.createDataFrame([(2, "other words here")], items.schema))
        found = D.find_leaks(docs.select("doc_id", "text", "row"), more, block_bytes=block)
        assert sorted((r["doc_id"], r["bench_hit"], r["row"]) for r in found.collect()) == [(1, 2, 1.5), (2, 0, None)]
    assert [tuple(r) for r in D.drop_leaks(docs, items).collect()] == [(2, "clean", None, 8, None)]
    assert sorted(tuple(r) for r in D.remove_spans(docs, items).collect())[0] == (1, "x \n y", "mine", 7, 1.5)


def test_leaks_edges(spark):
    items = spark.createDataFrame([(1, "Alpha beta"), (10, "one two three four five six seven eight nine ten eleven"), (2, None), (3, "..."),
                                   (1, "Alpha beta")], "item_id long, text string")
    docs = documents(spark, [*TEXTS, "x ALPHA, beta y", "two three four five six seven eight nine ten eleven twelve", "É alpha é beta"])
    got = {r["doc_id"]: r for r in D.find_leaks(docs, items).collect()}
    n = len(TEXTS)
    assert [got[i]["bench_hit"] for i in range(n)] == [0] * n and got[0]["bench_words"] == 0
    assert (got[n]["bench_hit"], got[n]["bench_items"]) == (2, ["1"]) and got[n + 1]["bench_hit"] == 10 and got[n + 2]["bench_hit"] == 0
    assert D.drop_leaks(docs, items).count() == n + 1
    cut = {r["doc_id"]: r["text"] for r in D.remove_spans(docs, items).collect()}
    assert cut[n] == "x \n y" and cut[0] is None
    assert D.find_leaks(docs, items.where("false")).where("bench_hit > 0").count() == 0


def test_items_without_an_id_count(spark):
    items = spark.createDataFrame([(None, "alpha beta"), (None, "gamma delta"), (1, "gamma delta"), (None, None)], "item_id long, text string")
    docs = documents(spark, ["x alpha beta y", "gamma delta", "alpha", "gamma delta alpha beta"])
    for block in (D.BLOCK_BYTES, 150):
        got = {r["doc_id"]: (r["bench_hit"], r["bench_items"]) for r in D.find_leaks(docs, items, block_bytes=block).collect()}
        assert got == {0: (2, []), 1: (2, ["1"]), 2: (0, []), 3: (4, ["1"])}
    assert [r["doc_id"] for r in D.drop_leaks(docs, items).collect()] == [2]


# ---- pages -------------------------------------------------------------------

def test_main_text():
    page = ("<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><header><h2>Site</h2></header>"
            "<nav><ul><li><a href=x>Menu</a></ul></nav><div class='cookie-notice'>We use cookies</div><!-- c --><article><h1>Head &amp; line</h1>"
            "<p>First <b>para&shy;graph</b> with\n  words &eacute;.<br><p>No.</p><aside>Aside</aside><form>Name<input></form><p>Last one here.</p>"
            "<div id=comments><p>Great post</p></div></article><div class=sidebar>Links</div><footer>&copy; x</footer>")
    assert H.main_text(page) == "Head & line\nFirst para\xadgraph with words é.\nNo.\nLast one here."
    assert H.main_text("") == "" and H.main_text("<nav><a>x</a></nav>") == ""
    assert H.main_text("<body><div class=menu><a>a</a></div><div><p>Only text here, no article.</p><p>Yes.</p></div>") == "Only text here, no article.\nYes."


LONG = "A paragraph of some forty words that goes on and on, so that its ratio of text to tags is high. " * 3


@pytest.mark.parametrize("page, want", [
    (f"<div id=content><section><p>{LONG}</p></section><section><p>{LONG}B</p></section></div>", [LONG, LONG + "B"]),
    (f"<body><section><p>{LONG}</p></section><section><p>Short, but a part.</p></section>", [LONG, "Short, but a part."]),
    (f"<div id=content><div><div><p>{LONG}</p></div></div><div><p>Yes.</p></div><div><p>{LONG}B</p></div></div>", [LONG, "Yes.", LONG + "B"]),
    (f"<div><p>{LONG}</p></div><div><p>{LONG}{LONG}B</p></div>", [LONG, LONG + LONG + "B"]),
    (f"<article><p>{LONG}</p></article><article><p>Two.</p></article><article><p>{LONG}C</p></article>", [LONG, "Two.", LONG + "C"]),
    (f"<table><tr><td><a href=x>Menu</a><td><p>{LONG}</p><p>No.</p><td><p>{LONG}B</p></table>", [LONG, "No.", LONG + "B"]),
    (f"<div><p>{LONG}</p><table><tr><td>1<td>2<tr><td>3<td>4</table></div>", [LONG, "1", "2", "3", "4"]),
    (f"<article><p>{LONG}</p><ul><li><a href=x>Linked item</a></ul><p><a href=y>{LONG}B</a></p></article>", [LONG, "Linked item", LONG + "B"]),
    (f"<div><p>{LONG}</p><p><a href=y>{LONG}B</a></p></div><div><a href=z>Imprint</a></div>", [LONG, LONG + "B"]),
])
def test_every_content_region_is_kept(page, want):
    assert H.main_text(page).split("\n") == [w.strip() for w in want]


@pytest.mark.parametrize("page, want", [
    *((f"<body><div class='{c}'><article><p>{LONG}</p><p>No.</p><div class=ad>Buy</div></article></div>", [LONG, "No."])
      for c in ("content has-sidebar", "no-comments", "ad-free", "social-science", "social", "sidebar main-sidebar")),
    *((f"<body><div class='{c}'><p>{LONG}</p><p>No.</p></div>", [LONG, "No."]) for c in ("has-sidebar", "no-comments", "ad-free", "social-science")),
    (f"<body><form id=page><div class=menu>Menu</div><main><p>{LONG}</p></main></form>", [LONG]),
    (f"<body><p>{LONG}</p><div id=comments><article>Great post</article></div><div class='cookie-notice'>We</div><div class=sidebar-left-2>x</div>", [LONG]),
    (f"<html><head><meta charset=x><title>T</title><style>p{{}}</style><body><article><p>{LONG}</p></article>", [LONG]),
    (f"<head><title>T</title><noscript><img src=x></noscript><p>{LONG}</p>", [LONG]),
    (f"<head><title>T</title><script>var a;</script> {LONG}", [LONG]),
])
def test_articles_are_not_dropped(page, want):
    assert H.main_text(page).split("\n") == [w.strip() for w in want]


def test_pages_edges(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "u", ""), (3, "u", "<p>" + "w " * 60_000), (3, "u", "<article><p>x</article>")],
                                  "page_id long, url string, html string").selectExpr("*", "'k' as main_text")
    got = sorted((r["page_id"], len(r["main_text"])) for r in H.extract(pages).collect())
    assert got == [(1, 0), (2, 0), (3, 1), (3, 119_999)]
    assert H.extract(pages.where("false")).count() == 0


# ---- fingerprints ------------------------------------------------------------

def pieces_by_hand(text):
    """Weighted multiset of the cells of a text."""
    out = {}
    for p in FP.PIECE.findall(text):
        out[p] = out.get(p, 0) + 1
    return out


def test_fingerprints_equal_brute_force(spark):
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    for part in (64, 2048):
        docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
        got = {r["doc_id"]: r for r in FP.neighbours(docs, part).mapInArrow(FP._fingerprints, FP.DDL).collect()}
        assert len(got) == len(rows)
        prints = {}
        for k, (i, t) in enumerate(rows):
            other = rows[(k + 1) % len(rows)][1]
            n = len(t) // 4
            e = t[:len(t) - n] + other[:n]
            assert got[i]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest() and got[i]["n_chars"] == len(t)
            for name, b in (("near_edited", e), ("near_next", other)):
                x, y = pieces_by_hand(t), pieces_by_hand(b)
                low = sum(len(p) * min(c, y.get(p, 0)) for p, c in x.items())
                union = len(t) + len(b) - low
                assert abs(got[i][name] - (low / union if union else 1.0)) < 1e-9
            assert prints.setdefault(t, got[i]["fingerprint"]) == got[i]["fingerprint"]
            assert prints.setdefault(e, got[i]["edited_fingerprint"]) == got[i]["edited_fingerprint"]


def test_fingerprint_edges(spark):
    docs = spark.createDataFrame([(5, None), (5, "b. c."), (None, "z"), (7, "y" * 90_000), (9, "")], "doc_id long, text string")
    got = FP.fingerprints(docs).collect()
    assert sorted((r["doc_id"] or -1, r["n_chars"]) for r in got) == [(-1, 1), (5, 0), (5, 5), (7, 90_000), (9, 0)]
    alone = FP.fingerprints(docs.where("doc_id = 7")).collect()
    assert alone[0]["near_next"] == 1.0
    assert FP.fingerprints(docs.where("false")).count() == 0


def test_runs_of_end_marks_are_bounded(spark):
    texts = ["." * 200_000, "." * 150_000, "a" + "\n" * 70_000]
    assert all("".join(FP.PIECE.findall(t)) == t and max(map(len, FP.PIECE.findall(t))) <= 2 * FP.CELL + 1 for t in texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["near_next"] for r in FP.fingerprints(docs).collect()}
    assert abs(got[0] - 0.75) < 0.01 and got[1] == 0


def test_equal_digests_end(spark):
    """A sketch of equal digests never peels: the lists are compared instead, with their repetitions."""
    keys = np.array([(7 << 16) | 5, (7 << 16) | 5, (9 << 16) | 4, (7 << 16) | 5], np.uint64)
    a, b = (keys[:3], np.array([0, 3])), (keys[3:], np.array([0, 1]))
    one, two = FP.differing(a, b, np.array([0]), np.array([0]))
    assert (one.tolist(), two.tolist()) == ([9], [0])
    both = FP.differing(a, a, np.array([0]), np.array([0]))
    assert [x.tolist() for x in both] == [[0], [0]]


def test_an_id_of_many_rows_is_several_ranges(spark):
    rows = [(None if i % 3 else i, f"text {i}. " * (i % 5)) for i in range(900)] + [(5, "same")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    near = FP.neighbours(docs, 20)
    homes = near.where("guest = 0")
    assert homes.count() == len(rows)
    sizes = [r["count"] for r in homes.where("doc_id is null").groupBy("part").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 260  # texts of the null id repeat: 5 of 600 are empty copies
    got = FP.fingerprints(docs).collect()
    assert sorted((r["doc_id"] or -1, r["n_chars"]) for r in got) == sorted((i or -1, len(t)) for i, t in rows)
    # the chain of neighbours is one cycle over all rows: edited texts tell each next text
    order = sorted(((-1 if i is None else i), t) for i, t in rows)
    assert len(got) == len(order)


# ---- pages on broken markup --------------------------------------------------

@pytest.mark.parametrize("page", ["<p>a <!--", "<a href=\"x", "<b>", "<p a=\"<p>", "<![CDATA[", "<![if x", "--><!--", "<div><table><a>", "</", "&am", "<![a]"])
def test_broken_pages_take_time_in_proportion(page):
    import time
    start = time.time()
    H.main_text(page * (1_000_000 // len(page)) + "<p>end</p>")
    assert time.time() - start < 5


@pytest.mark.parametrize("first, last", [("<b>", "</x>"), ("<div>", "</x>"), ("<a><table><b>", "</a>"), ("<div>", "</p>"), ("<li>", "</ul>")])
def test_unmatched_end_tags_take_time_in_proportion(first, last):
    import time
    start = time.time()
    H.main_text(first * 60_000 + last * 60_000)
    assert time.time() - start < 5


@pytest.mark.parametrize("name", ["article-comments", "user-comments", "related-articles", "cookieBanner", "privacy-banner", "cookie-law-info-bar",
                                  "share-this", "commentList", "AdSlot"])
@pytest.mark.parametrize("inside", [True, False])
def test_notices_and_reader_comments_are_dropped(name, inside):
    box = f"<div class='{name}'><p>Nothing of the article.</p></div>"
    page = f"<body><article><p>{LONG}</p>{box if inside else ''}<p>End.</p></article>{'' if inside else box}"
    assert H.main_text(page) == LONG.strip() + "\nEnd."


def test_formulas_links_and_marked_sections():
    assert H.main_text(f"<article><p>{LONG}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math>.</p></article>").endswith("\nLet x=2.")
    assert H.main_text("<ul><li><a href=a>Home</a></li><li><a href=b>About us</a></li><li><a href=c>Contact</a></li></ul>") == ""
    assert H.main_text(f"<article><p>{LONG}</p><p>a <![if gte mso 9]>b<![endif]> <![CDATA[ c > d ]]>e</p><p>f <!-- g</p></article>").endswith("\na b e\nf g")


# ---- pages against a plain extractor -----------------------------------------

def plain_article(html):
    """The blocks of the article of a well-formed page: a tree, what is furniture cut off, text by block element."""
    from html import unescape
    html = re.sub(r"<!--.*?-->", "", html, flags=re.S)
    root = {"tag": "#", "attrs": "", "kids": []}
    stack = [root]
    for m in re.finditer(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*)>|([^<]+)", html):
        close, tag, attrs, data = m[1], (m[2] or "").lower(), m[3], m[4]
        if stack[-1]["tag"] in ("script", "style") and not (close and tag == stack[-1]["tag"]):
            continue
        if data is not None:
            stack[-1]["kids"].append(unescape(data))
        elif close:
            names = [x["tag"] for x in stack]
            if tag in names:
                del stack[len(names) - 1 - names[::-1].index(tag):]
        else:
            node = {"tag": tag, "attrs": attrs, "kids": []}
            stack[-1]["kids"].append(node)
            if tag not in H.VOID:
                stack.append(node)

    def find(node):
        for k in node["kids"]:
            if isinstance(k, dict):
                yield from ([k] if k["tag"] == "article" else find(k))

    def names(node):
        return [w for _, v in re.findall(r"(?:class|id|role)\s*=\s*([\"']?)([^\"'>]*)\1", node["attrs"]) for w in v.split()]

    lines = [""]

    def walk(node):
        if node["tag"] in H.DROPPED or any(map(H.named, names(node))):
            return
        block = node["tag"] in H.BLOCK
        if block:
            lines.append("")
        for k in node["kids"]:
            if isinstance(k, str):
                lines[-1] += k
            elif k["tag"] in ("br", "hr"):
                lines[-1] += " "
            else:
                walk(k)
        if block:
            lines.append("")

    for article in find(root):
        walk(article)
    return "\n".join(x for x in (" ".join(t.split()) for t in lines) if x)


def test_pages_equal_a_plain_extractor(spark):
    """All given pages have one well-formed article."""
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op10_main_text"](spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = plain_article(r["html"] or "")
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)
