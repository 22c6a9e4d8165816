"""Pages, pieces, chat and packing."""

from __future__ import annotations

import random
import zlib
from array import array

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import chat, packing, pages, pieces
from tidemark.llm.queries import tokenizer_path

WORDS = tokenizer_path("word_bpe_49k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")
PAGE = "page_id long, url string, html string, text string, key string"


def page(body, url=None, i=0):
    return (i, url, body, "t", "k")


def extracted(spark, rows):
    return {r["page_id"]: r["text"] for r in pages.extract_pages(spark.createDataFrame(rows, PAGE)).collect()}


def test_article_without_the_rest():
    html = """<html><head><title>x</title></head><body><header>Site</header><div id="cookie-notice">We use <b>cookies</b></div>
    <main><article><header><h1>T &amp; t</h1><p>by me</p></header><p>one <i>two</i>
    three<p class="ad">buy</p><p>four<aside>side</aside><ul><li>a<li>b</ul><form><input>q</form><!-- <p>no</p> -->
    <section class="comments"><p>nice!</p></section><script>if (a < b) "</p>"</script><p>1 &lt; 2 &#233;</article></main>
    <footer>f</footer></body></html>"""
    assert pages.main_text(html, None)[0] == "T & t\none two three\nfour\na\nb\n1 < 2 é"


def test_landmarks_by_role_and_outer_headers():
    html = '<div class="page-header">Site</div><div role="main"><div class="article-header"><h1>T</h1></div><p>x</div><p>y'
    assert pages.main_text(html, None)[0] == "T\nx"
    assert pages.main_text('<div id="topbar">a</div><div>b</div><p hidden>c<p style="display: none">d<p>e', None)[0] == "b\ne"


def test_lines_shared_with_the_nearest_page_go(spark):
    def made(text):
        return f"<body><p>Home<p>Log in<div><p>{text}<p>more {text}</div><p>All rights reserved</body>"

    rows = [page(made(f"story {i}"), f"http://h.org/en/{i}", i) for i in range(4)] + [page(made("alone"), "http://other.org/1", 9)]
    got = extracted(spark, rows)
    assert [got[i] for i in range(4)] == [f"story {i}\nmore story {i}" for i in range(4)]
    assert got[9] == "Home\nLog in\nalone\nmore alone\nAll rights reserved"


@pytest.mark.parametrize(
    "html",
    [
        "<article class='post category-advertising'><p>text</article>",
        "<article class='post has-comments sponsored'><p>text</article>",
        "<main class='with-sidebar'><p>text</main>",
        "<div id=page class='no-sidebar'><p>text</div>",
        "<div class='sidebar right-sidebar'><main><p>text<div class=related><article>x</article></div></main></div>",
        "<div class='widget'><div role=main id='sidebar'><p>text</div></div>",
        "<article>text</article><div class='comment-list'><article>x</article></div>",
        "<article>text<article class='comment'>x</article></article>",
    ],
)
def test_class_words_hide_no_landmark_or_its_wrapper(html):
    made = f"<body><nav>a</nav><div class='site-footer'>b</div><div class='ad ad-1'>c</div>{html}</body>"
    assert pages.main_text(made, None)[0] == "text"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<head><title>t</title><meta charset=utf-8><body><p>text", "text"),
        ("<head><title>t</title><p>text</p>", "text"),
        ("<head><noscript><img src=x><body>text", "text"),
        ("<head><meta charset=utf-8>text<p>more", "text\nmore"),
        ("<div>Main sentence <noscript><div>x</div></noscript></div>", "Main sentence"),
        ("<article><p>Text <button>Share</button></p></article>", "Text"),
        ("<article><p>Text <span class=ad>buy <span>it</span> now</span> goes <b>on</b></p></article>", "Text goes on"),
    ],
)
def test_hidden_elements_end_where_they_should(html, text):
    assert pages.main_text(html, None)[0] == text


def test_a_body_outside_the_teasers_stays(spark):
    def made(i):
        return f"<body><p>Home<article>teaser</article><div><p>story {i}<p>more {i}</div><p>All rights reserved</body>"

    got = extracted(spark, [page(made(i), f"http://h.org/{i}", i) for i in range(3)])
    assert got == {i: f"teaser\nstory {i}\nmore {i}" for i in range(3)}


def test_copies_of_an_article_stay(spark):
    html = "<body><nav>a</nav><article><p>same<p>text</article></body>"
    assert extracted(spark, [page(html, f"http://h.org/{i}", i) for i in range(3)]) == dict.fromkeys(range(3), "same\ntext")


@pytest.mark.parametrize("seed", range(3))
def test_nearest_pages(spark, seed):
    rng = random.Random(seed)
    rows = [(str(i), rng.choice("ab"), "/" + "/".join(rng.choice("xyz") for _ in range(3))) for i in range(40)] + [("z", "c", "/q")]
    got = dict(map(tuple, pages.nearest_pages(spark.createDataFrame(rows, "key string, host string, path string").repartition(7)).collect()))
    of = {k: (h, p) for k, h, p in rows}
    assert set(got) == {k for k, _, _ in rows} - {"z"}

    def shared(k, n):
        return len(pages.commonprefix([of[k][1], of[n][1]]))

    for k, n in got.items():
        assert of[k][0] == of[n][0]
        assert shared(k, n) == max(shared(k, o) for o in of if o != k and of[o][0] == of[k][0])


def test_pages_on_awkward_rows(spark):
    rows = [page(None), page("", i=1), page("plain text", "not a url", 2), page("<p>x", "http://h/1", 3), page("<p>x", "http://h/1", 3)]
    rows += [page("<div " * 50 + "<" * 1000 + "&amp", "http://h/2", 4), (None, None, "<article>n", None, None), page("<p>y" * 30_000, "http://h/3", 5)]
    got = pages.extract_pages(spark.createDataFrame(rows, PAGE)).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert (text[0], text[1], text[2], text[None]) == ("", "", "plain text", "n")
    assert pages.extract_pages(spark.createDataFrame([], PAGE)).collect() == []


def test_common_lines_are_a_longest_subsequence():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = pages.common_lines(a, b)
        rest = iter(b)
        assert len(found) == best[-1][-1] and all(a[k] in rest for k in found)


def encoded(docs, **sizes):
    return [(r["doc_id"], array("I", r["ids"]).tolist()) for r in pieces.encode_documents(docs, PIECES, **sizes).collect()]


def test_scan_equals_the_library(spark, docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(2)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).collect()]
    texts = [t[:1200] for t in texts] + [t[:400].replace(" ", "") for t in texts]
    texts += ["".join(rng.choice("aabeinorstT   \n19.é漢🙂") for _ in range(200)) for _ in range(60)] + [None, "", " ", "▁a ▁", texts[0]]
    for giant, chunk in ((30, 20), (100, 64), (10**6, 64)):
        assert encoded(docs(*texts), giant=giant, chunk=chunk) and dict(encoded(docs(*texts), giant=giant, chunk=chunk)) == {
            i: sp.encode(t or "") for i, t in enumerate(texts)
        }


def test_pieces_on_awkward_rows(spark, docs):
    assert encoded(docs()) == []
    frame = docs((1, "long text " * 20), (1, "long text " * 20), (None, None), (2, "é字🙂\n"))
    marked = pieces.encode_documents(frame, PIECES, giant=50, chunk=32)
    got = sorted((r["doc_id"] or 0, r["text"]) for r in pieces.decode_documents(marked, PIECES).collect())
    assert got == [(0, ""), (1, "long text " * 20), (1, "long text " * 20), (2, "é字🙂\n")]


def test_prefix_products_are_the_plain_ones():
    import numpy as np

    rng = np.random.default_rng(1)
    sizes = [1, *rng.integers(1, 5, 12), 1]
    ms = [np.where(rng.random((a, b)) < 0.3, pieces.NEVER, rng.random((a, b))) for a, b in zip(sizes, sizes[1:])]
    plain, out = ms[0], [ms[0]]
    for m in ms[1:]:
        plain = pieces.product(plain, m)
        out.append(plain)
    assert all(np.allclose(a, b) for a, b in zip(pieces.prefix_products(ms), out))


TURN = "conv_id long, turn long, role string, text string, segments string"


def test_chat_gives_turns_back(spark):
    rng = random.Random(3)
    bits = ["<|im_end|>", "<|", "~", "~0", "~1", "<~1", "|>", "\n", "a", "<", "|", "\\E", "<|im_part|>", "é"]
    turns = [(c, t, rng.choice(["user", "assistant", "a\nb~2"]), "".join(rng.choices(bits, k=rng.randint(0, 9))), "x") for c in range(30) for t in range(rng.randint(1, 8))]
    made = chat.format_chat(spark.createDataFrame(turns, TURN))
    rows = made.select("conv_id", chat.read_chat(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("loss"), "formatted").collect()
    assert len(rows) == 30
    for r in rows:
        own = [(role, text) for c, _, role, text, _ in turns if c == r["conv_id"]]
        assert [tuple(t) for t in r["t"]] == own
        assert r["loss"] == "".join(text for role, text in own if role == "assistant")
        runs = 1 + sum(a[0] != b[0] for a, b in zip(own, own[1:]))
        assert r["formatted"].count(chat.START) == r["formatted"].count(chat.END) == runs


def test_chat_on_awkward_rows(spark):
    rows = [(1, 0, None, None, "x"), (1, 0, None, None, "x"), (1, None, "user", "first", "x"), (None, 5, "user", "", "x"), (2, 1, "assistant", "b" * 10**6, "x")]
    made = chat.format_chat(spark.createDataFrame(rows, TURN))
    got = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in made.select("conv_id", chat.read_chat(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("user", "first"), ("", ""), ("", "")], None: [("user", "")], 2: [("assistant", "b" * 10**6)]}
    assert chat.format_chat(spark.createDataFrame([], TURN)).collect() == []


def test_word_encoder_equals_the_tokenizer(spark):
    tokenizer, encode = Tokenizer.from_file(WORDS), packing.WordEncoder(WORDS)
    rng = random.Random(2)
    letters = "ab éÉß.,'’ \n\t19½²ªμΣσςİ字🙂—_-$\x1c\x85 x÷×sTdre̊é"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(100).collect()]
    for text in [*texts, "don't we're O'S ... ,. a. b,", "."]:
        assert array("I", encode(text)).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_first_fit_decreasing_is_the_plain_one():
    rng = random.Random(1)
    for _ in range(100):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(1, 60))]
        free, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            at = next((k for k, room in enumerate(free) if room >= lengths[i]), len(free))
            free[at:] = free[at:] or [100]
            free[at] -= lengths[i]
            want[i] = at
        assert packing.first_fit_decreasing(lengths, 100) == [want[i] for i in range(len(lengths))]
        cut = packing.pack(lengths, 100)
        assert sum(sum(p[2] for p in s) < 100 for s in cut) <= 1
        parts = {i: sorted((s, n) for seq in cut for k, s, n in seq if k == i) for i in range(len(lengths))}
        for i, n in enumerate(lengths):
            assert sum(p[1] for p in parts[i]) == n and all(a[0] + a[1] == b[0] for a, b in zip(parts[i], parts[i][1:]))


def checked(rows, texts, size):
    """The pieces hold every id of every document once, and the sequences have no gaps."""
    tokenizer = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"] > 0
    for i, text in texts.items():
        parts = sorted(by_doc[i], key=lambda r: r["start"])
        whole = array("I", b"".join(r["ids"] for r in parts)).tolist()
        assert whole == [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        assert all(a["start"] + a["length"] == b["start"] for a, b in zip(parts, parts[1:]))
        assert {r["doc_tokens"] for r in parts} == {len(whole)}
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
    return [sum(r["length"] for r in p) for p in by_sequence.values()]


def test_packing(spark, docs):
    rng = random.Random(5)
    texts = {i: " ".join(rng.choice(["the", "cat", "unusualword", "x,"]) for _ in range(rng.randint(0, 200))) for i in range(300)} | {998: None, 999: "w " * 5000}
    rows = packing.pack_documents(docs(*texts.items()), WORDS, size=128, group_rows=60).collect()
    fills = checked(rows, texts, 128)
    assert sum(f < 128 for f in fills) <= 6


def test_packing_on_awkward_rows(spark, docs):
    assert packing.pack_documents(docs(), WORDS).collect() == []
    rows = packing.pack_documents(docs((4, "same"), (4, "same"), (None, "n"), (5, "")), WORDS).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 2), (4, 2), (4, 2), (5, 1)]
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 4
