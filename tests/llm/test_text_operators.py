"""HTML, tokens, BPE and fingerprints against brute force, the tokenizers library and exact round trips."""

import hashlib
import html as html_lib
import os
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F

from millrace.llm import bpe, fingerprint, htmltree, lexicon, tokencount

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# HTML

def test_articles_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in htmltree.extract(pages).collect()}
    for p in pages.collect():
        body = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [" ".join(html_lib.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[p.page_id].text == "\n".join(filter(None, blocks)) and got[p.page_id].n_chars == len(got[p.page_id].text)


def test_style_tree_removes_what_every_page_of_a_host_repeats(spark):
    def page(k):
        return (f"<body><div class=x1><p>Choose a region</p><p>Menu of the day</p></div><div class=x2><h1>Title {k}</h1><p>Story {k} begins."
                f"<p>All rights belong to us.</p><p>It ends {k * 7}.</p></div>")
    rows = [(k, f"http://site.example/{k}", page(k)) for k in range(20)] + [(99, "http://small.example/", page(99))]
    got = {r.page_id: r.text for r in htmltree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3] == "Title 3\nStory 3 begins.\nIt ends 21."
    assert "Choose a region" in got[99]  # one page says nothing about its host


def test_copies_of_an_article_are_not_boilerplate(spark):
    def article(k, n=4):
        return "".join(f"<p>Paragraph {j} of story {k}.</p>" for j in range(n))
    rows = []
    for k in range(100):  # 90 copies of one page and 10 others
        story = 0 if k < 90 else k
        rows.append((k, "http://article.example/", f"<body><ul><li>{k} visitors</ul><article>{article(story)}</article><p>Foot"))
        rows.append((1000 + k, "http://plain.example/", f"<body><div class=x1><p>Choose a region</p></div><div class=x2>{article(story)}</div>"))
        # Copies that differ by a line: the paragraphs as a branch are mostly those of the one story.
        rows.append((2000 + k, "http://line.example/", f"<body><article><h2>Seen {k} times</h2>{article(0 if k < 75 else k, 8 if k < 75 else 3)}</article>"))
    got = {r.page_id: r.text for r in htmltree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}

    def text(k, n=4):
        return "\n".join(f"Paragraph {j} of story {k}." for j in range(n))
    for k in range(100):
        assert got[k] == text(0 if k < 90 else k) and got[1000 + k] == got[k]
    assert all(got[2000 + k] == f"Seen {k} times\n{text(k, 3)}" for k in range(75, 100))


def test_names_do_not_take_the_main_text(spark):
    long = "A sentence of the main text of the page. " * 4
    page = {
        1: f"<div class='elementor-widget widget-title'><div class=elementor-widget-container><h1>Title</h1></div></div>"
           + "".join(f"<div class='elementor-widget e{k}'><div class=elementor-widget-container><p>{long}{k}</p></div></div>" for k in range(3))
           + "<div class=sidebar><p>Side <a href=x>link</a></p></div>",
        2: f"<div class=layout-with-sidebar><div><p>{long}</p></div><div class=sidebar><p>Side</p></div></div>",
        3: f"<section class='post share-enabled'><p>{long}</p><div class=share><p>Share this</p></div></section>",
        4: f"<div class=content><p>Intro</p><div class=layout-with-sidebar><article><p>{long}</p></article></div><div class=comments><p>{long}</p><p>{long}</p></div></div>",
        5: f"<div class=content><p>{long}</p><div class=promo-box><article><p>Teaser</p></article></div></div>",
        6: f"<div class=sidebar><p>{' '.join(f'<a href=x>{long}</a>' for _ in range(5))}</p></div><div><p>{long}</p></div>",
    }
    rows = [(k, f"http://names.example/{k}", h) for k, h in page.items()]
    got = {r.page_id: r.text for r in htmltree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    one = long.strip()
    assert got == {1: "\n".join(["Title", *(f"{long}{k}" for k in range(3))]), 2: one, 3: one, 4: one, 5: one, 6: one}


def test_declared_boilerplate_and_broken_markup(spark):
    page = ("<!DOCTYPE html><title>t</title><header>Site</header><nav><ul><li>a<li>b</ul></nav><main><article><header><h1>A &amp; B</h1></header>"
            "<p>one\n <b>two<br>three<p>four &eacute;&#33;<div class='ad box'>buy</div><form>f</form><script>if (a</p>) x</script><!-- <p>no</p> -->"
            "<section class=comments><article><p>first!</p></article></section><aside>see also</aside><ul><li>x<li>y</ul></article></main><footer>c</footer>")
    rows = [(1, "http://a.example/", page), (2, None, None), (3, "", "plain <b>text"), (4, "x", "<![if x]><p>ok<![endif]>"), (5, "x", "<div class=ad>buy<article><p>kept</article>")]
    got = {r.page_id: r.text for r in htmltree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {1: "A & B\none two three\nfour é!\nx\ny", 2: "", 3: "plain text", 4: "ok", 5: "kept"}


# Token files

def test_token_counts(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = {r.doc_id: len(model.encode(r.text or "")) for r in docs.collect()}
    for block in (64, tokencount.BLOCK_BYTES):  # most documents span many small blocks
        got = {r.doc_id: r.n_tokens for r in tokencount.document_tokens(docs, P.path("piece_bpe_32k.model"), block_bytes=block).collect()}
        assert got == want


def test_separator_scan_of_files(spark, tmp_path):
    rnd = np.random.default_rng(4)
    want = {}
    for f in range(4):
        lengths = [int(x) for x in rnd.choice([0, 0, 1, 5, 700], size=30)] + ([3] if f == 1 else [])
        tokens = np.concatenate([np.append(rnd.integers(3, 9, n), 2) for n in lengths])
        (tokens[:-1] if f == 1 else tokens).astype("<u2").tofile(tmp_path / f"f{f}.bin")
        want |= {(f"f{f}.bin", k): n for k, n in enumerate(lengths)}
    (tmp_path / "empty.bin").touch()
    got = tokencount.count_tokens(spark, str(tmp_path), 2, block_bytes=128)
    assert {(os.path.basename(r.path), r.ordinal): r.n_tokens for r in got.collect()} == want


# BPE

ALPHABET = ["a", "É", "é", "é", "Σ", "ς", "İ", "'s", "'ll", " ", "\n", "\x1c", "\x85", "\xa0", "１", "½", "中", "<|endoftext|>", "<|", "😀",
            "\u0000", "ǅ", "ß", "ﬁ", "THE", "1234", "...", "'", " ", "thstingsh", "ing"]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def test_bpe_equals_the_library(spark, docs, reference):
    rnd = random.Random(1)
    rows = [(k, "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40)))) for k in range(400)]
    rows += [(1000, "ab" * 500), (1001, "thstingsh" * 40), (1002, "x" * 3000)] + [(2000 + r.doc_id, r.text) for r in docs.collect()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = dict(rows)
    want = {i: reference.encode(t or "", add_special_tokens=False).ids for i, t in texts.items()}
    for r in bpe.digest(df, P.path("word_bpe_49k.json"), limit=500).collect():
        decoded = reference.decode(want[r.doc_id], skip_special_tokens=False)
        assert r.n_tokens == len(want[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    encoded = bpe.encode(df, P.path("word_bpe_49k.json"))
    assert {r.doc_id: r.ids for r in encoded.collect()} == want
    assert all(r.text == reference.decode(want[r.doc_id], skip_special_tokens=False)
               for r in bpe.decode(encoded, P.path("word_bpe_49k.json")).where("doc_id < 2000").collect())


def test_pieces_do_not_change_ids(monkeypatch, reference, docs):
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        t = bpe.Tokenizer(f.read())
    e = bpe.Encoder(t, lexicon.Lexicon(lexicon.compile_lexicon({})))
    texts = [r.text for r in docs.limit(20).collect()]
    whole = list(e.digests(texts))
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    monkeypatch.setattr(bpe.pieces, "__defaults__", (50,))
    assert list(e.digests(texts)) == whole


def test_lexicon_is_exact_and_shares_suffixes():
    words = {f"{a}{b}ing".encode(): [len(a), 7] for a in ("walk", "talk", "be", "see") for b in ("", "s", "é")}
    lex = lexicon.Lexicon(lexicon.compile_lexicon(words))
    ask = [*words, b"walk", b"walkin", b"xing", b"", b"walkingg"]
    numbers = lex.numbers(ask)
    assert [lex.output(int(n)) for n in numbers[:len(words)]] == list(words.values()) and (numbers[len(words):] == -1).all()
    assert len(lex.finals) < 25  # a trie would need one state a prefix: over 60


# Fingerprints

def test_fingerprints_of_documents(docs):
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    by_text = {}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        q = len(text) // 4
        changed = text[:len(text) - q] + following[:q]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.common_edited == len(os.path.commonprefix((text, changed))) and r.common_next == len(os.path.commonprefix((text, following)))
        assert r.edited_fingerprint == str(fingerprint.Fingerprint(changed))
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        if len(changed) == len(text) > 60:
            assert r.near_edited >= 0.6
        if text != following:
            assert r.near_next < 0.5 or r.near_next < r.near_edited
    assert len(set(by_text.values())) == len(by_text)


def test_span_hashes_and_extensions(monkeypatch):
    rnd = random.Random(8)
    a = "".join(rnd.choice("ab") for _ in range(500))
    h = fingerprint.prefix(fingerprint.codes(a))
    for _ in range(300):
        i, j, n = rnd.randrange(480), rnd.randrange(480), rnd.randint(1, 20)
        assert (fingerprint.span_hash(h, i, n) == fingerprint.span_hash(h, j, n)) == (a[i:i + n] == a[j:j + n])
    whole = str(fingerprint.Fingerprint(a))
    monkeypatch.setattr(fingerprint, "BLOCK", 64)
    assert str(fingerprint.Fingerprint(a)) == whole
    for _ in range(50):
        i, j = rnd.randrange(500), rnd.randrange(500)
        assert fingerprint.longest_common_extension(a, a, i, j) == len(os.path.commonprefix((a[i:], a[j:])))


def test_same_results_for_any_number_of_ranges(spark, docs):
    few = docs.where(F.col("doc_id") < 7)
    one = few.where("doc_id = 3")
    assert one.count() == 1 and fingerprint.fingerprints(one).first().near_next == 1.0
    got = {r.doc_id: r.common_next for r in fingerprint.fingerprints(few).collect()}
    rows = sorted((r.doc_id, r.text or "") for r in few.collect())
    assert got == {i: len(os.path.commonprefix((t, rows[(k + 1) % len(rows)][1]))) for k, (i, t) in enumerate(rows)}


def test_short_and_long_texts_share_a_sketch():
    rnd = random.Random(8)
    short = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=149))
    for long in (f"{short} {short}.", f"{short} {short}" + "".join(rnd.choices("ABC", k=20))):
        assert fingerprint.Fingerprint(short).likeness(fingerprint.Fingerprint(long)) > 0.7
