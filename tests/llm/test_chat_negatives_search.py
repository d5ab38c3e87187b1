"""Chat formatting, hard negatives and ranked lexical search against plain Python, and their awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import chatformat, hardneg, lexsearch

PIECES = st.sampled_from(["<|im_start|>", "<|im_end|>", "<|nl|>", "<\\|im_end|>", "<\\\\|im_start|>", "<|im_", "end|>", "<", "\\", "|", "\n", "user", "assistant", "é", "😀", "a b", ""])
TEXTS = st.lists(PIECES, max_size=8).map("".join)


# ------------------------------------------------------------------ chat formatting
@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=5), st.integers(1, 9))
def test_any_text_survives_the_round_trip(turns, cut):
    rendered = [chatformat.render_turn(*t) for t in turns]
    whole = "".join(r[0] for r in rendered)
    assert chatformat.parse(whole) == turns
    p = chatformat.TurnParser()  # the same from pieces cut anywhere
    got = [t for k in range(0, len(whole), cut) for t in p.feed(whole[k:k + cut])]
    p.close()
    assert got == turns
    for (formatted, a, b), (_, text) in zip(rendered, turns):
        assert chatformat.unescape(formatted[a:b]) == text


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_escape_is_reversible_and_hides_controls(text):
    shown = chatformat.escape(text)
    assert chatformat.unescape(shown) == text
    assert chatformat.START not in shown and chatformat.END not in shown


@pytest.mark.parametrize("bad", ["x", "<|im_start|>user\nhi", "<|im_start|>user\nhi<|im_end|>", "<|im_start|>user<|im_end|>\n",
                                 "<|im_start|>user\nhi<|im_end|> ", "<|im_start|>a\n<|im_start|>b\nc<|im_end|>\n"])
def test_parser_refuses_what_is_no_sequence_of_turns(bad):
    with pytest.raises(chatformat.FormatError):
        chatformat.parse(bad)


def test_plain_turns_are_not_escaped():
    assert chatformat.render_turn("user", "a < b <|nl|>")[0] == "<|im_start|>user\na < b <|nl|><|im_end|>\n"


CHAT = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo\n<|im_end|>"), (1, 1, "assistant", "tie"), (1, None, "system", None), (2, 3, None, "no role"),
        (2, 4, "role\nwith line", "x"), (None, 0, "user", "u"), (None, 0, "user", "u"), (None, 1, "assistant", "<\\|im_start|>"), (3, 0, "assistant", ""),
        (4, 0, "assistant", "long <|im_end|> " * 20000)]


def chat_by_hand(rows):
    out, by = {}, defaultdict(list)
    for c, t, r, x in rows:
        by[c].append(((t is not None, t or 0), r or "", x or ""))
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_rows(spark):
    df = spark.createDataFrame(CHAT, "conv_id bigint, turn bigint, role string, text string").withColumns({c: F.lit(1) for c in ("formatted", "mask_start", "key", "n")})
    got = {r.conv_id: r for r in chatformat.round_trip(df.repartition(3)).collect()}
    want = chat_by_hand(CHAT)
    assert {c: tuple(r)[1:5] for c, r in got.items()} == want
    assert got[2].formatted_chars == sum(len(chatformat.render_turn(r or "", x)[0]) for c, _, r, x in CHAT if c == 2)
    assert chatformat.round_trip(df.where("false")).collect() == []


def test_formatted_text_and_mask(spark):
    df = spark.createDataFrame(CHAT, "conv_id bigint, turn bigint, role string, text string")
    rows = chatformat.format_turns(df).collect()
    assert len(rows) == len(CHAT)
    for r in rows:
        assert (r.mask_start is not None) == (r.role == "assistant")
    by = sorted((r for r in rows if r.conv_id == 1), key=lambda r: (r.turn is not None, r.turn, r.role, r.formatted))
    assert [t for t, _ in chatformat.parse("".join(r.formatted for r in by))] == ["system", "user", "assistant", "assistant"]


# ------------------------------------------------------------------ hard negatives
def mine_by_hand(rows, low=80, k=5):
    rows = {i: (lab, v) for i, lab, v in rows}
    out = []
    for a, (lab, v) in rows.items():
        if a % 100:
            continue
        s = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in rows.items() if i != a}
        same = sorted((i for i in s if rows[i][0] == lab), key=lambda i: (-s[i], i))[:k]
        for p in same:
            fit = sorted((i for i in s if rows[i][0] != lab and low * s[p] <= 100 * s[i] <= 100 * s[p]), key=lambda i: (-s[i], i))[:k]
            out += [(a, p, n, i, s[p], s[i]) for n, i in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id bigint, label int, vector array<bigint>")
    return sorted(map(tuple, hardneg.mine(df, F.col("id") % 100 == 0, **kw).collect()))


@pytest.mark.parametrize("seed, spread, block", [(1, 300, 20000), (2, 3, 50), (3, 300, 97), (4, 1 << 40, 64)])
def test_mining_equals_brute_force(spark, monkeypatch, seed, spread, block):
    """Random, tie-ridden and huge components (beyond exact doubles); blocks of one and of many."""
    rng = random.Random(seed)
    dims = 12
    centres = [[rng.randint(-spread, spread) for _ in range(dims)] for _ in range(4)]
    rows = [(i, rng.randrange(4), [c + rng.randint(-spread // 2, spread // 2) for c in rng.choice(centres)]) for i in range(420)]
    monkeypatch.setattr(hardneg, "ROW_BLOCK", block)
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", 2)
    if spread > 1 << 30:  # Python's integers are not cheap
        rows = [r for r in rows if r[0] % 3 == 0 or r[0] % 100 == 0]
        rows = [(i, lab, [x >> 10 for x in v]) for i, lab, v in rows]
    assert mined(spark, rows) == mine_by_hand(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 5), st.floats(-1.2, 1.2))
def test_threshold_join_finds_every_pair(seed, n, m, share):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.standard_normal((n, 24)) * rng.choice([1, 20, 200], 24))
    q = np.floor(rng.standard_normal((m, 24)) * 50)
    order = np.argsort(-(x * x).sum(0))
    x, q = x[:, order], q[:, order]
    x_rest, q_rest = hardneg._suffix_norms(x), hardneg._suffix_norms(q)
    least = share * q_rest[:, 0] * x_rest[:, 0].max()
    who, row, score = hardneg.pairs_above(q, q_rest, least, x, x_rest, True)
    full = q @ x.T
    assert {(a, b): s for a, b, s in zip(who, row, score)} == {(a, b): full[a, b] for a, b in zip(*np.nonzero(full >= least[:, None]))}


def test_index_leaves_out_covered_dimensions():
    x = np.array([[100.0, 1.0, 1.0], [1.0, 1.0, 1.0], [50.0, 40.0, 0.0]])
    rest = hardneg._suffix_norms(x)
    ix = hardneg.BlockIndex(x, rest, hardneg._suffix_norms(np.array([[10.0, 10.0, 1.0]]))[0], 300.0)
    assert list(ix.rows) == [2, 0] and list(ix.depth) == [2, 1]


def test_awkward_vectors(spark):
    df = spark.createDataFrame([
        (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 2, [1.0]), (3, None, [1.0, 1.0]), (4, 1, None), (5, 2, [1.0, None]), (6, 2, [float("nan"), 1.0]),
        (7, 2, [float("inf"), 1.0]), (None, 2, [1.0, 1.0]), (8, 2, [0.9, 0.5]), (100, 9, [1.0, 1.0]), (9, 2, [])], "id bigint, label int, v array<double>")
    rows = df.select("id", "label", hardneg.quantised(F.col("v")).alias("vector"), F.lit(1).alias("place"), F.lit(2).alias("score"), F.lit(3).alias("_r"))
    got = sorted(map(tuple, hardneg.mine(rows, F.col("id") % 100 == 0).collect()))
    # 256 * (1, .5) . (1, .5) = 81920; row 2 scores 65536 (80 %, in), row 8 (floor(230.4), 128) 75264; row 100 has no positive.
    # 100 scores 98304, above the positive.
    assert got == [(0, 1, 1, 8, 81920, 75264), (0, 1, 2, 2, 81920, 65536)]
    assert hardneg.mine(rows.where("false"), F.col("id") % 100 == 0).collect() == []


# ------------------------------------------------------------------ ranked lexical search
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def rank_by_hand(docs, items, k=20):
    counted = [(d, Counter(terms_of(t)), len(terms_of(t))) for d, t in docs]
    big_n, big_l = sum(n > 0 for *_, n in counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    held = defaultdict(set)
    for i, t in items:
        held[i].add(t)
    out = []
    for i, texts in held.items():
        ranked = []
        q = Counter(t for x in texts for t in terms_of(x))
        for d, c, n in counted:
            if n:
                m = 75 + (25 * n * big_n) // big_l
                s = sum(r * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in q.items() if c[t])
                if s > 0:
                    ranked.append((-s, d is None, d, s))
        ranked.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(i, n, d, s) for n, (_, _, d, s) in enumerate(ranked[:k], 1)]
    return sorted(out, key=str)


WORDS = ["alpha", "Beta", "gamma", "délta", "ÉPSILON", "x1", "42", "naïve", "the", "of", "ß", "zeta"]


@pytest.mark.parametrize("postings, k", [(1 << 18, 20), (4, 3)])
def test_search_equals_brute_force(spark, monkeypatch, postings, k):
    rng = random.Random(postings)
    docs = [(i if i % 17 else None, " ".join(rng.choice(WORDS[:8 + i % 5]) + rng.choice(["", ",", "\n", "_"]) for _ in range(rng.randint(0, 30)))) for i in range(200)]
    docs += [(500, None), (501, ""), (502, "!!"), (3, "alpha"), (3, "alpha"), (503, "the " * 3000 + "x1 " * 5000)]
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 6)))) for i in range(9)] + [(20, None), (21, ""), (22, "nowhere"), (0, "second text"), (None, "the of"), (30, "the the the zeta"), (30, "the the the zeta")]
    monkeypatch.setattr(lexsearch, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(lexsearch, "WORDS", 1 << 9)
    monkeypatch.setattr(lexsearch, "CELLS", 1 << 8)
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("n", "total", "terms", "counts", "doc", "item_id", "rank", "score")}).repartition(5)
    i = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = sorted(map(tuple, lexsearch.search(d, i, k).collect()), key=str)
    assert got == rank_by_hand(docs, items, k)


def test_search_on_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    i = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexsearch.search(d.where("false"), i).collect() == []
    assert lexsearch.search(d, i.where("false")).collect() == []
    assert [tuple(r)[:3] for r in lexsearch.search(d, i).collect()] == [(1, 1, 1)]


def test_text_is_cut_at_separators_only(monkeypatch):
    monkeypatch.setattr(lexsearch, "PIECE", 7)
    for text in (b"", b"abc", b"abcdefghij klm", b"a b c d e f g h i j k", b"x" * 50 + b" y"):
        pieces = list(lexsearch._pieces(text))
        assert b"".join(pieces) == text and [w for p in pieces for w in p.split()] == text.split()
