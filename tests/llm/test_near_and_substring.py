"""Near-duplicates and repeated strings against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import graph, minhash, substring

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}


def brute_components(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def brute_removed(docs):
    seen, out = set(), {}
    for i, b in sorted(docs):
        cover = bytearray(len(b))
        for k in range(len(b) - 99):
            w = b[k:k + 100]
            if w in seen:
                cover[k:k + 100] = b"\1" * 100
            seen.add(w)
        runs = sum(1 for k in range(len(b)) if cover[k] and (k == 0 or not cover[k - 1]))
        out[i] = (len(b), sum(cover), runs, hashlib.sha256(bytes(x for x, c in zip(b, cover) if not c)).hexdigest())
    return out


@pytest.fixture(scope="module")
def edited_copies(spark):
    """Chains of copies with growing edits (links through the middle only), a shared passage, short texts."""
    rnd = random.Random(5)
    vocab = [f"w{k}" for k in range(3000)]
    passage = " ".join(rnd.choice(vocab) for _ in range(40))
    rows = []
    for g in range(12):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([12, 60, 200]))]
        for _ in range(10):
            rows.append(" ".join(words))
            for _ in range(max(1, len(words) // 60)):
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
    rows += [passage + " " + " ".join(rnd.choice(vocab) for _ in range(rnd.choice([4, 9, 30]))) for _ in range(60)]
    rows += ["A b C", "a B c", "a b c d", "", None, " \t", rows[0].upper()]
    rnd.shuffle(rows)
    return spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")


def test_near_duplicates(edited_copies):
    want = brute_components([(r.doc_id, r.text) for r in edited_copies.collect()])
    got = {r.doc_id: r for r in minhash.near_duplicates(edited_copies).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_texts_that_share_an_id_are_told_apart(spark):
    rnd = random.Random(9)
    a, b = ([f"{x}{rnd.randrange(900)}" for _ in range(80)] for x in "ab")
    changed = lambda words: " ".join(words[:-1] + ["end"])
    for first, second in ((a, b), (b, a)):  # whichever of the two a choice by id alone would take
        rows = [(5, " ".join(first)), (5, " ".join(second)), (2, changed(first)), (9, " ".join(second)), (8, changed(second)),
                (20, "x y " + " ".join(f"c{k}" for k in range(60))), (20, "x z " + " ".join(f"c{k}" for k in range(60)))]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        key = {i: r.k for i, r in enumerate(docs.select(minhash.text_key().alias("k")).collect())}
        got = {(r.doc_id, r.text_key): (r.component_id, r.kept) for r in minhash.near_duplicates(docs, with_text_key=True).collect()}
        assert [got[i, key[k]] for k, (i, _) in enumerate(rows[:5])] == [(2, False), (5, True), (2, True), (5, False), (5, False)]
        assert sorted(got[i, key[k]] for k, (i, _) in enumerate(rows) if i == 20) == [(20, False), (20, True)]

        table = docs.selectExpr("*", "'en' lang", "'s' source", "1L n_chars")
        left = {(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, table, "").collect()}
        assert {x for x in left if x[0] < 20} == {rows[1], rows[2]} and len(left) == 3


def test_sequential_test_keeps_pairs_at_the_threshold():
    n = 32 * minhash.STEPS[0]
    chance = 0.75 + 0.25 / 4
    assert minhash.tail(n, minhash.least_matches(n), chance) >= minhash.MISS > minhash.tail(n, minhash.least_matches(n) - 1, chance)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for other, stays in ((54, True), (700, False)):  # similarity 300/400 to a set with 300 in common, and far below
        b = np.concatenate([a[:346] if stays else a[:200], rng.integers(0, 1 << 63, other, dtype=np.uint64)])
        d = np.bitwise_xor(*(minhash.two_bits(minhash.signature(s)).view(np.uint64) for s in (a, b)))
        d = (d | d >> np.uint64(1)) & np.uint64(0x5555555555555555)
        agree = 32 * minhash.WORDS - sum(int(x).bit_count() for x in d)
        assert (agree >= minhash.least_matches(32 * minhash.WORDS)) == stays


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 50), (50, 101), (7, 7), (200, 300)] + [(1000, k) for k in range(1001, 1100)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[k] for k in range(1, 41)} == {1} and got[101] == 50 and got[300] == 200 and got[1099] == 1000


@pytest.fixture(scope="module")
def pasted(spark):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abé ") for _ in range(400)) for _ in range(4)]
    rows = []
    for i in range(120):
        s = ""
        for _ in range(rnd.randint(0, 5)):
            x = rnd.randint(0, 300)
            s += rnd.choice(base)[x:x + rnd.randint(50, 250)]
            if rnd.random() < 0.3:
                s += "z" * rnd.randint(1, 300)
            if rnd.random() < 0.3:
                s += "".join(rnd.choice("xy") for _ in range(rnd.randint(1, 150)))
        rows.append((i, s))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("batch", [substring.BATCH, 10])  # 10: most groups go the way of large groups
def test_repeats(pasted, batch, monkeypatch):
    monkeypatch.setattr(substring, "BATCH", batch)
    want = brute_removed([(r.doc_id, r.text.encode()) for r in pasted.collect()])
    assert {r.doc_id: tuple(r)[1:] for r in substring.remove_repeats(pasted).collect()} == want


def test_repeats_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_removed([(r.doc_id, (r.text or "").encode()) for r in docs.collect()])
    assert {r.doc_id: tuple(r)[1:] for r in substring.remove_repeats(docs).collect()} == want


def test_windows_across_blocks(monkeypatch):
    data = bytes(random.Random(2).choices(b"ab", k=3000))
    whole = substring.occurrences(data)
    monkeypatch.setattr(substring, "BLOCK", 500)
    parts = substring.occurrences(data)

    def spread(x):
        return sorted((int(f) + k, int(g), int(o) - k) for g, _, f, c, o in zip(*x) for k in range(c))
    assert spread(whole) == spread(parts) and len(spread(whole)) == len(data) - 99
