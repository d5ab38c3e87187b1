"""Block-max text search against scoring every pair, the shared index, and the automaton join in several passes."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import retrieval as D
from millrace.operators import textmatch, textsearch as TS


def corpus(seed, n=300, words=60):
    """Skewed words, copies, empty texts; ids are strings in no order."""
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    docs = [(f"d{(i * 7919) % 10007}", " ".join(rng.choices(pool, weights, k=rng.randint(0, 40))), f"g{i % 3}" if i % 11 else None) for i in range(n)]
    docs += [(f"copy{i}", docs[5][1], docs[5][2]) for i in range(25)] + [("none", None, "g0"), (None, "w1 w2", "g0")]
    queries = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(40)] + [(40, None), (41, "nowhere"), (42, "w0"), (43, "w0 w0 w1")]
    return docs, queries


def by_hand(docs, queries, k, allowed=None, cosine=False):
    rows = [(d, Counter((t or "").split()), g) for d, t, g in docs if d is not None]
    rows = [r for r in rows if r[1]]
    n, avg = len(rows), np.mean([sum(c.values()) for _, c, _ in rows])
    df = Counter(t for _, c, _ in rows for t in c)
    smooth = lambda t: math.log((1 + n) / (1 + df[t])) + 1
    out = []
    for q, text in queries:
        s = []
        ask = Counter((text or "").split())
        q_norm = math.sqrt(sum((f * smooth(t)) ** 2 for t, f in ask.items()))
        for d, c, g in rows:
            shared = [t for t in ask if t in c]
            if not shared or allowed is not None and (q, g) not in allowed:
                continue
            if cosine:
                norm = math.sqrt(sum((f * smooth(t)) ** 2 for t, f in c.items()))
                v = sum(ask[t] * smooth(t) / q_norm * c[t] * smooth(t) / norm for t in shared)
            else:
                dl = sum(c.values())
                v = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * dl / avg)) for t in shared)
            s.append((-round(v, 6), d))
        out += [(q, d, -v, r) for r, (v, d) in enumerate(sorted(s)[:k], 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.query_id, r.doc_id, r.score, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("seed, block, node, common, postings", [(1, 4096, 16, 4, 1 << 20), (2, 50, 8, 3, 1 << 20), (3, 70, 16, 50, 30), (4, 7, 4, 2, 1 << 20)])
def test_search_equals_scoring_every_pair(spark, monkeypatch, seed, block, node, common, postings):
    for name, v in (("BLOCK_DOCS", block), ("NODE", node), ("COMMON", common), ("QUERY_POSTINGS", postings), ("QUERY_STEP", 16), ("PAIRS", 64)):
        monkeypatch.setattr(TS, name, v)
    docs, queries = corpus(seed)
    d = spark.createDataFrame(docs, "id string, body string, team string").repartition(3)
    q = spark.createDataFrame(queries, "qid int, ask string")
    index = TS.build_index(d, "id", "body", group_col="team", with_norm=True)
    assert index.n == sum(bool(t) and i is not None for i, t, _ in docs)
    assert rows_of(D.keyword_search(index, q, "qid", "ask", 5)) == by_hand(docs, queries, 5)
    assert rows_of(TS.cosine_search(index, q, "qid", "ask", 3)) == by_hand(docs, queries, 3, cosine=True)
    allowed = [(i, f"g{i % 3}") for i in range(0, 44, 2)] + [(1, "g0"), (1, "g1"), (3, "unknown"), (5, None)]
    groups = spark.createDataFrame(allowed, "query_id int, group string")
    got = rows_of(D.keyword_search(index, q, "qid", "ask", 5, query_groups=groups))
    assert got == by_hand(docs, queries, 5, allowed={a for a in allowed if a[1] is not None})


def test_pairs_are_skipped(spark):
    docs, queries = corpus(9, n=4000, words=800)
    index = TS.build_index(spark.createDataFrame(docs, "id string, body string, team string"), "id", "body")
    q = spark.createDataFrame(queries, "qid int, ask string")
    scored, pairs = (spark.sparkContext.accumulator(0) for _ in range(2))
    assert rows_of(D.keyword_search(index, q, "qid", "ask", 5, counters=(scored, pairs))) == by_hand(docs, queries, 5)
    assert 0 < scored.value < 0.2 * pairs.value


def test_empty_corpus_and_no_queries(spark):
    d = spark.createDataFrame([], "id string, body string, team string")
    q = spark.createDataFrame([(1, "a")], "qid int, ask string")
    index = TS.build_index(d, "id", "body")
    assert D.keyword_search(index, q, "qid", "ask", 5).collect() == []
    full = TS.build_index(spark.createDataFrame([("x", "a")], "id string, body string"), "id", "body")
    assert D.keyword_search(full, q.where("false"), "qid", "ask", 5).collect() == []
    assert [r.doc_id for r in D.keyword_search(full, q, "qid", "ask", 5).collect()] == ["x"]


def test_index_is_shared_until_its_files_change(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([("x", "a b")], "id string, body string").write.parquet(path)
    first = TS.shared_index(spark.read.parquet(path), "id", "body", name="docs")
    assert TS.shared_index(spark.read.parquet(path), "id", "body", name="docs") is first
    spark.createDataFrame([("y", "a c")], "id string, body string").write.mode("append").parquet(path)
    again = TS.shared_index(spark.read.parquet(path), "id", "body", name="docs")
    assert again is not first and again.n == 2


def test_contains_join_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(textmatch, "PATTERN_CHARS", 4)
    q = spark.createDataFrame([(1, "ab"), (2, "b"), (3, "abc"), (4, ""), (5, None), (6, "ab"), (7, "é😀")], "qid int, q string")
    t = spark.createDataFrame([(1, "xabcab"), (2, ""), (3, None), (4, "b"), (5, "_é😀_")], "tid int, t string").withColumn("n", F.lit(1))
    got = sorted((r.qid, r.tid) for r in textmatch.contains_join(q, "q", t, "t").collect())
    assert got == [(1, 1), (2, 1), (2, 4), (3, 1), (6, 1), (7, 5)]


def test_an_offer_costs_its_own_queries_only(monkeypatch):
    import numpy as np

    from millrace.operators import textsearch as TS
    h, rng = TS.Heaps(5000, 3, np.dtype("<U2")), np.random.default_rng(1)
    who, score = np.repeat(np.arange(5000), 8), rng.random(40000)
    doc = np.array([f"d{i}" for i in range(40000)])  # longer ids than at first
    h.add(who, score, doc)
    sizes, sort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sizes.append(len(keys[-1])) or sort(keys))
    h.add(np.array([7, 7, 4999]), np.array([2.0, 2.0, 3.0]), np.array(["x2", "x1", "y"]))
    assert max(sizes) <= 3 + 2 * 3  # the offers and the kept places of two queries, not those of all
    found = {}
    for q, d, s in zip(*h.best()):
        found.setdefault(int(q), []).append((-round(float(s), 6), str(d)))
    want = {}
    for q, d, s in [*zip(who.tolist(), doc.tolist(), score.tolist()), (7, "x2", 2.0), (7, "x1", 2.0), (4999, "y", 3.0)]:
        want.setdefault(q, []).append((-round(s, 6), d))
    assert found == {q: sorted(v)[:3] for q, v in want.items()}


@pytest.mark.parametrize("limit", [1 << 18, 9, 0])
def test_only_rows_of_rare_terms_are_shuffled_to_their_frequencies(spark, monkeypatch, limit):
    """The weights are the same wherever the cut is; rows of the most frequent terms meet a broadcast, a bounded one."""
    monkeypatch.setattr(TS, "COMMON_TERMS", limit)
    docs, _ = corpus(6)
    index = TS.build_index(spark.createDataFrame(docs, "id string, text string, g string"), "id", "text", with_norm=True)
    held = {d: Counter((t or "").split()) for d, t, _ in docs if d is not None and (t or "").split()}
    df = Counter(t for c in held.values() for t in c)
    w = {(d, t): f * (math.log((1 + len(held)) / (1 + df[t])) + 1) for d, c in held.items() for t, f in c.items()}
    norm = {d: math.sqrt(sum(w[d, t] ** 2 for t in c)) for d, c in held.items()}
    found = D.embed_text(index)
    got = {(r.doc_id, r.term): r.weight for r in found.collect()}
    assert found.count() == len(got) and got.keys() == w.keys()
    assert all(got[d, t] == pytest.approx(w[d, t] / norm[d]) for d, t in got)
    cut = index.frequent(limit)
    assert sum(n >= cut for n in df.values()) <= limit and (cut == 1 or sum(n >= cut // 2 for n in df.values()) > limit or cut > max(df.values()))
    logical = found._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" in logical and logical.count("Join ") == (1 if limit > len(df) else 3)


def test_a_block_meets_only_documents_that_can_be_among_the_best():
    """Whole-number bounds are so near that little more than the best documents is scored, copies of one text once."""
    import pyarrow as pa
    rng = np.random.default_rng(4)
    terms, k, n = 300, 5, 3000
    rows = [np.sort(rng.choice(terms, 40, replace=False)) for _ in range(n)]
    weights = [rng.random(40) + 0.1 for _ in range(n)]
    ask = [(q, t) for q in range(30) for t in rng.choice(terms, 12, replace=False).tolist()]
    unit = rng.random(terms) * 5 + 0.5
    q = TS.QueryBlock(pa.table({"query_id": [a for a, _ in ask], "term": [f"t{t:03}" for _, t in ask], "qw": [unit[t] * (1 + a % 3) for a, t in ask],
                                "unit": [unit[t] for _, t in ask]}), None, k)
    code = {t: i for i, t in enumerate(q.vocabulary.to_pylist())}
    found = TS.Classes(k)
    for copy in range(20):  # each text twenty times
        for i in range(n):
            kept = [(code[f"t{t:03}"], w) for t, w in zip(rows[i].tolist(), weights[i].tolist()) if f"t{t:03}" in code]
            found.add(np.zeros(len(kept), np.int64), np.array([t for t, _ in kept]), np.array([w for _, w in kept]), np.array([copy * n + i]))
    assert len(found.members) == n and max(map(len, found.members)) <= 4 * k + 1
    heaps = TS.Heaps(len(q.ids), k, np.dtype(np.int64))
    scored = TS.DocBlock(found, q).search(q, heaps, np.arange(len(q.ids)))
    assert scored <= 3 * k * len(q.ids)
    table = np.zeros((n, terms))
    for i in range(n):
        table[i, rows[i]] = weights[i]
    who, doc, score = heaps.best()
    for a in range(30):
        best = table[:, [t for x, t in ask if x == a]] @ np.array([unit[t] * (1 + a % 3) for x, t in ask if x == a])
        want = [(-round(best[i], 6), c * n + i) for i in np.argsort(-best)[:k] for c in range(k)]
        at = who == q.ids.to_pylist().index(a)
        assert sorted(zip((-np.round(score[at], 6)).tolist(), doc[at].tolist())) == sorted(want)[:k]


def test_rows_of_a_repeated_id_are_one_document(spark, monkeypatch):
    """Also where they lie in different batches; the length is that of all of them."""
    monkeypatch.setattr(TS, "TOKENS", 3)
    rows = [(1, "b a B", "x"), (2, "", "x"), (1, "c a", "x"), (3, None, "y"), (1, "d", "y"), (4, "Z z z, y", None)]
    index = TS.build_index(spark.createDataFrame(rows, "id long, body string, team string"), "id", "body", with_norm=True)
    assert sorted((r.doc_id, r.dl, r.terms, r.counts) for r in index.docs.collect()) == [(1, 6, ["a", "b", "c", "d"], [2, 2, 1, 1]), (4, 4, ["y", "z"], [1, 3])]
    assert {r.term: r.df for r in index.df.collect()} == dict.fromkeys("abcdyz", 1)
    teams = TS.build_index(spark.createDataFrame(rows, "id long, body string, team string"), "id", "body", group_col="team")
    assert sorted((r.doc_id, r.group, r.dl, r.terms) for r in teams.docs.collect() if r.doc_id == 1) == [(1, "x", 5, ["a", "b", "c"]), (1, "y", 1, ["d"])]
