"""Dense text vectors: against brute force, texts without a shared word, awkward rows, and as an index of vectors."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.operators import densetext as DT
from millrace.operators import retrieval as D
from millrace.operators import textsearch as TS

SCHEMA = "doc_id bigint, text string"


def dense(spark, rows):
    return DT.embed_dense(TS.build_index(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", with_norm=True))


def by_hand(rows):
    """The same two steps with a dense document-term matrix."""
    counts = {i: Counter(t.lower().split()) for i, t in rows if i is not None and (t or "").split()}
    ids, terms = sorted(counts), sorted({t for c in counts.values() for t in c})
    tf = np.array([[counts[i][t] for t in terms] for i in ids], dtype=float)
    a = tf * (np.log((1 + len(ids)) / (1 + (tf > 0).sum(axis=0))) + 1)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    signs = np.array([[1 if c >= "8" else -1 for c in hashlib.sha256(str(i).encode()).hexdigest()] for i in ids])
    t = a.T @ signs
    t /= np.linalg.norm(t, axis=1, keepdims=True)
    v = a @ t
    return dict(zip(ids, v / np.linalg.norm(v, axis=1, keepdims=True)))


def topics():
    """Two topics of 30 words; a text takes six words of one. Ids 900 and 901 share no word but are of one topic."""
    rng = np.random.default_rng(7)
    words = [[f"{topic}{w}" for w in range(30)] for topic in ("ship", "sale")]
    rows = [(i, " ".join(rng.choice(words[i % 2], 6, replace=False))) for i in range(300)]
    return rows + [(900, " ".join(words[0][:5])), (901, " ".join(words[0][20:25])), (902, " ".join(words[1][10:15]))]


def test_equals_brute_force(spark):
    rows = topics() + [(1000, None), (1001, ""), (1002, "..."), (None, "ship1 ship2"), (1003, "ship1 " * 5000)]
    got = {r.doc_id: np.array(r.vector) for r in dense(spark, rows).collect()}
    want = by_hand([(i, "" if t == "..." else t) for i, t in rows])
    assert got.keys() == want.keys() and not got.keys() & {1000, 1001, 1002, None}
    assert all(got[i] == pytest.approx(want[i], abs=2e-6) for i in got)


def test_texts_without_a_shared_word_meet(spark):
    """A single pair has noise of about 1 / sqrt(dimensions), so all pairs of texts without a shared word are compared."""
    rows = [(i, t) for i, t in topics() if i < 300]
    got = {r.doc_id: np.array(r.vector) for r in dense(spark, rows).collect()}
    words = {i: set(t.split()) for i, t in rows}
    apart = [(i, j) for i in words for j in words if i < j and not words[i] & words[j]]
    same = np.array([got[i] @ got[j] for i, j in apart if i % 2 == j % 2])
    other = np.array([got[i] @ got[j] for i, j in apart if i % 2 != j % 2])
    assert len(same) > 1000 and same.mean() > other.mean() + 0.3
    assert (same > np.quantile(other, 0.95)).mean() > 0.9


def test_vectors_are_searched_by_the_index(spark):
    vectors = D.unit_vectors(dense(spark, topics()), "doc_id", "vector", []).select("id", "vector")
    queries = spark.createDataFrame(vectors.where("id < 100").collect()).toDF("query_id", "vector")
    found = D.knn_exact(vectors.where("id < 300"), queries, k=10, exclude_self=True).collect()
    assert len(found) == 1000  # the parity of an id is its topic
    assert np.mean([r.id % 2 == r.query_id % 2 for r in found]) > 0.99


def test_empty_table_gives_no_vectors(spark):
    assert dense(spark, []).count() == 0


def test_chunks_and_steps_do_not_change_the_sums(monkeypatch):
    """Partial sums of small chunks, merged while terms cross batches, are those of one chunk."""
    rng = np.random.default_rng(3)
    docs = [sorted(rng.choice(40, rng.integers(1, 12), replace=False)) for _ in range(60)] + [list(range(40))]
    rows = pa.table({"norm": rng.random(61) + 0.5, "terms": [[f"t{t:02}" for t in d] for d in docs],
                     "counts": pa.array([[int(rng.integers(1, 5)) for _ in d] for d in docs], pa.list_(pa.int32())),
                     "signs": rng.integers(-2 ** 63, 2 ** 63 - 1, 61)})

    def merged(chunk, step, batch):
        monkeypatch.setattr(DT, "CHUNK", chunk)
        monkeypatch.setattr(DT, "STEP", step)
        parts = pa.Table.from_batches(list(DT._chunk_terms(iter(rows.to_batches(max_chunksize=batch))))).sort_by("term")
        sums = pa.Table.from_batches(list(DT._merge_terms(iter(parts.combine_chunks().to_batches(max_chunksize=batch)))))
        assert sums["term"].to_pylist() == [f"t{t:02}" for t in range(40)]
        return len(parts), np.array(sums["v"].to_pylist())

    whole, want = merged(1 << 18, 1 << 15, 100)
    assert whole == 40
    for chunk, step, batch in ((1, 1, 1), (7, 3, 5), (50, 8, 100), (1000, 2, 7)):
        parts, got = merged(chunk, step, batch)
        assert got == pytest.approx(want) and (parts > 40 or chunk == 1000)


def test_terms_that_cancel_out_give_no_vector():
    docs = pa.table({"g": [0, 0], "doc_id": [1, 2], "terms": [["a", "b"], ["b"]], "counts": pa.array([[1, 1], [3]], pa.list_(pa.int32()))})
    v = np.ones(DT.DIMS)
    vectors = pa.table({"g": [0, 0], "term": ["a", "b"], "v": [list(v), list(-v)], "idf": [2.0, 2.0]})
    assert DT._documents(docs, vectors)["doc_id"].to_pylist() == [2]
    assert DT._documents(docs, vectors.slice(0, 0)).num_rows == 0


def test_terms_of_few_documents_travel_packed():
    """Below ``PACKED`` documents a term moves as two numbers a document, also where its parts come from several chunks."""
    rng = np.random.default_rng(5)
    docs = [["all", f"one{i}"] + (["some"] if i % 5 == 0 else []) for i in range(100)]
    rows = pa.table({"norm": rng.random(100) + 0.5, "terms": docs, "counts": pa.array([[1] * len(d) for d in docs], pa.list_(pa.int32())),
                     "signs": rng.integers(-2 ** 63, 2 ** 63 - 1, 100)})
    parts = pa.Table.from_batches(list(DT._chunk_terms(iter(rows.to_batches()))))
    assert sum(len(v) for v in parts["v"].to_pylist()) == DT.DIMS  # of the word "all"
    halves = [b for lo in (0, 50) for b in DT._chunk_terms(iter(rows.slice(lo, 50).to_batches()))]
    for held in (parts, pa.Table.from_batches(halves)):
        by_term = held.sort_by("term").combine_chunks()
        dense = pa.Table.from_batches(list(DT._merge_terms(iter(by_term.to_batches(max_chunksize=9)))))
        packed = pa.Table.from_batches(list(DT._merge_terms(iter(by_term.to_batches(max_chunksize=9)), packed=True)))
        size = {t: (len(v), len(s)) for t, v, s in zip(*(packed[c].to_pylist() for c in ("term", "v", "signs")))}
        assert size["all"] == (DT.DIMS, 0) and size["some"] == (0, 20) and size["one7"] == (0, 1) and len(size) == 102
        sums = DT._unpacked(packed)
        want = np.array(dense["v"].to_pylist())
        assert packed["term"].to_pylist() == dense["term"].to_pylist()
        assert sums / np.linalg.norm(sums, axis=1, keepdims=True) == pytest.approx(want)


@pytest.mark.parametrize("hot, packed, group", [(1 << 15, 32, 1 << 20), (0, 32, 50), (20, 2, 50), (7, 1 << 30, 10)])
def test_broadcast_and_packed_terms_do_not_change_the_vectors(spark, monkeypatch, hot, packed, group):
    for name, v in (("HOT", hot), ("PACKED", packed), ("GROUP", group)):
        monkeypatch.setattr(DT, name, v)
    rows = topics() + [(1003, "ship1 " * 50 + "alone")]
    got = {r.doc_id: np.array(r.vector) for r in dense(spark, rows).collect()}
    want = by_hand(rows)
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=2e-6) for i in got)
