r"""Ranked lexical search with the roles reversed: the items' terms are the index, the documents are streamed.

The items (queries) are few and short next to the documents. Their terms are compiled into an inverted index term ->
(item, repeats), which is broadcast. One pass over the documents counts in each the terms that some item holds and
writes them, with the numbers that need the whole corpus (documents, terms, document frequencies) as one more row a
task. A second pass streams the written counts through the index: a block of documents against all items, each item
keeping a heap of its best ``k``. The heaps of all tasks are merged by rank.

What is broadcast is bounded: items are dealt into blocks of at most ``BLOCK_POSTINGS`` (term, item) pairs; every block
is a pass of its own, so any number of items works. An item that exceeds the bound alone is a block alone.

Terms are maximal runs of ASCII letters, digits and non-ASCII characters; only A-Z are lower-cased. The weight of a
term is floor(1000 * ln((2N + 2) / (2 df + 1))), a document's score the sum over the item's terms of weight *
((10^9 tf) div (1000 tf + 12 m)), m = 75 + (25 n N) div L. Scores are exact 64-bit integers.

Defined cases: a NULL or empty text has no term; an item without terms, or whose terms no document holds, has no row;
rows that share an item id are one item (equal rows count once, the terms of different texts are taken together); each
document row is a document of its own, also where ids repeat; a NULL document id comes last among equal scores; empty
tables give an empty result; further columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from .common import ship_code, written

#: Fixed by the definition of a term: everything else in ASCII separates.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: (term, item) pairs of an index that is broadcast.
BLOCK_POSTINGS = 1 << 18
#: Bytes of text split at once, words counted at once, and cells of a score block.
PIECE, WORDS, CELLS = 1 << 22, 1 << 19, 1 << 21

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def _table() -> bytes:
    keep = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in keep else 0x20 for c in range(256))


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces that end at a separator."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        if end < len(text) and (cut := text.find(b" ", end)) >= 0:
            end = cut
        elif end < len(text):
            end = len(text)
        yield text[at:end]
        at = end


def item_postings(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, term, repeats, block."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    counted = written(rows.select("item_id", F.explode(terms(F.col("text"))).alias("term"))
                      .groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("repeats")), "item-terms")
    sizes = counted.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    blocks = 1
    while True:  # doubled until each block fits, or is one item
        block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
        over = sizes.groupBy(block.alias("b")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items")) \
            .where((F.col("n") > BLOCK_POSTINGS) & (F.col("items") > 1)).limit(1).count()
        if not over:
            return counted.withColumn("block", block)
        blocks *= 2


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Rows of documents (``doc`` true): doc_id, n (terms with repeats), the vocabulary's terms in it and their counts;
    and one row a task: n documents with a term, ``total`` of their terms, terms and the documents that hold them."""
    spark = docs.sparkSession
    ship_code(spark)
    known = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    kind = dict(rows.dtypes)["doc_id"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, get, v = _table(), known.value.get, len(known.value)
        df, n_docs, total, of = np.zeros(v, np.int64), 0, 0, None

        def out(doc: bool, ids, n, tot, offsets, found, tf) -> pa.RecordBatch:
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(a, pa.int32())) for a in (found, tf)]
            return pa.RecordBatch.from_arrays([pa.array([doc] * len(n), pa.bool_()), ids, pa.array(n, pa.int64()), pa.array(tot, pa.int64()), *lists],
                                              names=["doc", "doc_id", "n", "total", "terms", "counts"])

        for b in batches:
            of, texts, ids = b.column("doc_id").type, b.column("text"), b.column("doc_id")
            at = 0
            while at < len(texts):
                keys, n, first, held = [], [], at, 0
                while at < len(texts) and held < WORDS:
                    words = 0
                    for piece in _pieces(texts[at].as_py().encode().translate(table)):
                        w = piece.split()
                        words += len(w)
                        key = np.fromiter(map(get, w, repeat(-1)), np.int64, len(w))
                        key = key[key >= 0] + (at - first) * v
                        if len(w) > WORDS // 8:  # a long text is reduced piece by piece
                            key, c = np.unique(key, return_counts=True)
                            keys.append((key, c))
                        else:
                            keys.append((key, None))
                    n.append(words)
                    held += words
                    at += 1
                plain = [k for k, c in keys if c is None]
                key, c = np.unique(np.concatenate(plain), return_counts=True) if plain else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                if len(plain) < len(keys):
                    both = np.concatenate([key] + [k for k, c2 in keys if c2 is not None])
                    weight = np.concatenate([c] + [c2 for _, c2 in keys if c2 is not None])
                    key, inverse = np.unique(both, return_inverse=True)
                    c = np.bincount(inverse, weight, len(key)).astype(np.int64)
                n = np.array(n, np.int64)
                n_docs, total = n_docs + int((n > 0).sum()), total + int(n.sum())
                row, term = np.divmod(key, max(v, 1))
                df += np.bincount(term, minlength=v)
                hits, counts = np.unique(row, return_counts=True)
                if len(hits):
                    yield out(True, ids.slice(first, at - first).take(pa.array(hits)), n[hits], np.zeros(len(hits), np.int64),
                              np.concatenate([[0], np.cumsum(counts)]), term, c)
        if of is not None:
            seen = np.flatnonzero(df)
            yield out(False, pa.nulls(1, of), [n_docs], [total], [0, len(seen)], seen, df[seen])

    return rows.mapInArrow(count, f"doc boolean, doc_id {kind}, n bigint, total bigint, terms array<int>, counts array<int>")


class Index:
    """Inverted index of a block of items: posting lists by term, in arrays."""

    def __init__(self, rows: list):
        self.items = list({r.item_id: None for r in rows})
        number = {i: k for k, i in enumerate(self.items)}
        names = sorted({r.term for r in rows})
        self.vocabulary = {t.encode(): k for k, t in enumerate(names)}
        place = {t: k for k, t in enumerate(names)}
        term = np.array([place[r.term] for r in rows], np.int64)
        order = np.argsort(term, kind="stable")
        self.item = np.array([number[r.item_id] for r in rows], np.int64)[order]
        self.repeats = np.array([r.repeats for r in rows], np.int64)[order]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(names)))]).astype(np.int64)
        self.weight = np.zeros(len(names), np.int64)

    def weigh(self, n_docs: int, df: dict[int, int]) -> None:
        for t, n in df.items():
            self.weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))

    def scores(self, doc: np.ndarray, term: np.ndarray, part: np.ndarray, n_docs: int) -> np.ndarray:
        """documents x items, from rows (document, term, weighted share of the term)."""
        length = self.start[term + 1] - self.start[term]
        where = np.repeat(self.start[term] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        cell = np.repeat(doc, length) * len(self.items) + self.item[where]
        value = np.repeat(part, length) * self.repeats[where]
        size = n_docs * len(self.items)
        # Sums of doubles are exact below 2^53: both halves of a value are summed on their own.
        high = np.bincount(cell, value >> 26, size).astype(np.int64)
        low = np.bincount(cell, value & ((1 << 26) - 1), size).astype(np.int64)
        return ((high << 26) + low).reshape(n_docs, len(self.items))


class Heaps:
    """The best ``k`` (score, document) of every item."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.item, self.score, self.doc, self.none = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, scores: np.ndarray, docs: np.ndarray, none: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[row, item]])
        doc, none = np.concatenate([self.doc, docs[row]]), np.concatenate([self.none, none[row]])
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[place < self.k]
        self.item, self.score, self.doc, self.none = item[place < self.k], score[keep], doc[keep], none[keep]
        full = place == self.k - 1
        self.least[item[full]] = score[order[full]]


def best_documents(counted: DataFrame, index: Index, n_docs: int, total: int, k: int, item_type: DataType) -> DataFrame:
    """item_id, doc_id, score: the heaps of every task."""
    item_arrow = to_arrow_type(item_type)
    shared = counted.sparkSession.sparkContext.broadcast(index)
    kind = dict(counted.dtypes)["doc_id"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        heaps, of = Heaps(len(ix.items), k), None
        step = max(1, CELLS // len(ix.items))
        for b in batches:
            of = b.column("doc_id").type
            for at in range(0, len(b), step):
                part = b.slice(at, step)
                lists, ids = part.column("terms"), part.column("doc_id")
                length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                m = 100 - 25 + (25 * part.column("n").to_numpy(zero_copy_only=False).astype(np.int64) * n_docs) // total
                share = ix.weight[term] * ((1000000000 * tf) // (1000 * tf + 12 * np.repeat(m, length)))
                # Posting lists that are long in sum are worked off in runs of documents.
                cost = np.cumsum(np.add.reduceat(ix.start[term + 1] - ix.start[term], np.cumsum(length) - length))
                offset = np.concatenate([[0], np.cumsum(length)])
                doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                none = ids.is_null().to_numpy(zero_copy_only=False)
                lo = 0
                while lo < len(part):
                    hi = max(lo + 1, int(np.searchsorted(cost, (cost[lo - 1] if lo else 0) + 2 * CELLS, "right")))
                    cut = slice(offset[lo], offset[hi])
                    doc = np.repeat(np.arange(hi - lo), length[lo:hi])
                    heaps.add(ix.scores(doc, term[cut], share[cut], hi - lo), doc_id[lo:hi], none[lo:hi])
                    lo = hi
        if of is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([ix.items[i] for i in heaps.item]).cast(item_arrow) if len(heaps.item) else pa.nulls(0, item_arrow),
                 pa.array(heaps.doc, mask=heaps.none).cast(of), pa.array(heaps.score)], names=["item_id", "doc_id", "score"])

    return counted.select("doc_id", "n", "terms", "counts").mapInArrow(stream, f"item_id {item_type.simpleString()}, doc_id {kind}, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id_col: str = "doc_id", doc_text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` best documents by (score, smaller id)."""
    spark = docs.sparkSession
    postings = item_postings(items, item_id_col, item_text_col)
    item_type = postings.schema["item_id"].dataType
    kind = dict(docs.select(F.col(doc_id_col).alias("doc_id")).dtypes)["doc_id"]
    found = None
    for (block,) in sorted(postings.select("block").distinct().collect()):  # as many as there are passes
        index = Index(postings.where(F.col("block") == block).collect())  # bounded by BLOCK_POSTINGS
        counted = written(count_terms(docs, index.vocabulary, doc_id_col, doc_text_col), "term-counts")
        corpus = counted.where("not doc")
        n_docs, total = corpus.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
        df = corpus.select(F.explode(F.arrays_zip("terms", "counts")).alias("z")).groupBy("z.terms").agg(F.sum("z.counts").alias("df"))
        index.weigh(n_docs, {r.terms: r.df for r in df.collect()})  # a row a term of the block
        best = best_documents(counted.where("doc"), index, n_docs, total, k, item_type)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], f"item_id {item_type.simpleString()}, doc_id {kind}, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (written(found, "item-heaps").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
