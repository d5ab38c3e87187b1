"""Ranked text search over an index of documents, without scoring every pair.

The index of a corpus is written once in the shared checkpoint folder and used by all searches of an application
(``shared_index``): a row a document with its length, distinct terms in ascending order and their counts, and the
document frequency of every term. Spark makes the tokens, tasks count them in Arrow batches.

A search streams the index past the queries; nothing of the index is shuffled. Queries are dealt into blocks of at
most ``QUERY_POSTINGS`` (query, term) rows, which are broadcast; each block is a pass, so any number of queries works.
A task collects up to ``BLOCK_DOCS`` different documents at a time:

* documents whose weights for the queries' terms are equal are scored once (template texts, copies);
* weights are rounded up to whole multiples of a step that lets every query's sum fit 16 bits (32 where one query is far
  above the others); a common term is a row of them for all documents, a rare one a list. The rows and lists of a query's
  terms are added up, for some queries at once;
* each query keeps the score of its k-th best document so far. Documents whose sum cannot reach it, nor the k-th sum of
  the block less its rounding, are skipped. Only the pairs that are left are scored in full.

The result is that of scoring every pair: bounds are never below a score, ties of the k-th score are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import tokens, top_k
from ..session import scratch_path, shared, ship_code, written

BM25_K1, BM25_B = 1.2, 0.75
#: (query, term) and (query, group) rows that are broadcast at once.
QUERY_POSTINGS = 1 << 20
#: Different documents, and (document, term) rows, of a block about; into so many rows its places are folded to find the
#: best; queries whose sums are taken together.
BLOCK_DOCS, BLOCK_POSTINGS, NODE, QUERY_STEP = 1 << 14, 1 << 22, 16, 32
#: A term is common in a block where more than one document in this many holds it; pairs completed at once.
COMMON, PAIRS = 32, 1 << 17
#: Terms whose document frequencies are broadcast at most, the most frequent ones.
COMMON_TERMS = 1 << 18
#: Tokens that a task counts at once, about.
TOKENS = 1 << 21
#: Scores are compared at six decimals.
DECIMALS, SLACK = 6, 1e-6


# ------------------------------------------------------------------ the index
@dataclass
class TextIndex:
    """``docs``: doc_id, dl, terms, counts[, norm][, group]; ``df``: term, df; ``n`` documents with a term."""
    docs: DataFrame
    df: DataFrame
    n: int
    avgdl: float

    def frequent(self, at_most: int) -> int:
        """The least power of two that at most ``at_most`` terms have as their document frequency or more."""
        sizes = self.df.groupBy(F.length(F.bin("df")).alias("bits")).agg(F.count(F.lit(1)).alias("terms"))
        cut, total = 1 << 62, 0
        for bits, terms in sorted(sizes.collect(), reverse=True):  # a row a power of two
            total += terms
            if total > at_most:
                break
            cut = 1 << (bits - 1)
        else:
            cut = 1
        return cut

    def entries(self, *columns: str) -> DataFrame:
        """The (document, term) rows: ``columns`` of the document, term, tf and the term's df.

        The frequencies of the most frequent terms, which make up most rows, are broadcast; only the rows of the other
        terms are shuffled to theirs. Each of these is in few documents, so no term is a hot key."""
        each = self.docs.select(*columns, F.explode(F.arrays_zip("terms", "counts")).alias("z")) \
            .select(*columns, F.col("z.terms").alias("term"), F.col("z.counts").alias("tf"))
        cut = self.frequent(COMMON_TERMS)
        common = F.broadcast(self.df.where(F.col("df") >= cut))
        found = each.join(common, "term")
        if cut == 1:
            return found
        rare = each.join(common.select("term"), "term", "left_anti").join(self.df.where(F.col("df") < cut), "term")
        return found.unionByName(rare)


def _slices(batches: Iterator[pa.RecordBatch], column: str, at_most: int) -> Iterator[pa.RecordBatch]:
    """Whole rows, of about ``at_most`` entries of a list column."""
    for b in batches:
        size = np.cumsum(pc.list_value_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(b):
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + at_most, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def _count_terms(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row a document from its rows of tokens, which are neighbours: length, distinct terms in ascending order, counts."""
    keys = [c for c in ("doc_id", "group") if c in schema.names]

    def counted(t: pa.Table) -> pa.RecordBatch:
        tokens, of = t["_tk"].combine_chunks(), starts(t)
        size = pc.list_value_length(tokens).fill_null(0).to_numpy(zero_copy_only=False)
        doc = np.cumsum(np.isin(np.arange(len(t)), of)) - 1
        words = tokens.flatten().dictionary_encode()
        order = pc.sort_indices(words.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        bits = np.int64(max(1, len(order).bit_length()))
        key = np.sort((np.repeat(doc, size) << bits) | rank[words.indices.to_numpy()])
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        held = np.bincount(key[first] >> bits, minlength=len(of))
        some = np.flatnonzero(held)  # a document without a token has no row
        offsets = pa.array(np.r_[0, np.cumsum(held[some])].astype(np.int32))
        columns = {c: t[c].combine_chunks().take(pa.array(of[some])) for c in keys}
        columns["dl"] = pa.array(np.bincount(doc, size, len(of)).astype(np.int64)[some])
        columns["terms"] = pa.ListArray.from_arrays(offsets, words.dictionary.take(pa.array(order[key[first] & ((np.int64(1) << bits) - 1)])))
        columns["counts"] = pa.ListArray.from_arrays(offsets, pa.array(np.diff(np.r_[first, len(key)]).astype(np.int32)))
        return pa.RecordBatch.from_arrays([columns[c].cast(schema.field(c).type) for c in schema.names], schema=schema)

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(len(t), bool)
        new[:1] = True
        for c in keys:
            code = t[c].combine_chunks().dictionary_encode("encode").indices.to_numpy()
            new[1:] |= code[1:] != code[:-1]
        return np.flatnonzero(new)

    held = None
    for b in _slices(batches, "_tk", TOKENS):
        t = pa.Table.from_batches([b] if held is None else [*held.to_batches(), b])
        last = int(starts(t)[-1])  # its rows may go on
        if last:
            yield counted(t.slice(0, last))
        held = t.slice(last)
    if held is not None:
        yield counted(held)


def indexed(docs: DataFrame, id_col: str, text_col: str, group_col: str | None = None) -> DataFrame:
    """(doc_id, dl[, group], terms, counts) over whole texts.

    Documents are hash-partitioned by doc_id (one shuffle of the raw text), so tokenising runs in parallel, and sorted by
    it there, so the rows of a repeated id are one document. Tokens are made by Spark and counted by task.
    """
    spark = docs.sparkSession
    ship_code(spark)
    # An explicit count: little of an index in bytes is much work, so partitions must not be merged by their bytes.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    extra = ["group"] if group_col else []
    cols = [F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")] + ([F.col(group_col).alias("group")] if group_col else [])
    d = docs.where(F.col(id_col).isNotNull()).select(*cols).repartition(n, "doc_id").sortWithinPartitions("doc_id", *extra) \
        .select("doc_id", *extra, tokens(F.col("_text")).alias("_tk"))
    out = T.StructType([d.schema["doc_id"], T.StructField("dl", T.LongType()), *[d.schema[c] for c in extra],
                        T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])
    schema = to_arrow_schema(out)
    return d.mapInArrow(lambda batches: _count_terms(batches, schema), out)


def doc_freq(docs: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pc.value_counts(b.column("terms").flatten())
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["term", "df"])

    return docs.select("terms").mapInArrow(count, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _norms(index: TextIndex) -> DataFrame:
    """doc_id, norm. The frequencies of the most frequent terms are broadcast and their shares summed by document; only
    the rows of the other terms are shuffled to theirs."""
    spark, cut = index.docs.sparkSession, index.frequent(COMMON_TERMS)
    common = index.df.where(F.col("df") >= cut).select("term", smooth_idf(index.n, F.col("df")).alias("idf")).toArrow()  # at most ``COMMON_TERMS``
    shared = spark.sparkContext.broadcast((common["term"].combine_chunks(), common["idf"].to_numpy()))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = shared.value
        for b in _slices(batches, "terms", TOKENS):
            lists = b.column("terms")
            row, flat = np.repeat(np.arange(len(b)), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten()
            tf = b.column("counts").flatten().to_numpy(zero_copy_only=False)
            place = pc.index_in(flat, terms)
            known = place.is_valid().to_numpy(zero_copy_only=False)
            w = tf[known] * idf[place.drop_null().to_numpy()]
            ids, rare = b.column("doc_id"), pa.array(np.flatnonzero(~known))
            none = pa.nulls(len(b), pa.string())
            yield pa.RecordBatch.from_arrays([ids, none, pa.array(np.bincount(row[known], w * w, len(b)).astype(float))], names=["doc_id", "term", "x"])
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(row[~known])), flat.take(rare).cast(pa.string()), pa.array(tf[~known].astype(np.float64))], names=["doc_id", "term", "x"])

    kind = index.docs.schema["doc_id"].dataType.simpleString()
    parts = written(index.docs.select("doc_id", "terms", "counts").mapInArrow(shares, f"doc_id {kind}, term string, x double"), "norm_parts")
    w = F.col("x") * smooth_idf(index.n, F.col("df"))
    rare = parts.where("term IS NOT NULL").join(index.df.where(F.col("df") < cut), "term").select("doc_id", (w * w).alias("x"))
    whole = parts.where("term IS NULL").select("doc_id", "x").unionByName(rare)
    return written(whole.groupBy("doc_id").agg(F.sqrt(F.sum("x")).alias("norm")), "norms")


def smooth_idf(n, df):
    return F.log((F.lit(1.0) + n) / (df + 1.0)) + 1.0


def build_index(docs: DataFrame, id_col: str, text_col: str, group_col: str | None = None, with_norm: bool = False) -> TextIndex:
    """Write the index of ``docs``. ``with_norm`` adds each document's TF-IDF norm: besides a row a document, the rows of
    rare terms are shuffled."""
    spark = docs.sparkSession
    path = scratch_path(spark, "text_index")
    rows = indexed(docs, id_col, text_col, group_col)
    rows.write.parquet(f"{path}/docs")
    found = spark.read.schema(rows.schema).parquet(f"{path}/docs")
    df = doc_freq(found)
    df.write.parquet(f"{path}/df")
    df = spark.read.schema(df.schema).parquet(f"{path}/df")
    n, avgdl = found.agg(F.count(F.lit(1)), F.avg("dl")).first()
    if with_norm:
        full = found.join(_norms(TextIndex(found, df, n, avgdl)), "doc_id")
        full.write.parquet(f"{path}/docs-norm")
        found = spark.read.schema(full.schema).parquet(f"{path}/docs-norm")
    return TextIndex(found, df, n, avgdl or 1.0)


def shared_index(docs: DataFrame, id_col: str, text_col: str, group_col: str | None = None, with_norm: bool = False, name: str = "") -> TextIndex:
    """The index of a corpus, built once an application; ``name`` says how ``docs`` comes from its files."""
    return shared(docs, ("text", name, id_col, text_col, group_col, with_norm), lambda: build_index(docs, id_col, text_col, group_col, with_norm))


# ------------------------------------------------------------------ inside a task
def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, place) for all places of the ranges [lo, hi)."""
    length = hi - lo
    which = np.repeat(np.arange(len(lo)), length)
    return which, np.arange(len(which)) + np.repeat(lo - (np.cumsum(length) - length), length)


class QueryBlock:
    """A bounded set of queries: rows (query, term, weight) by query, and for every group the queries that may see it.
    A weight is at most ``unit`` (of the term) x ``times`` (a whole number) x ``scale`` (of the query)."""

    def __init__(self, terms: pa.Table, groups: pa.Table | None, k: int):
        self.ids = pc.unique(terms["query_id"].combine_chunks())
        self.vocabulary = pc.unique(terms["term"].combine_chunks()).sort()
        who = pc.index_in(terms["query_id"].combine_chunks(), self.ids).to_numpy(zero_copy_only=False).astype(np.int64)
        term = pc.index_in(terms["term"].combine_chunks(), self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.lexsort((term, who))
        self.who, self.term, self.weight = who[order], term[order], terms["qw"].to_numpy()[order].astype(np.float64)
        self.start = np.searchsorted(self.who, np.arange(len(self.ids) + 1))
        self.unit = np.zeros(len(self.vocabulary))
        self.unit[term] = terms["unit"].to_numpy()
        share = self.weight / self.unit[self.term]
        self.scale = np.minimum.reduceat(share, self.start[:-1])
        self.times = np.ceil(share / self.scale[self.who] - 1e-9).astype(np.int64)
        #: The least part of what they are at most that a query's weights are.
        self.part = np.minimum.reduceat(share / (self.scale[self.who] * self.times), self.start[:-1])
        self.steps = np.add.reduceat(self.times, self.start[:-1])
        self.k = k
        self.groups = self.seeing = None
        if groups is not None:
            self.groups = pc.drop_null(pc.unique(groups["group"].combine_chunks()))
            g = pc.index_in(groups["group"].combine_chunks(), self.groups)
            q = pc.index_in(groups["query_id"].combine_chunks(), self.ids)
            both = pc.and_(g.is_valid(), q.is_valid()).to_numpy(zero_copy_only=False)
            g = g.fill_null(0).to_numpy(zero_copy_only=False)[both].astype(np.int64)
            q = q.fill_null(0).to_numpy(zero_copy_only=False)[both].astype(np.int64)
            order = np.lexsort((q, g))
            self.seeing = np.split(q[order], np.searchsorted(g[order], np.arange(1, len(self.groups))))


class Heaps:
    """The best k (score, document) of each query, by (rounded score, smaller id): a row a query, empty places score
    minus infinity. Offers cost by their own number and that of the queries they are for, not by all queries."""

    def __init__(self, n: int, k: int, id_type: np.dtype):
        self.k, self.least = k, np.full(n, -np.inf)
        self.score, self.doc = np.full((n, k), -np.inf), np.zeros((n, k), id_type)

    def add(self, who: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        """Offer documents; ``who`` ascends."""
        if not len(who):
            return
        self.doc = self.doc.astype(np.promote_types(self.doc.dtype, doc.dtype), copy=False)  # ids may be longer strings
        seen = who[np.flatnonzero(np.r_[True, who[1:] != who[:-1]])]
        who = np.concatenate([np.repeat(seen, self.k), who])
        score, doc = np.concatenate([self.score[seen].ravel(), score]), np.concatenate([self.doc[seen].ravel(), doc])
        order = np.lexsort((doc, -np.round(score, DECIMALS), who))
        first = order[np.searchsorted(who[order], seen)[:, None] + np.arange(self.k)]
        self.score[seen], self.doc[seen] = score[first], doc[first]
        self.least[seen] = np.round(score[first[:, -1]], DECIMALS)

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, document, score) of all that were kept."""
        who, place = np.nonzero(np.isfinite(self.score))
        return who, self.doc[who, place], self.score[who, place]


class Classes:
    """Documents that wait for their search: those with equal rows are one class, of which the ``k`` least ids count."""

    def __init__(self, k: int):
        self.k, self.postings = k, 0
        self.number: dict[bytes, int] = {}
        self.term, self.weight, self.members = [], [], []

    def add(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, ids: np.ndarray) -> None:
        """Rows by document, a document's in the order of the index."""
        start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        for a, b, d in zip(start.tolist(), [*start[1:].tolist(), len(doc)], ids[doc[start]].tolist()):
            key = term[a:b].tobytes() + weight[a:b].tobytes()
            n = self.number.setdefault(key, len(self.members))
            if n == len(self.members):
                self.members.append([d])
                self.term.append(term[a:b])
                self.weight.append(weight[a:b])
                self.postings += b - a
            else:
                m = self.members[n]
                m.append(d)
                if len(m) > 4 * self.k:
                    self.members[n] = sorted(m)[:self.k]


class DocBlock:
    """Some classes of documents, each at a place. For bounds, weights are whole multiples of ``delta``, rounded up: a
    row of all places for a common term, a list of its places for a rare one."""

    def __init__(self, found: Classes, q: QueryBlock):
        size = np.array([len(t) for t in found.term])
        self.members = [sorted(m)[:q.k] if len(m) > 1 else m for m in found.members]
        self.places = -(-len(size) // NODE) * NODE
        self.n_terms = n_terms = len(q.vocabulary)
        t, p, w = np.concatenate(found.term), np.repeat(np.arange(len(size)), size), np.concatenate(found.weight)
        # Exact weights by place and term; a document's terms ascend, as index and vocabulary are sorted.
        self.key, self.exact = p * n_terms + t, w
        # Sorting term and row as one number is faster than an order of the terms.
        bits = np.int64(max(1, int(len(t)).bit_length()))
        order = np.sort(t << bits | np.arange(len(t))) & ((np.int64(1) << bits) - 1)
        t, p = t[order], p[order]
        w = w[order] * q.unit[t]
        self.term_start = np.searchsorted(t, np.arange(n_terms + 1))
        df = np.diff(self.term_start)
        held = np.flatnonzero(df)
        most = np.zeros(n_terms)
        most[held] = np.maximum.reduceat(w, self.term_start[held])
        # No query's sum may leave its type; where one query is far above the others, a wider type keeps steps small.
        top = np.bincount(q.who, q.times * most[q.term], len(q.ids))
        wide = q.steps.max() > 1 << 14 or top.max() > 16 * np.median(top[top > 0])
        self.kind = np.uint32 if wide else np.uint16
        self.delta = max(float((top / (np.iinfo(self.kind).max - q.steps)).max()), 1e-300) * (1 + 1e-9)
        #: The largest number of each term, and the number of a common term, -1 for a rare one.
        self.most = np.ceil(most / self.delta)
        self.place, self.number = p, np.ceil(w / self.delta).astype(self.kind)
        self.common = np.full(n_terms, -1)
        many = np.flatnonzero(df > len(size) / COMMON)
        self.common[many] = np.arange(len(many))
        c = self.common[t]
        often = c >= 0
        self.table = np.zeros((len(many), self.places), self.kind)
        self.table[c[often], p[often]] = self.number[often]

    def search(self, q: QueryBlock, heaps: Heaps, asking: np.ndarray) -> int:
        """Offer every document that can be among the best of a query of ``asking`` (ascending); how many (query,
        document) pairs were scored."""
        scored = 0
        for lo in range(0, len(asking), QUERY_STEP):
            ids = asking[lo:lo + QUERY_STEP]
            who, at = _spread(q.start[ids], q.start[ids + 1])
            term, times = q.term[at], q.times[at]
            most = self.most[term]
            step = self.delta * q.scale[ids]
            # Whole numbers a sum must reach for the k-th score so far; 1 where there is none yet.
            reach = np.maximum(np.floor((heaps.least[ids] - SLACK) / step * (1 - 1e-9)), 1)
            live = np.bincount(who, times * most, len(ids)) >= reach  # other queries have no document to find here
            if not live.any():
                continue
            held = live[who] & (most > 0)
            who, term, times = (np.cumsum(live) - 1)[who[held]], term[held], times[held]
            ids, step, reach = ids[live], step[live], reach[live]
            sums = self._sums(len(ids), who, term, times).reshape(len(ids), NODE, -1)
            peak = sums.max(axis=1)
            reach = reach.astype(self.kind)
            can = peak >= reach[:, None]
            many = np.flatnonzero(np.count_nonzero(can, axis=1) >= q.k)
            if len(many):  # the k-th of these sums, less what was rounded up, is a score of this block or below
                kth = np.partition(peak[many], -q.k, axis=1)[:, -q.k].astype(float)
                least = np.floor((kth - q.steps[ids[many]]) * q.part[ids[many]] * (1 - 1e-9) - SLACK / step[many])
                reach[many] = np.maximum(least, reach[many]).astype(self.kind)
                can[many] = peak[many] >= reach[many, None]
            i, j = np.nonzero(can)
            h, node = np.nonzero(sums[i, :, j] >= reach[i][:, None])
            scored += len(h)
            for a in range(0, len(h), PAIRS):
                self._offer(q, ids[i[h[a:a + PAIRS]]], node[a:a + PAIRS] * peak.shape[1] + j[h[a:a + PAIRS]], heaps)
        return scored

    def _sums(self, n: int, who: np.ndarray, term: np.ndarray, times: np.ndarray) -> np.ndarray:
        """For each query and place a sum of whole numbers that is at least the score."""
        sums = np.zeros((n, self.places), self.kind)
        common = self.common[term]
        often = np.flatnonzero(common >= 0)
        often = often[np.argsort(common[often], kind="stable")]  # a term's row is used while it is in the cache
        rows, table = list(sums), list(self.table)
        for i, c, m in zip(who[often].tolist(), common[often].tolist(), times[often].tolist()):
            np.add(rows[i], table[c] if m == 1 else table[c] * self.kind(m), out=rows[i])
        few = np.flatnonzero(common < 0)
        if len(few):
            begin, end = self.term_start[term[few]], self.term_start[term[few] + 1]
            place, number = (np.concatenate([x[a:b] for a, b in zip(begin.tolist(), end.tolist())]) for x in (self.place, self.number))
            place += np.repeat(who[few] * self.places, end - begin)
            if (times[few] != 1).any():
                number *= np.repeat(times[few].astype(self.kind), end - begin)
            np.add.at(sums.reshape(-1), place, number)
        return sums

    def _offer(self, q: QueryBlock, who: np.ndarray, where: np.ndarray, heaps: Heaps) -> None:
        """Score the documents at ``where`` for the queries ``who`` (ascending)."""
        pair, at = _spread(q.start[who], q.start[who + 1])
        key = where[pair] * self.n_terms + q.term[at]
        row = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        score = np.bincount(pair, np.where(self.key[row] == key, q.weight[at] * self.exact[row], 0.0), len(who))
        good = np.flatnonzero((score > 0) & (np.round(score, DECIMALS) >= heaps.least[who]))
        if len(good):
            members = [self.members[x] for x in where[good].tolist()]
            size = [len(m) for m in members]
            heaps.add(np.repeat(who[good], size), np.repeat(score[good], size), np.array([d for m in members for d in m]))


# ------------------------------------------------------------------ over the cluster
#: (batch, counts, term numbers, row of each) -> weight of each (document, term), given what the search was asked for.
Weigher = Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _stream(docs: DataFrame, block: QueryBlock, weigh: Weigher, query_kind: str, grouped: bool, counters) -> DataFrame:
    """query_id, doc_id, score: each task's best documents of every query of the block."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(block)
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, heaps, of, pairs, scored, waiting = shared.value, None, None, 0, 0, {}

        def search(found: dict) -> int:
            return sum(DocBlock(c, q).search(q, heaps, np.arange(len(q.ids)) if g is None else q.seeing[g]) for g, c in found.items() if c.members)

        for b in batches:
            of = b.column("doc_id").type
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            ids = ids.astype(str) if ids.dtype == object else ids
            if heaps is None:
                heaps = Heaps(len(q.ids), q.k, ids.dtype)
            size = np.cumsum(b.column("terms").value_lengths().to_numpy(zero_copy_only=False))
            at = end = 0
            while end < len(b):
                at, held = end, size[end - 1] if end else 0
                end = max(at + 1, min(at + BLOCK_DOCS, int(np.searchsorted(size, held + BLOCK_POSTINGS, "right"))))
                part = b.slice(at, end - at)
                lists = part.column("terms")
                row = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy(zero_copy_only=False))
                term = pc.index_in(lists.flatten(), q.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                counts = part.column("counts").flatten().to_numpy(zero_copy_only=False)
                pairs += len(part) * len(q.ids)
                known = term >= 0
                if grouped:
                    group = pc.index_in(part.column("group"), q.groups).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[row]
                    known &= group >= 0
                    group = group[known]
                row, term, counts = row[known], term[known], counts[known]
                weight = weigh(part, counts, term, row)
                if not grouped:
                    waiting.setdefault(None, Classes(q.k)).add(row, term, weight, ids[at:end])
                else:  # a group's documents meet the queries that may see it
                    order = np.argsort(group, kind="stable")
                    cuts = np.searchsorted(group[order], np.arange(len(q.groups) + 1)).tolist()
                    for g, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        if x < y:
                            mine = order[x:y]
                            waiting.setdefault(g, Classes(q.k)).add(row[mine], term[mine], weight[mine], ids[at:end])
                held_rows = sum(c.postings for c in waiting.values())
                if held_rows >= BLOCK_POSTINGS or sum(len(c.members) for c in waiting.values()) >= BLOCK_DOCS:
                    scored += search(waiting)
                    waiting = {}
        scored += search(waiting)
        if counters:
            counters[0].add(scored)
            counters[1].add(pairs)
        if heaps is not None:
            who, doc, score = heaps.best()
            yield pa.RecordBatch.from_arrays([q.ids.take(pa.array(who)), pa.array(doc).cast(of), pa.array(score)], names=["query_id", "doc_id", "score"])

    return docs.mapInArrow(run, f"query_id {query_kind}, doc_id {kinds['doc_id']}, score double")


def _blocks(q_terms: DataFrame, q_groups: DataFrame | None) -> int:
    """Into how many blocks queries are dealt by id to keep each within ``QUERY_POSTINGS`` rows (or at one query)."""
    rows = q_terms.select("query_id")
    if q_groups is not None:
        rows = rows.unionByName(q_groups.select("query_id"))
    sizes = rows.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    blocks = 1
    while sizes.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("b")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("q")) \
            .where((F.col("n") > QUERY_POSTINGS) & (F.col("q") > 1)).limit(1).count():
        blocks *= 2
    return blocks


def best_documents(index: TextIndex, q_terms: DataFrame, weigher: Callable[[QueryBlock, pa.Table], Weigher], k: int,
                   q_groups: DataFrame | None = None, counters=None) -> DataFrame:
    """query_id, doc_id, score, rank: the ``k`` best documents of each query by (score at six decimals, smaller id).
    ``q_terms``: query_id, term, qw[, more columns of a term]; ``counters`` are two accumulators: scored and all pairs."""
    spark = q_terms.sparkSession
    q_terms = written(q_terms, "queries")
    n_blocks, kind = _blocks(q_terms, q_groups), q_terms.schema["query_id"].dataType.simpleString()
    found = None
    for b in range(n_blocks):
        mine = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == b
        terms = q_terms.where(mine).toArrow()  # at most QUERY_POSTINGS rows
        if not terms.num_rows:
            continue
        groups = q_groups.where(mine).distinct().toArrow() if q_groups is not None else None
        block = QueryBlock(terms, groups, k)
        part = _stream(index.docs, block, weigher(block, terms), kind, q_groups is not None, counters)
        found = part if found is None else found.unionByName(part)
    if found is None:
        ids = index.docs.schema["doc_id"].dataType.simpleString()
        found = spark.createDataFrame([], f"query_id {kind}, doc_id {ids}, score double")
    s = found.select("query_id", "doc_id", F.round("score", DECIMALS).alias("score"))
    return top_k(s, ["query_id"], [F.col("score").desc(), F.col("doc_id")], k)


def query_terms(queries: DataFrame, qid_col: str, text_col: str) -> DataFrame:
    return queries.select(F.col(qid_col).alias("query_id"), F.explode(F.array_distinct(tokens(F.col(text_col)))).alias("term"))


def bm25_search(index: TextIndex, queries: DataFrame, qid_col: str, text_col: str, k: int,
                q_groups: DataFrame | None = None, counters=None) -> DataFrame:
    """BM25 (k1 1.2, b 0.75), idf = ln(1 + (N - df + 0.5) / (df + 0.5)), over the distinct terms of a query."""
    idf = F.log(F.lit(1.0) + (F.lit(index.n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    qt = query_terms(queries, qid_col, text_col).join(index.df, "term").select("query_id", "term", idf.alias("qw"), idf.alias("unit"))
    avgdl = index.avgdl

    def weigher(block: QueryBlock, _) -> Weigher:
        def weigh(part, counts, term, row):
            norm = BM25_K1 * ((1.0 - BM25_B) + BM25_B * part.column("dl").to_numpy(zero_copy_only=False) / avgdl)
            return counts * (BM25_K1 + 1) / (counts + norm[row])
        return weigh

    return best_documents(index, qt, weigher, k, q_groups, counters)


def cosine_search(index: TextIndex, queries: DataFrame, qid_col: str, text_col: str, k: int, counters=None) -> DataFrame:
    """TF-IDF cosine with smooth idf = ln((1 + N) / (1 + df)) + 1; the index needs norms."""
    tf = queries.select(F.col(qid_col).alias("query_id"), F.explode(tokens(F.col(text_col))).alias("term")) \
        .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    idf = smooth_idf(index.n, F.coalesce("df", F.lit(0)))
    w = tf.join(index.df, "term", "left").select("query_id", "term", "df", idf.alias("idf"), (F.col("tf") * idf).alias("w"))
    norm = w.groupBy("query_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("qnorm"))
    qt = w.where(F.col("df").isNotNull()).join(norm, "query_id").select("query_id", "term", (F.col("w") / F.col("qnorm")).alias("qw"), F.col("idf").alias("unit"))

    def weigher(block: QueryBlock, terms: pa.Table) -> Weigher:
        def weigh(part, counts, term, row):
            return counts * block.unit[term] / part.column("norm").to_numpy(zero_copy_only=False)[row]
        return weigh

    return best_documents(index, qt, weigher, k, None, counters)
