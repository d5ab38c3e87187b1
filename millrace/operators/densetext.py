"""Dense text vectors (D01) by random indexing over the index of a corpus.

Every document has fixed random signs (the digits of the SHA-256 of its id). A term's vector is the unit vector of the
signs of its documents, weighted by TF-IDF; a document's vector is that of its terms' vectors, weighted again: one step
of a power iteration on the document-term matrix. Terms that occur in the same documents are close, so texts without a
shared word can meet, with a noise of about 1 / sqrt(dimensions) a pair.

What moves, for a corpus of any size:

* Term vectors: a task sums ``CHUNK`` (document, term) rows at a time, so a row a chunk and distinct term is shuffled by
  term, where sorted rows are summed as they stream. A term of all documents is a row a chunk, never a group in memory.
  A factor that is the same for a whole term cancels in its unit vector, so document frequencies are not read here.
* A term of fewer than ``PACKED`` documents travels as the signs and shares of these documents, two numbers each and not
  ``DIMS``, and is summed where it is used; most terms of a corpus are such.
* Document vectors: documents are dealt by their id into groups of ``CHUNK`` to ``GROUP`` (document, term) rows. A group
  asks once for each of its distinct terms, so a term's vector is shuffled once a group and not once a document; the
  group and its vectors meet in one task. The ``HOT`` most frequent terms, which every group would ask for, are broadcast
  (at most 17 MB); nothing else passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_code, written
from . import textsearch as TS

#: Dimensions: a hexadecimal digit of a SHA-256 gives the sign of each.
DIMS = 64
#: (document, term) rows that a task sums together and rows expanded to all dimensions at once.
CHUNK, STEP = 1 << 18, 1 << 15
#: (document, term) rows of a group of documents at most, about, where there are groups enough for all tasks.
GROUP = 1 << 20
#: From this many documents on a vector is smaller than the signs and shares of the documents; terms that are broadcast.
PACKED, HOT = 32, 1 << 15
#: Components are given at this many decimals.
DECIMALS = 6

_TERM_VECTORS = pa.schema([("term", pa.string()), ("v", pa.list_(pa.float64()))])
#: A term has either a sum ``v`` or the signs and shares to be summed; the other lists are empty.
_PARTS = pa.schema([*_TERM_VECTORS, ("signs", pa.list_(pa.int64())), ("shares", pa.list_(pa.float64()))])
_PARTS_DDL = "term string, v array<double>, signs array<bigint>, shares array<double>"


def _lists(m: np.ndarray) -> pa.Array:
    """The rows of a matrix as list<double>."""
    return pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * DIMS, m.ravel())


def _matrix(column: pa.Array) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, DIMS)


def _flat(column) -> pa.Array:
    flat = pc.list_flatten(column)
    return flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat


def _signs(packed: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of 64-bit integers, the highest first."""
    bits = (packed.view(np.uint64)[:, None] >> np.arange(DIMS - 1, -1, -1, dtype=np.uint64)) & np.uint64(1)
    return bits.astype(np.float64) * 2 - 1


def _sums(which: np.ndarray, n: int, rows) -> np.ndarray:
    """Sums of ``rows(lo, hi)`` by the ascending numbers ``which``, ``STEP`` rows at a time."""
    out = np.zeros((n, DIMS))
    for lo in range(0, len(which), STEP):
        hi = min(lo + STEP, len(which))
        starts = np.flatnonzero(np.r_[True, which[lo + 1:hi] != which[lo:hi - 1]])
        out[which[lo:hi][starts]] += np.add.reduceat(rows(lo, hi), starts, axis=0)
    return out


def _ragged(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    """Lists of these lengths."""
    return pa.ListArray.from_arrays(np.r_[0, np.cumsum(lengths)].astype(np.int32), values)


def _grouped(terms: pa.Array, whole: np.ndarray, v: np.ndarray, which: np.ndarray, signs: np.ndarray, shares: np.ndarray) -> pa.RecordBatch:
    """A row a term: ``v`` are sums of the terms numbered ``whole``, signs and shares those of ``which``, both ascending.
    A term stays packed while it has no sum and fewer than ``PACKED`` entries."""
    n = np.bincount(which, minlength=len(terms))
    dense = n >= PACKED
    dense[whole] = True
    row, loose = np.cumsum(dense) - 1, dense[which]
    at, packed_signs, packed_shares = row[which[loose]], signs[loose], shares[loose]
    sums = _sums(row[whole], dense.sum(), lambda lo, hi: v[lo:hi])
    sums += _sums(at, dense.sum(), lambda lo, hi: packed_shares[lo:hi, None] * _signs(packed_signs[lo:hi]))
    left = np.where(dense, 0, n)
    return pa.record_batch([terms, _ragged(dense * DIMS, sums.ravel()), _ragged(left, signs[~loose]), _ragged(left, shares[~loose])], schema=_PARTS)


def _unpacked(parts) -> np.ndarray:
    """The sums of all rows."""
    n = pc.list_value_length(parts["signs"]).to_numpy()
    signs, shares = _flat(parts["signs"]).to_numpy(), _flat(parts["shares"]).to_numpy()
    sums = _sums(np.repeat(np.arange(len(n)), n), len(n), lambda lo, hi: shares[lo:hi, None] * _signs(signs[lo:hi]))
    sums[pc.list_value_length(parts["v"]).to_numpy() > 0] += _matrix(parts["v"])
    return sums


def _chunk_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial term vectors, a row a chunk and distinct term: the sum of tf / norm * signs, or the packed entries."""
    def summed(chunk: list) -> pa.RecordBatch:
        t = pa.Table.from_batches(chunk)
        terms = _flat(t["terms"]).dictionary_encode()
        codes = terms.indices.to_numpy()
        doc = np.repeat(np.arange(len(t)), pc.list_value_length(t["terms"]).to_numpy())
        order = np.argsort(codes, kind="stable")
        codes, doc = codes[order], doc[order]
        share = _flat(t["counts"]).to_numpy()[order] / t["norm"].to_numpy()[doc]
        none = np.zeros(0, np.int64)
        return _grouped(terms.dictionary, none, np.zeros((0, DIMS)), codes, t["signs"].to_numpy()[doc], share)

    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < batch.num_rows:  # whole documents, so a chunk may end with one long text
            before = ends[lo - 1] if lo else 0
            hi = min(int(np.searchsorted(ends, before + CHUNK - size)) + 1, batch.num_rows)
            held.append(batch.slice(lo, hi - lo))
            size, lo = size + int(ends[hi - 1] - before), hi
            if size >= CHUNK:
                yield summed(held)
                held, size = [], 0
    if size:
        yield summed(held)


def _units(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and the rows that have a direction."""
    norm = np.sqrt((sums * sums).sum(axis=1))
    rows = np.flatnonzero(norm > 0)
    return sums[rows] / norm[rows, None], rows


def _merge_terms(batches: Iterator[pa.RecordBatch], packed: bool = False) -> Iterator[pa.RecordBatch]:
    """Unit vectors of the sums of partial vectors that come sorted by term; the last term of a batch stays open.
    ``packed`` leaves the terms packed that have few documents."""
    def closed(parts: pa.RecordBatch) -> pa.RecordBatch:
        if not packed:
            unit, rows = _units(_unpacked(parts))
            return pa.record_batch([parts.column("term").take(pa.array(rows)), _lists(unit)], schema=_TERM_VECTORS)
        dense = pc.list_value_length(parts.column("v")).to_numpy(zero_copy_only=False) > 0
        unit, rows = _units(_matrix(parts.column("v")))
        has = dense.copy()
        has[np.flatnonzero(dense)] = np.isin(np.arange(dense.sum()), rows)
        parts = pa.record_batch([parts.column("term"), _ragged(has * DIMS, unit.ravel()), parts.column("signs"), parts.column("shares")], schema=_PARTS)
        return parts.filter(pa.array(has | ~dense))

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch.cast(_PARTS)] if held is None else [held, batch.cast(_PARTS)]).combine_chunks()
        runs = pc.run_end_encode(t["term"].combine_chunks())
        which = np.repeat(np.arange(len(runs.values)), np.diff(np.r_[0, runs.run_ends.to_numpy()]))
        n = pc.list_value_length(t["signs"]).to_numpy()
        whole = which[pc.list_value_length(t["v"]).to_numpy() > 0]
        merged = _grouped(runs.values, whole, _matrix(t["v"]), np.repeat(which, n), _flat(t["signs"]).to_numpy(), _flat(t["shares"]).to_numpy())
        if merged.num_rows > 1:
            yield closed(merged.slice(0, merged.num_rows - 1))
        held = merged.slice(merged.num_rows - 1)
    if held is not None:
        yield closed(held)


def _documents(docs: pa.Table, vectors: pa.Table, hot: tuple | None = None) -> pa.Table:
    """The vectors of a group's documents from those of its terms; a text whose terms cancel out has none. ``hot``:
    terms that every group meets, and their weighted vectors."""
    asked = _flat(docs["terms"])
    place = pc.index_in(asked, value_set=vectors["term"].combine_chunks())
    m = _matrix(vectors["v"].combine_chunks()) if "signs" not in vectors.column_names else _unpacked(vectors)
    norm = np.sqrt((m * m).sum(axis=1))
    m = m * (vectors["idf"].to_numpy() / np.where(norm > 0, norm, 1))[:, None]
    if hot is not None:
        place = pc.coalesce(place, pc.add(pc.index_in(asked, value_set=hot[0]), len(m)))
        m = np.concatenate([m, hot[1]])
    found = place.is_valid().to_numpy(zero_copy_only=False)
    place = place.fill_null(0).to_numpy()[found]
    which = np.repeat(np.arange(len(docs)), pc.list_value_length(docs["terms"]).to_numpy())[found]
    tf = _flat(docs["counts"]).to_numpy()[found]
    sums = _sums(which, len(docs), lambda lo, hi: tf[lo:hi, None] * m[place[lo:hi]])
    unit, rows = _units(sums)
    # Adding zero makes a negative zero positive.
    return pa.table({"doc_id": docs["doc_id"].take(pa.array(rows)), "vector": _lists(np.round(unit, DECIMALS) + 0.0)})


def term_vectors(index: TS.TextIndex) -> DataFrame:
    """(term, v, signs, shares, df, idf): the unit vector of each term, or what it is the sum of, its document frequency
    and the inverse of it. A term whose documents cancel out has none."""
    bits = F.translate(F.sha2(F.col("doc_id").cast("string").cast("binary"), 256), "0123456789abcdef", "0000000011111111")
    signed = index.docs.select("norm", "terms", "counts", F.conv(bits, 2, -10).cast("bigint").alias("signs"))
    parts = signed.mapInArrow(_chunk_terms, _PARTS_DDL)
    units = parts.repartition("term").sortWithinPartitions("term").mapInArrow(lambda b: _merge_terms(b, packed=True), _PARTS_DDL)
    return units.join(index.df, "term").select("term", "v", "signs", "shares", "df", TS.smooth_idf(index.n, F.col("df")).alias("idf"))


def embed_dense(index: TS.TextIndex) -> DataFrame:
    """D01 dense: (doc_id, vector), unit vectors of ``DIMS`` dimensions at six decimals. ``index`` has norms.

    Documents without a term, and those whose terms cancel out, have no vector.
    """
    spark = index.docs.sparkSession
    ship_code(spark)
    terms = written(term_vectors(index), "dense_terms")
    cut = max(index.frequent(HOT), PACKED)
    top = terms.where((F.col("df") >= cut) & (F.size("v") > 0)).select("term", "v", "idf").toArrow().combine_chunks()
    weighted = _matrix(top["v"].combine_chunks() if len(top) else pa.array([], pa.list_(pa.float64()))) * top["idf"].to_numpy()[:, None]
    shared = spark.sparkContext.broadcast((top["term"].to_pylist(), weighted))
    postings = index.df.agg(F.sum("df")).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = int(max(postings // GROUP, min(postings // CHUNK, tasks))) + 1
    docs = index.docs.select("doc_id", "terms", "counts", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int").alias("g"))
    rest = terms.where(F.col("df") < cut)
    frequent = F.broadcast(index.df.where(F.col("df") >= cut).select("term"))  # at most ``HOT``
    asked = docs.select("g", F.explode("terms").alias("term")).join(frequent, "term", "left_anti").distinct()
    vectors = asked.join(rest, "term").select(F.col("g").alias("asking"), "term", "v", "signs", "shares", "idf")
    out = T.StructType([index.docs.schema["doc_id"], T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def group(docs: pa.Table, vectors: pa.Table) -> pa.Table:
        names, m = shared.value
        return _documents(docs, vectors, (pa.array(names, pa.string()), m))

    return docs.groupBy("g").cogroup(vectors.groupBy("asking")).applyInArrow(group, out)
