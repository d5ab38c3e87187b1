"""Exact substring join by one multi-pattern automaton over all queries.

``contains_join(q, t)`` returns every (query, target) pair where the target text contains the query text. The distinct
query texts are dealt into blocks of at most ``PATTERN_CHARS`` characters; a block is broadcast and compiled into one
Aho-Corasick automaton, which reads each target text once, whatever the number of queries; targets are not shuffled.
More queries are more passes. A NULL or empty query, or a NULL target, meets nothing.

Where only the first target of a query is wanted, ``first_by`` names the columns of the order: of an Arrow batch, only the
first rows of each query are passed on, so what a task sorts for the final minimum is some rows a query and batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_code

#: Characters of the patterns that are broadcast and compiled at once.
PATTERN_CHARS = 1 << 23


def pattern_blocks(patterns: DataFrame, col: str) -> Iterator[list[str]]:
    """The distinct non-empty patterns in lists of at most ``PATTERN_CHARS`` characters (or of one pattern)."""
    p = patterns.where(F.length(col) > 0).select(F.col(col).alias("p")).distinct()
    blocks = 1
    while p.groupBy(F.pmod(F.xxhash64("p"), F.lit(blocks))).agg(F.sum(F.length("p")).alias("n"), F.count(F.lit(1)).alias("c")) \
            .where((F.col("n") > PATTERN_CHARS) & (F.col("c") > 1)).limit(1).count():
        blocks *= 2
    for b in range(blocks):
        yield [r.p for r in p.where(F.pmod(F.xxhash64("p"), F.lit(blocks)) == b).collect()]


def _firsts(batch: pa.RecordBatch, found: np.ndarray, first_by: list[str]) -> np.ndarray:
    """The rows that no other row with the same number in ``found`` precedes by ``first_by`` (NULL first); equal ones stay."""
    keys = pa.table([pa.array(found), *(batch.column(c) for c in first_by)], names=[str(k) for k in range(len(first_by) + 1)])
    order = pc.sort_indices(keys, sort_keys=[(c, "ascending") for c in keys.column_names], null_placement="at_start").to_numpy()
    who = found[order]
    start = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
    leader = np.repeat(start, np.diff(np.r_[start, len(who)]))
    same = np.ones(len(who), bool)
    for c in first_by:
        codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy()[order]
        same &= codes == codes[leader]
    return np.sort(order[same])


def _matches(targets: DataFrame, t_text: str, patterns: list[str], first_by: list[str] | None = None) -> DataFrame:
    """The target rows that hold a pattern, once for each pattern, with it as ``_q``."""
    ship_code(targets.sparkSession)
    shared = targets.sparkSession.sparkContext.broadcast(sorted(patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick
        automaton = ahocorasick.Automaton()
        for k, p in enumerate(shared.value):
            automaton.add_word(p, k)
        automaton.make_automaton()
        for b in batches:
            rows, found = [], []
            for k, text in enumerate(b.column(t_text).to_pylist()):
                if text:
                    hits = sorted({h for _, h in automaton.iter(text)})
                    rows += [k] * len(hits)
                    found += hits
            if rows:
                kept = b.take(pa.array(rows, pa.int64()))
                if first_by:
                    at = _firsts(kept, np.array(found, np.int64), first_by)
                    kept, found = kept.take(pa.array(at)), [found[k] for k in at]
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([shared.value[h] for h in found], pa.string())], names=[*kept.schema.names, "_q"])

    return targets.mapInArrow(run, T.StructType([*targets.schema.fields, T.StructField("_q", T.StringType())]))


def contains_join(queries: DataFrame, q_text: str, targets: DataFrame, t_text: str, first_by: list[str] | None = None) -> DataFrame:
    """All (query row, target row) pairs with ``contains(target, query)``; query text non-empty. With ``first_by``, pairs
    may be left out that another pair of the same query precedes by these columns, so a minimum over them is the same."""
    found = None
    for patterns in pattern_blocks(queries, q_text):
        if patterns:
            part = _matches(targets, t_text, patterns, first_by)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = targets.where("false").withColumn("_q", F.lit(None).cast("string"))
    return queries.join(found, queries[q_text] == found["_q"]).drop("_q")
