"""Hard-negative mining by threshold joins in the manner of L2AP.

Rows are integer vectors with a label, anchors are some of them. An anchor's positives are its best rows of the same
label; for each positive, the hard negatives are the best rows of other labels with a score in
[low/100 * positive score, positive score].

Both are joins "score at least t" with a threshold of each anchor's own. Rows and anchors are dealt into blocks of
bounded size and every pair of blocks meets in one task, which holds an inverted index of its rows: dimensions in order
of falling energy, and of each row only the dimensions that its suffix norm does not cover (below it, the row's
remaining norm times the largest remaining norm of an anchor cannot reach the least threshold, so such a rest never
makes a pair; a row without any indexed dimension is out). Partial scores are accumulated dimension group by dimension
group; a pair whose partial score plus the product of both remaining norms misses its threshold is pruned, survivors
are scored exactly in integers. Thresholds start high and are lowered for the anchors whose windows are not full
(``LEVELS``), down to each anchor's floor: the k-th best positive within one block of rows (its score is a lower bound
of that over all rows), or the lower end of the widest negative window. At the floor nothing is left out, so a result
is exact wherever the search stops. A task returns at most k rows a window; Spark merges them.

Defined cases: rows with a NULL id, label or vector, or a NULL or non-finite component, take no part; an id that occurs
more than once is one row, the one with the smallest (label, vector); vectors of unequal length are padded with zeros;
ties go to the smaller id; an anchor without another row of its label has no positives, one without rows in the window
no negatives, hence no rows; empty tables give an empty result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_code, written

#: Rows of an index block and anchors of an anchor block: what one task holds.
ROW_BLOCK, ANCHOR_BLOCK = 20000, 10000
#: Share of the way from an anchor's floor to its highest possible score at which its threshold stands, in turn.
LEVELS = (0.6, 0.35, 0.15, 0.0)
#: Dimensions accumulated between two prunings.
GROUP = 8
#: Cells (anchor, row) of a task's score matrix.
CELLS = 1 << 22


def quantised(vector: Column, scale: int = 256) -> Column:
    """array<bigint> of floor(scale * x); NULL where the vector or a component is NULL or not finite."""
    x = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(x, lambda c: F.floor(c * float(scale)).cast("bigint")))


def usable(rows: DataFrame) -> DataFrame:
    """id, label, vector: one row an id, without the rows that take no part."""
    valid = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").select("id", "label", "vector")
    return valid.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r")).select("id", "r.label", "r.vector")


# ------------------------------------------------------------------ inside a task
def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.float64)
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def _suffix_norms(x: np.ndarray) -> np.ndarray:
    """rows x (dims + 1): the norm of what follows each dimension, a little above its true value."""
    squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([squares, np.zeros((len(x), 1))])) * (1 + 1e-9)


class BlockIndex:
    """Rows of a block, indexed for thresholds of at least ``lowest`` by anchors with the given remaining norms."""

    def __init__(self, x: np.ndarray, x_rest: np.ndarray, q_most: np.ndarray, lowest: float):
        # Dimensions of a row that the bound does not cover; the rest is left out of the index.
        self.depth = (x_rest * q_most >= lowest).sum(axis=1) if lowest > 0 else np.full(len(x), x.shape[1])
        self.depth = np.minimum(self.depth, x.shape[1])
        order = np.argsort(-self.depth, kind="stable")
        self.rows = order[:int((self.depth > 0).sum())] if lowest > 0 else order
        self.depth = self.depth[self.rows]
        #: Posting list of dimension j: the first ``ends[j]`` of ``rows``.
        self.ends = np.searchsorted(-self.depth, -np.arange(x.shape[1]), "left")
        self.x, self.rest = x[self.rows], x_rest[self.rows]


def pairs_above(q: np.ndarray, q_rest: np.ndarray, least: np.ndarray, x: np.ndarray, x_rest: np.ndarray, exact: bool):
    """(anchor, row, score) of all pairs with score >= ``least`` of the anchor; columns by falling energy."""
    dims = x.shape[1]
    slack = 1e-6 if exact else 1e-9 * float(q_rest[:, 0].max()) * float(x_rest[:, 0].max())
    least = least - (0 if exact else slack)
    index = BlockIndex(x, x_rest, q_rest.max(axis=0), float(least.min()))
    found = []
    step = max(1, CELLS // max(1, len(index.rows)))
    for at in range(0, len(q) if len(index.rows) else 0, step):
        a, a_rest, bar = q[at:at + step], q_rest[at:at + step], least[at:at + step, None]
        live = np.arange(len(index.rows))  # rows that some anchor of this run can still reach
        score = np.zeros((len(a), len(live)))
        for lo in range(0, dims, GROUP):
            hi = min(lo + GROUP, dims)
            n = int(np.searchsorted(live, index.ends[lo]))  # live rows with an entry in this group's first posting list
            if not n:
                break
            entry = index.x[live[:n], lo:hi]
            if index.depth[live[n - 1]] < hi:  # entries past a row's indexed dimensions are not in the lists
                entry = np.where(np.arange(lo, hi) < index.depth[live[:n], None], entry, 0.0)
            score[:, :n] += a[:, lo:hi] @ entry.T
            # A row's rest starts at its last indexed dimension, if that lies before the group's end.
            stop = np.minimum(index.depth[live], hi)
            reach = score + a_rest[:, stop] * index.rest[live, stop] >= bar - slack
            keep = reach.any(axis=0)
            if not keep.any():
                live = live[:0]
                break
            if keep.mean() < 0.9:
                live, score = live[keep], score[:, keep]
        if not len(live):
            continue
        stop = index.depth[live]
        who, what = np.nonzero(score + a_rest[:, stop] * index.rest[live, stop] >= bar - slack)
        if exact and len(who) > 0.2 * score.size:
            full = a @ index.x[live].T
            total = full[who, what]
        elif exact:
            total = np.concatenate([np.einsum("ij,ij->i", a[who[k:k + 65536]], index.x[live[what[k:k + 65536]]]) for k in range(0, len(who), 65536)] or [np.zeros(0)])
        else:  # beyond 2^53 in Python's integers
            total = np.array([sum(int(u) * int(v) for u, v in zip(a[i], index.x[live[j]])) for i, j in zip(who, what)], object)
        good = np.asarray(total >= bar[who, 0], bool) if len(who) else np.zeros(0, bool)
        found.append((who[good] + at, index.rows[live[what[good]]], total[good]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    who, row, total = (np.concatenate(c) for c in zip(*found))
    return who, row, total.astype(np.int64)


def _best(window: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k by (score desc, id) of each window, in order."""
    order = np.lexsort((ids, -score, window))
    w = window[order]
    return order[np.arange(len(w)) - np.searchsorted(w, w) < k]


def _search(rows: pd.DataFrame, anchors: pd.DataFrame, same_label: bool, floor: np.ndarray, windows: list[np.ndarray], k: int):
    """Rows (anchor, window, row, score): per window of an anchor (its upper end; a window's lower end is the anchor's
    floor or above) the first k rows of the same or of other labels, from thresholds that fall until they are full."""
    width = max([len(v) for v in rows["vector"]] + [len(v) for v in anchors["vector"]])
    x, q = _matrix(rows["vector"], width), _matrix(anchors["vector"], width)
    energy = np.argsort(-(x * x).sum(axis=0), kind="stable")
    x, q = x[:, energy], q[:, energy]
    x_rest, q_rest = _suffix_norms(x), _suffix_norms(q)
    exact = float(q_rest[:, 0].max()) * float(x_rest[:, 0].max()) < 2.0 ** 52
    ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
    a_ids, a_labels = anchors["id"].to_numpy(), anchors["label"].to_numpy()
    count = np.array([len(w) for w in windows])
    start = np.concatenate([[0], np.cumsum(count)])
    upper = np.concatenate(windows) if len(windows) else np.zeros(0)
    highest = q_rest[:, 0] * float(x_rest[:, 0].max())
    tops = np.array([min(h, w.max()) if len(w) else -np.inf for h, w in zip(highest, windows)])
    # Without a floor, the last level takes every row.
    usual = np.maximum(floor, -highest - 1)
    open_ = np.flatnonzero((count > 0) & (floor <= tops))
    out = []
    for level in LEVELS:
        if not len(open_):
            break
        least = usual[open_] + np.maximum(0.0, level) * np.maximum(0.0, tops[open_] - usual[open_])
        parts = []
        if same_label:  # only the rows of an anchor's own label are met
            for label in np.unique(a_labels[open_]):
                mine, theirs = np.flatnonzero(a_labels[open_] == label), np.flatnonzero(labels == label)
                if len(theirs):
                    who, row, total = pairs_above(q[open_[mine]], q_rest[open_[mine]], least[mine], x[theirs], x_rest[theirs], exact)
                    parts.append((open_[mine[who]], theirs[row], total))
        else:
            who, row, total = pairs_above(q[open_], q_rest[open_], least, x, x_rest, exact)
            parts.append((open_[who], row, total))
        who, row, total = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        good = (a_ids[who] != ids[row]) & ((a_labels[who] == labels[row]) == same_label)
        who, row, total = who[good], row[good], total[good]
        spread = np.repeat(np.arange(len(who)), count[who])  # a pair may stand in each window of its anchor
        window = start[who[spread]] + np.arange(len(spread)) - np.searchsorted(spread, spread)
        within = total[spread] <= upper[window]
        spread, window = spread[within], window[within]
        at = _best(window, total[spread], ids[row[spread]], k)
        spread, window = spread[at], window[at]
        full = np.bincount(window, minlength=len(upper)) >= k
        done = np.array([full[start[a]:start[a + 1]].all() for a in open_]) | (least <= usual[open_])
        ended = np.zeros(len(a_ids), bool)
        ended[open_[done]] = True
        keep = ended[who[spread]]
        out.append((who[spread[keep]], window[keep] - start[who[spread[keep]]], row[spread[keep]], total[spread[keep]]))
        open_ = open_[~done]
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


# ------------------------------------------------------------------ over the cluster
def _blocks(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int):
    """Both sides, each copied to the blocks of the other, keyed by (_r, _a)."""
    def over(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    r = rows.withColumn("_r", F.pmod(F.xxhash64("id"), F.lit(n_rows)).cast("int")).withColumn("_a", over(n_anchors))
    a = anchors.withColumn("_a", F.pmod(F.xxhash64("id"), F.lit(n_anchors)).cast("int")).withColumn("_r", over(n_rows))
    return r, a


def _join(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, task, schema: str) -> DataFrame:
    r, a = _blocks(rows, anchors, n_rows, n_anchors)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({n.split()[0]: [] for n in schema.split(", ")}).astype("int64")
        return task(left, right)

    return r.groupBy("_r", "_a").cogroup(a.groupBy("_r", "_a")).applyInPandas(run, schema)


def _first(df: DataFrame, keys: list[str], k: int, score: str = "score", row: str = "row_id") -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(row))
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def positives(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, k: int) -> DataFrame:
    """id (the anchor's), row_id, score, place: the first ``k`` other rows of the anchor's label."""
    def task(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        floor = right["floor"].to_numpy(dtype=np.float64, na_value=-np.inf) if "floor" in right else np.full(len(right), -np.inf)
        who, _, row, score = _search(left, right, True, floor, [np.array([np.inf])] * len(right), k)
        return pd.DataFrame({"id": right["id"].to_numpy()[who], "row_id": left["id"].to_numpy()[row], "score": score})

    schema = "id long, row_id long, score long"
    if n_rows > 1:  # the k-th best within one block is a floor for all
        probe = _first(_join(rows.where(F.pmod(F.xxhash64("id"), F.lit(n_rows)) == 0), anchors, 1, n_anchors, task, schema), ["id"], k)
        floor = probe.groupBy("id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("floor"))
        anchors = written(anchors.join(floor, "id", "left"), "anchor-floors")
    return _first(_join(rows, anchors, n_rows, n_anchors, task, schema), ["id"], k)


def negatives(rows: DataFrame, found: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, k: int, low: int) -> DataFrame:
    """id, window (place of the positive), row_id, score, place: per positive the first ``k`` rows of other labels
    in its window."""
    # An anchor has a handful of positives: one array. Below a positive score of 0 the window is empty.
    held = found.where("score >= 0").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("p"))
    sought = written(anchors.join(held, "id").select("id", "label", "vector", F.col("p.place").alias("places"), F.col("p.score").alias("tops")), "anchor-windows")

    def task(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        tops = [np.asarray(t, np.int64) for t in right["tops"]]
        # 100 * score >= low * top, in integers.
        lows = [-((-low * t) // 100) for t in tops]
        floor = np.array([b.min() for b in lows], np.float64)
        who, window, row, score = _search(left, right, False, floor, tops, k)
        places = [np.asarray(p, np.int64) for p in right["places"]]
        at = np.array([places[a][w] for a, w in zip(who, window)], np.int64)
        in_window = score >= np.array([lows[a][w] for a, w in zip(who, window)], np.int64) if len(who) else np.zeros(0, bool)
        out = pd.DataFrame({"id": right["id"].to_numpy()[who], "window": at, "row_id": left["id"].to_numpy()[row], "score": score})
        return out[in_window]

    got = _join(rows, sought, n_rows, n_anchors, task, "id long, window long, row_id long, score long")
    return _first(got, ["id", "window"], k)


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from rows (id, label, vector of
    integers); ``is_anchor`` is a condition on ``id`` and ``label``."""
    spark = rows.sparkSession
    ship_code(spark)
    kept = written(usable(rows), "vectors")
    anchors = kept.where(is_anchor)
    n, m = kept.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    n_anchors = max(1, -(-m // ANCHOR_BLOCK))
    n_rows = max(1, -(-n // ROW_BLOCK), -(-spark.sparkContext.defaultParallelism // n_anchors))
    found = written(positives(kept, anchors, n_rows, n_anchors, n_positives), "positives")
    worst = negatives(kept, found, anchors, n_rows, n_anchors, n_negatives, low)
    of = found.select("id", F.col("place").alias("window"), F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return worst.join(of, ["id", "window"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("place").cast("int").alias("rank"),
        F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
