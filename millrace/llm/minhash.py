"""MinHash near-dedup with sequential Bayesian verification.

Every text becomes a set of 5-word shingles (64-bit hashes); texts with the same set form a class, and
one representative goes on. Signatures are cut into bands; representatives with an equal band share
a bucket. First every member is compared with one bucket's smallest id only, the one it shares most
buckets with; then members outside the component of their bucket's smallest id are compared with the
most similar of one random member a bucket. This connects the large groups of copies with a few
pairs a member. After that, members still outside are compared with all others of
the bucket that are in another component. Hence every pair of a bucket is compared or already
connected, and no bucket is expanded into all of its pairs: the comparison is the condition of the
join, so a pair leaves the join only if it passes, and only from the first band that the two share.

A comparison takes 128 two-bit signature values, then 256, 512 and 1024. After n values with m matches, the posterior
of the similarity under a flat prior decides: a pair is dropped as soon as the probability that it
reaches the threshold is below ``MISS``. What passes all batches is verified exactly on full sets.

A pair at the threshold shares no band with probability (1 - 0.75^6)^72 < 1e-6, and less above it.

Defined cases: NULL, empty or blank text has an empty set and is linked with nothing; a text of fewer
than five words has its whole sequence as its one shingle; repeated rows fall into one class; of
different texts with one id each stands for itself, and where they are near-duplicates of each other one is kept; a NULL
id is a document that no other links to by id (its component is that of its class); an empty table
gives an empty result; further columns of the input do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_code, text_or_empty, written
from .graph import components

SHINGLE = 5
THRESHOLD = 75  # percent
BANDS, ROWS = 72, 6
#: 64-bit words of a signature, with 32 two-bit values each; words compared by each step of the test.
WORDS = 32
STEPS = (4, 8, 16, 32)
N_HASHES = 32 * WORDS  # the first BANDS * ROWS of them also make the bands
#: The chosen probability that a step drops a pair at the threshold.
MISS = 1e-7
#: Rounds that look for one link of a member before all of its buckets' pairs are compared.
ROUNDS = 1

_rng = np.random.default_rng(20240501)
_MULT = (_rng.integers(0, 1 << 32, N_HASHES, dtype=np.uint64) | 1).astype(np.uint32)
_CHUNK = 512


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes. ``bytes.lower`` folds A-Z only, and ``bytes.split`` cuts at
    exactly the six ASCII white-space bytes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(SHINGLE, len(h))
    n = len(h) - k + 1
    s = np.full(n, k, dtype=np.uint64)  # the number of words tells short sequences apart
    for j in range(k):
        s = _mix64(s * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
    return np.unique(s)


def signature(s: np.ndarray) -> np.ndarray:
    """Minimum of each of ``N_HASHES`` multiplicative hashes over the set."""
    x = (s >> np.uint64(32)).astype(np.uint32) ^ s.astype(np.uint32)
    out = np.full(N_HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), _CHUNK):
        np.minimum(out, np.multiply.outer(_MULT, x[at:at + _CHUNK]).min(axis=1), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = _mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig[j:BANDS * ROWS:ROWS].astype(np.uint64))
    return key.view(np.int64)


def two_bits(sig: np.ndarray) -> np.ndarray:
    """Two well-mixed bits of each signature value, as ``WORDS`` 64-bit numbers."""
    pairs = (_mix64(sig.astype(np.uint64) + np.uint64(1)) >> np.uint64(40)).astype(np.uint64) & np.uint64(3)
    return (pairs.reshape(WORDS, 32) << (2 * np.arange(32, dtype=np.uint64))).sum(axis=1, dtype=np.uint64).view(np.int64)


def set_id(s: np.ndarray) -> bytes:
    return hashlib.md5(s.tobytes()).digest()


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for doc_id, text, text_key in zip(b["doc_id"], b["text"], b["text_key"]):
            s = shingles(text)
            sig = signature(s)
            rows.append((doc_id, text_key, len(s), set_id(s) if len(s) else None,
                         two_bits(sig) if len(s) else None, band_keys(sig) if len(s) else None))
        yield pd.DataFrame(rows, columns=["doc_id", "text_key", "n_shingles", "set_id", "sig", "bands"])


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), 200):
            part = b.iloc[at:at + 200]
            sets = [shingles(t) for t in part["text"]]
            yield pd.DataFrame({"set_id": [set_id(s) for s in sets], "s": [s.view(np.int64) for s in sets]})


def tail(n: int, m: int, agreement: float) -> float:
    """P(the chance of agreement is at least ``agreement`` | m of n values agree), flat prior over [1/4, 1].
    The posterior of a flat prior is Beta(m+1, n-m+1), and its tail at c is P(Bin(n+1, c) <= m)."""
    def above(c: float) -> float:
        return sum(comb(n + 1, k) * c ** k * (1 - c) ** (n + 1 - k) for k in range(m + 1))
    return above(agreement) / max(above(0.25), 1e-300)


@lru_cache(maxsize=None)
def least_matches(n: int) -> int:
    """The least number of agreements among n two-bit values at which a pair stays. Two sets of similarity J
    agree in two bits with chance J + (1 - J) / 4."""
    j = THRESHOLD / 100
    return next(m for m in range(n + 1) if tail(n, m, j + (1 - j) / 4) >= MISS)


def differing(x: str, y: str, words: range) -> Column:
    """How many of the two-bit values in these words differ."""
    total = F.lit(0)
    for k in words:
        d = F.col(x)[k].bitwiseXOR(F.col(y)[k])
        total = total + F.bit_count(d.bitwiseOR(F.shiftright(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def passes(x: str, y: str) -> Column:
    """The sequential test on two signature columns; later steps are not evaluated once one fails."""
    test = F.lit(True)
    for upto in STEPS:
        test = test & (32 * upto - differing(x, y, range(upto)) >= least_matches(32 * upto))
    return test


def verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the threshold. Sets are made again, for the documents that
    carry the smallest id of a class in pairs only, and told apart by their hash: an id may occur with several texts."""
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = written(classes.join(wanted.hint("merge"), "id").select("id", "doc_id", "set_id"), "nd-wanted")
    made = docs.join(wanted.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi").mapInPandas(_sets, "set_id binary, s array<bigint>")
    sets = written(made.dropDuplicates(["set_id"]).join(wanted.select("set_id", "id").hint("merge"), "set_id").select("id", "s"), "nd-sets")
    met = (pairs.join(sets.toDF("a", "sa").hint("merge"), "a").join(sets.toDF("b", "sb").hint("merge"), "b")
           .select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("both")))
    return written(met.where(100 * F.col("both") >= THRESHOLD * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b"), "nd-links")


def text_key(text_col: str = "text") -> Column:
    """Tells the rows of one id apart by their text."""
    return F.xxhash64(text_or_empty(text_col))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text_key: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per document; with ``with_text_key`` also the ``text_key`` of its text."""
    ship_code(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    base = written(d.withColumn("text_key", text_key()).mapInPandas(
        _describe, "doc_id bigint, text_key bigint, n_shingles bigint, set_id binary, sig array<bigint>, bands array<bigint>"), "nd-base")

    # A class goes by a number of its own up to the end, as several classes may have the same smallest document id.
    # Numbers follow these ids, so the first member of a bucket is its oldest document, the likely source of copies.
    classes = written(base.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id")).orderBy("doc_id", "set_id")
                      .withColumn("id", F.monotonically_increasing_id()), "nd-classes")
    # One row per class.
    reps = written(base.join(classes.toDF("_set", "_doc", "id").hint("merge"), (F.col("doc_id") == F.col("_doc")) & (F.col("set_id") == F.col("_set")))
                   .select("id", F.col("n_shingles").alias("n"), "sig", "bands").dropDuplicates(["id"]), "nd-reps")

    banded = reps.select("id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("m")).where("m > 1").select("key", "pivot")
    members = written(banded.join(buckets.hint("merge"), "key"), "nd-members")

    sig = reps.select("id", "sig")

    def screened(pairs: DataFrame) -> DataFrame:  # (a, x, b): b is to be tested
        tested = pairs.join(sig.toDF("b", "y").hint("merge"), "b").where(passes("x", "y"))
        return written(tested.select("a", "b"), "nd-pairs")

    # A member and the pivot that it shares most buckets with.
    first = (members.where("id != pivot").groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("shared"))
             .groupBy(F.col("id").alias("a")).agg(F.max_by("pivot", F.struct("shared", -F.col("pivot"))).alias("b")))
    found = components(verify(screened(first.join(sig.toDF("a", "x"), "a")), d, classes))

    def place() -> DataFrame:
        """The rows of buckets that hold several components."""
        comp = found.select(F.col("node").alias("id"), "component")
        p = (members.join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
             .join(comp.toDF("pivot", "home"), "pivot", "left").withColumn("home", F.coalesce("home", "pivot")))
        p = written(p.select("key", "id", "component", (F.col("component") != F.col("home")).alias("outside")), "nd-placed")
        return p.join(p.where("outside").select("key").distinct(), "key")

    for turn in range(ROUNDS):
        mixed = written(place(), "nd-mixed")
        mates = (mixed.where("not outside").groupBy("key").agg(F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("b")))
        best = (mixed.where("outside").join(mates, "key").select(F.col("id").alias("a"), "b").distinct()
                .join(sig.toDF("a", "x"), "a").join(sig.toDF("b", "y").hint("merge"), "b")
                .groupBy("a").agg(F.min_by("b", F.struct(differing("x", "y", range(WORDS)), "b")).alias("b")))
        more = verify(screened(best.join(sig.toDF("a", "x"), "a")), d, classes)
        if more.isEmpty():
            break
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    placed = written(place().join(reps, "id"), "nd-mixed")
    out = placed.where("outside").select("key", F.col("id").alias("x"), F.col("component").alias("cx"), F.col("n").alias("nx"), F.col("sig").alias("sx"), F.col("bands").alias("bx"))
    ratio = (100 * F.least("n", "nx") >= THRESHOLD * F.greatest("n", "nx"))  # the similarity is at most the ratio of sizes
    once = F.array_intersect("bx", "bands")[0] == out["key"]  # a key belongs to one band, and bands are in order
    rest = out.join(placed, (out["key"] == placed["key"]) & (F.col("cx") != F.col("component")) & (~F.col("outside") | (F.col("x") < F.col("id")))
                    & ratio & passes("sx", "sig") & once)
    rest = written(rest.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")), "nd-pairs")
    if not rest.isEmpty():
        more = verify(rest, d, classes)
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    # A component is named by its smallest document id. Of several classes with that id, one is its head.
    linked = written(classes.join(found.select(F.col("node").alias("id"), "component").hint("merge"), "id").select("set_id", "doc_id", "component"), "nd-linked")
    heads = written(linked.groupBy("component").agg(F.min(F.struct("doc_id", "set_id")).alias("head")), "nd-heads")
    placed = linked.join(heads, "component").select("set_id", F.col("head.doc_id").alias("component"), (F.col("set_id") == F.col("head.set_id")).alias("leads"))
    alone = classes.join(linked.select("set_id").hint("merge"), "set_id", "left_anti").select("set_id", F.col("doc_id").alias("component"), F.lit(True).alias("leads"))
    out = base.select("doc_id", "text_key", "n_shingles", "set_id").join(placed.unionByName(alone), "set_id", "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.coalesce("leads", F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), *(["text_key"] if with_text_key else []))
