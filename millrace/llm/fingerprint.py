"""Document fingerprints from prefix polynomial hashes.

With H[i] = sum of c[j] * B^j over j < i (mod p), the hash of any span [i, i+k) is
(H[i+k] - H[i]) * B^-i (mod p): every span equality is one comparison, and the longest common
extension of two positions is a binary search over span lengths. A fingerprint holds the hash of the
whole text, the hashes of up to 16 consecutive blocks of it, and bottom-m sketches of the hashes of all
its k-character spans. The likeness of two fingerprints is the larger of the estimated share of
spans they have in common (Dice coefficient) and the share of equal blocks: the first finds moved and
inserted text, the second replaced parts of short or repetitive text.

Defined cases: NULL text counts as empty; two empty texts are equal (likeness 1), an empty and
another text have likeness 0; documents follow each other by id, NULL ids first, equal ids by text,
and the last is followed by the first (a single document follows itself); texts of any length are
hashed in blocks; an empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_code, text_or_empty

#: Two primes below 2^31, so that products fit 64 bits, and a base for each.
PRIMES = (2147483629, 2147483587)
BASES = (1000003, 998244353)
#: Span lengths: short spans for all texts, so that any two share a sketch, long spans for texts from LONG_FROM up.
SHORT_SPAN, LONG_SPAN = 4, 16
LONG_FROM = 150
SKETCH = 64
BLOCKS = 16
BLOCK = 1 << 20


class Powers:
    """B^j and B^-j modulo p, grown on demand up to a block."""

    def __init__(self, base: int, prime: int):
        self.base, self.inverse, self.prime = base, pow(base, -1, prime), prime
        self.up = np.ones(1, dtype=np.int64)
        self.down = np.ones(1, dtype=np.int64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * pow(self.base, m, self.prime) % self.prime])
            self.down = np.concatenate([self.down, self.down * pow(self.inverse, m, self.prime) % self.prime])


POWERS = [Powers(b, p) for b, p in zip(BASES, PRIMES)]


def codes(text: str) -> np.ndarray:
    """Code points, from 1 so that leading characters count."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64) + 1


def prefix(c: np.ndarray, which: int = 0) -> np.ndarray:
    """The prefix array H of a block of code points."""
    p = POWERS[which]
    p.reach(len(c) + 1)
    h = np.empty(len(c) + 1, dtype=np.int64)
    h[0] = 0
    np.cumsum(c * p.up[:len(c)] % p.prime, out=h[1:])
    h[1:] %= p.prime
    return h


def span_hash(h: np.ndarray, start, length, which: int = 0):
    """Hash of the spans [start, start + length); vectors or numbers."""
    p = POWERS[which]
    return (h[start + length] - h[start]) % p.prime * p.down[start] % p.prime


def longest_common_extension(a: str, b: str, i: int = 0, j: int = 0) -> int:
    """Length of the longest common prefix of a[i:] and b[j:]: block by block, then binary search."""
    total = 0
    while True:
        x, y = codes(a[i:i + BLOCK]), codes(b[j:j + BLOCK])
        n = min(len(x), len(y))
        x, y = x[:n], y[:n]
        ha, hb = [prefix(x, w) for w in (0, 1)], [prefix(y, w) for w in (0, 1)]
        low, high = 0, n
        while low < high:
            mid = (low + high + 1) // 2
            if all(span_hash(ha[w], 0, mid, w) == span_hash(hb[w], 0, mid, w) for w in (0, 1)):
                low = mid
            else:
                high = mid - 1
        total += low
        if low < n or n < BLOCK:
            return total
        i, j = i + n, j + n


def _mix(v: np.ndarray) -> np.ndarray:
    """32 well-mixed bits of span hashes."""
    x = v.astype(np.uint64)
    x = (x ^ (x >> np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def _smallest(v: np.ndarray, m: int) -> np.ndarray:
    """The m smallest distinct values, sorted."""
    take = 4 * m
    while len(v) > take:
        part = np.unique(np.partition(v, take)[:take])
        if len(part) >= m:
            return part[:m]
        take *= 4
    return np.unique(v)[:m]


class Fingerprint:
    """Hash of the whole text, its length, hashes of its blocks, and one sketch per span length."""

    def __init__(self, text: str):
        self.n = len(text)
        spans = [SHORT_SPAN, LONG_SPAN] if self.n >= LONG_FROM else [SHORT_SPAN]
        best = {k: np.empty(0, dtype=np.uint32) for k in spans}
        whole = [0, 0]
        bounds = np.arange(min(BLOCKS, self.n) + 1) * self.n // max(min(BLOCKS, self.n), 1)
        at_bound = np.zeros(len(bounds), dtype=np.int64)
        for at in range(0, self.n, BLOCK):
            # Blocks overlap by a span less one, so no span is lost at an edge.
            c = codes(text[at:at + BLOCK + LONG_SPAN - 1])
            own = min(len(c), BLOCK)
            h = prefix(c)
            for w, hw in ((0, h), (1, prefix(c[:own], 1))):
                p = POWERS[w]
                if w == 0:
                    here = (bounds > at) & (bounds <= at + own)
                    at_bound[here] = (whole[0] + hw[bounds[here] - at] * pow(p.base, at, p.prime)) % p.prime
                whole[w] = (whole[w] + int(hw[own]) * pow(p.base, at, p.prime)) % p.prime
            for k in spans:
                n = min(own, len(c) - k + 1)
                if n > 0:
                    v = _mix(span_hash(h, np.arange(n), k))
                    best[k] = _smallest(np.concatenate([best[k], _smallest(v, SKETCH)]), SKETCH)
        if 0 < self.n < SHORT_SPAN:  # shorter than a span: the whole text is its only span
            best[SHORT_SPAN] = _mix(np.array([whole[0]]))
        self.whole, self.sketches = (whole[0], whole[1]), best
        self.blocks = [int(d) % PRIMES[0] * pow(POWERS[0].inverse, int(b), PRIMES[0]) % PRIMES[0]
                       for d, b in zip(np.diff(at_bound), bounds[:-1])]

    def __str__(self) -> str:
        head = f"{self.n:x}-{self.whole[0]:08x}{self.whole[1]:08x}"
        return "-".join([head, "".join(f"{b:08x}" for b in self.blocks), *(f"{k}." + v.astype(">u4").tobytes().hex() for k, v in self.sketches.items())])

    def likeness(self, other: "Fingerprint") -> float:
        """1 for equal fingerprints; else the larger of span likeness and block likeness."""
        if (self.n, self.whole) == (other.n, other.whole):
            return 1.0
        if not self.n or not other.n:
            return 0.0
        return max(self._span_likeness(other), self._block_likeness(other))

    def _block_likeness(self, other: "Fingerprint") -> float:
        return sum(x == y for x, y in zip(self.blocks, other.blocks)) / max(len(self.blocks), len(other.blocks))

    def _span_likeness(self, other: "Fingerprint") -> float:
        both = [k for k in self.sketches if k in other.sketches]
        if not both:
            return 0.0
        a, b = self.sketches[max(both)], other.sketches[max(both)]
        union = np.union1d(a, b)[:SKETCH]
        shared = len(np.intersect1d(np.intersect1d(a, b), union))
        j = shared / len(union) if len(union) else 0.0
        return 2 * j / (1 + j)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (rounded down) replaced by as many first characters of ``following``."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def with_next(docs: DataFrame, run, schema: T.StructType, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``run(rows)`` over an iterator of (doc_id, text, text of the next document by id).

    Documents are dealt into ranges between quantiles of the id. The first document of each range is
    dealt to the range before as well, where it only serves as the next document, so one
    shuffle is enough and a task holds two texts at a time.
    """
    spark = docs.sparkSession
    ship_code(spark)
    d = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = d.agg(F.min("doc_id").alias("low"), F.percentile_approx("doc_id", [k / n for k in range(1, n)]).alias("cuts"),
                  F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    cuts = [] if found["low"] is None else sorted({found["low"], *found["cuts"]})
    edges = np.array(cuts, dtype=np.int64)
    first_is_null = found["nulls"] > 0

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(edges, ids.fillna(np.iinfo(np.int64).min).to_numpy(dtype=np.int64), side="right") - 1
        return pd.Series(np.maximum(at, 0).astype(np.int32))

    last = max(len(cuts) - 1, 0)
    heads = F.col("doc_id").isin(*cuts[1:]) if last else F.lit(False)
    opener = F.col("doc_id").isNull() if first_is_null else F.col("doc_id") == F.lit(found["low"])
    place = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("role"))
    # role 0: a document; 1: the first of the next range; 2: the very first, after the very last.
    copies = F.concat(F.array(place),
                      F.when(heads, F.array(F.struct((F.col("bucket") - 1).alias("bucket"), F.lit(1).alias("role")))).otherwise(F.array().cast("array<struct<bucket:int,role:int>>")),
                      F.when(opener, F.array(F.struct(F.lit(last).alias("bucket"), F.lit(2).alias("role")))).otherwise(F.array().cast("array<struct<bucket:int,role:int>>")))
    dealt = (d.withColumn("bucket", bucket_of(F.col("doc_id").cast("bigint")))
             .select("doc_id", "text", F.explode(copies).alias("p")).select("p.bucket", "p.role", "doc_id", "text")
             .repartition(n // 4, "bucket").sortWithinPartitions("bucket", "role", F.col("doc_id").asc_nulls_first(), "text"))

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        before = None
        for b in batches:
            for row in zip(b["bucket"], b["role"], b["doc_id"], b["text"]):
                if before is not None and before[1] == 0 and before[0] == row[0]:
                    yield before[2], before[3], row[3]
                before = row

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for row in run(pairs(batches)):
            rows.append(row)
            if len(rows) == 500:
                yield pd.DataFrame(rows, columns=schema.names)
                rows = []
        yield pd.DataFrame(rows, columns=schema.names)

    return dealt.mapInPandas(work, schema)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The fingerprint of each document and of its edited text, and the likeness to the edited text and
    to the next document. ``common_edited`` and ``common_next`` are the longest common extensions from the start."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()), T.StructField("common_edited", T.LongType()), T.StructField("common_next", T.LongType())])

    def run(rows):
        last: tuple[str, Fingerprint] | None = None
        for doc_id, text, following in rows:
            # A text is the next document of the row before: its fingerprint is there already.
            own = last[1] if last is not None and last[0] == text else Fingerprint(text)
            other = Fingerprint(following)
            last = (following, other)
            changed = edited(text, following)
            new = Fingerprint(changed)
            yield (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), str(own), str(new),
                   own.likeness(new), own.likeness(other), longest_common_extension(text, changed), longest_common_extension(text, following))

    return with_next(docs, run, schema, id_col, text_col)
