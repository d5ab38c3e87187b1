"""Mixing sources to target weights by capped water-filling (native DataFrame functions only).

Sources get a share of the budget in proportion to their weight; a source whose share exceeds
``max_epochs`` times its size is clamped there and the excess is shared again by weight, until
no share is above its cap. Each source is then repeated: every document a whole number of times,
and, in a seeded order, the documents up to the remaining fraction once more; the document at
the edge of that fraction is repeated in part, so a source misses its target by under one word.

Defined cases: NULL or empty text has size 0 and is taken 0 words; a NULL source is a source of
its own, ranked last; rows with equal ids are separate documents (rows alike share the words left to
them at the edge, rounded down); an empty table gives an empty result; further columns of the input do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, words, written

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
#: Hex digits of the seeded key that number the buckets of a source (16 ** 3 of them).
BUCKET_DIGITS = 3


def with_weights(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add ``weight``: the pattern repeats over the sources in code-point order, NULL last.

    The rank is the row's place in its range partition plus the rows of the partitions before,
    so the list of sources is not sorted in one task. Written, as the water-filling loop reads it.
    """
    numbered = written(sizes.orderBy(F.col("source").asc_nulls_last())
                       .withColumn("_id", F.monotonically_increasing_id()), "mix-sources")
    pid = F.shiftright("_id", 33)
    per_partition = numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    offsets = per_partition.select("_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    rank = F.col("_offset") + F.col("_id") - F.shiftleft(F.col("_pid"), 33)
    pattern = F.array(*[F.lit(w) for w in weights])
    return written(numbered.withColumn("_pid", pid).join(offsets, "_pid")
                   .select("source", "source_size", pattern[(rank % len(weights)).cast("int")].cast("bigint").alias("weight")),
                   "mix-weights")


def water_fill(sources: DataFrame, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to (source, source_size, weight).

    Each round is one aggregate of the source table: what the clamped sources hold and the weight
    of the others give the next level. The level only rises, so a source once clamped stays so, and
    the loop ends when the number of clamped sources does not change.
    """
    cap = max_epochs * F.col("source_size")
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return sources.withColumn("target", F.lit(0.0))
    level, clamped = budget * total / weight, 0
    while True:
        over = cap < F.lit(level) * F.col("weight")
        held, free, n = sources.agg(F.sum(F.when(over, cap).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))),
                                    F.count_if(over)).first()
        if n == clamped or not free:
            break
        level, clamped = (budget * total - held) / free, n
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken and the ``carry`` columns.

    The seeded order is md5(doc_id:seed). Within a source the sizes are summed by key prefix first;
    only the bucket in which the fraction ends is resolved document by document. The documents meet
    two short tables, one row a source and one a document of such a bucket, and are not shuffled
    unless these are long.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(seed)).cast("binary"))
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.size(words(text_or_empty(text_col))).cast("bigint").alias("size"), key.alias("_key"),
        *[F.col(c).alias(f"_carry_{c}") for c in carry]).withColumn("_b", F.substring("_key", 1, BUCKET_DIGITS))
    keys = written(sized.select("doc_id", "source", "size", "_key", "_b"), "mix-keys")

    buckets = keys.groupBy("source", "_b").agg(F.sum("size").alias("_n"))
    plan = water_fill(with_weights(buckets.groupBy("source").agg(F.sum("_n").alias("source_size")), weights),
                      budget, max_epochs)
    plan = plan.withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
    # Words of the partial repetition: what the target holds beyond the whole ones.
    plan = plan.withColumn("_part", F.round(F.col("target")).cast("bigint") - F.col("_whole") * F.col("source_size")).withColumnRenamed("source", "_s")

    # The bucket in which the partial repetition ends: all buckets before it are taken once more.
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 rows a source
    placed = (buckets.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .join(plan.select("_s", "_part"), F.col("source").eqNullSafe(F.col("_s"))))
    ends = placed.where((F.col("_before") < F.col("_part")) & (F.col("_part") <= F.col("_before") + F.col("_n"))) \
        .select("_s", F.col("_b").alias("_end"), (F.col("_part") - F.col("_before")).alias("_left"))
    plan = written(plan.join(ends.withColumnRenamed("_s", "_e"), F.col("_s").eqNullSafe(F.col("_e")), "left").drop("_e"), "mix-plan")

    # Inside those buckets, document by document; rows alike share what is left to them.
    same = keys.join(plan.select("_s", "_end", "_left"), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_end"))) \
        .groupBy("source", "_key", "doc_id", "size", "_left").agg(F.count(F.lit(1)).alias("_m"))
    within = Window.partitionBy("source").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("_left") - F.coalesce(F.sum(F.col("_m") * F.col("size")).over(within), F.lit(0))
    share = F.floor(F.greatest(F.least(F.col("_m") * F.col("size"), rest), F.lit(0)) / F.col("_m"))
    edge = written(same.select(F.col("source").alias("_es"), F.col("_key").alias("_ek"), F.col("doc_id").alias("_ei"), F.col("size").alias("_ez"),
                               share.cast("bigint").alias("_share")), "mix-edge")

    d = sized.join(plan, F.col("source").eqNullSafe(F.col("_s"))).join(
        edge, F.col("source").eqNullSafe(F.col("_es")) & (F.col("_key") == F.col("_ek")) & F.col("doc_id").eqNullSafe(F.col("_ei")) & (F.col("size") == F.col("_ez")), "left")
    extra = F.when(F.col("_b") < F.col("_end"), F.col("size")).when(F.col("_b") == F.col("_end"), F.coalesce("_share", F.lit(0))).otherwise(0)
    out = d.withColumn("taken", (F.col("_whole") * F.col("size") + extra).cast("bigint"))
    return out.select("doc_id", "size", "source_size", "target", "taken", *[F.col(f"_carry_{c}").alias(c) for c in carry])
