"""Typed ingest, schema conformance, Z-order clustering,
change feed, row-count verification and result limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_ingest(df: DataFrame, json_col: str, schema: T.StructType, key_cols: list) -> DataFrame:
    """Parse JSON records under a declared schema (never inferred). Malformed records
    keep their raw text in ``_corrupt_record`` and are flagged for the quarantine split."""
    s = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(F.col(json_col), s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    out = df.select(*key_cols, parsed.alias("r"))
    return out.select(*key_cols, *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields],
                      F.col("r._corrupt_record").isNotNull().alias("quarantined"))


def conform_to_schema(df: DataFrame, target: T.StructType, lenient: bool = True) -> DataFrame:
    """Cast every column named in ``target`` to its type in one projection; other columns
    pass through. Lenient mode uses ``try_cast`` (bad values become NULL instead of failing)."""
    types = {f.name: f.dataType for f in target.fields}
    cols = []
    for c in df.columns:
        if c in types:
            col = F.col(c).try_cast(types[c]) if lenient else F.col(c).cast(types[c])
            cols.append(col.alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def z_value(df: DataFrame, cols: list) -> Column:
    """Interleave the min-max scaled values of integer columns (Morton code), with as many bits a column as fit 62, so
    that values stay apart beside a few extreme ones. All bounds come from one aggregate; NULL scales to 0. The scaling
    is in doubles, which do not overflow."""
    bits = 62 // len(cols)
    bounds = df.agg(*[f(c).cast("double").alias(f"{n}_{i}") for i, c in enumerate(cols) for n, f in (("min", F.min), ("max", F.max))]).first()
    z = F.lit(0).cast("bigint")
    for i, c in enumerate(cols):
        mn, mx = bounds[f"min_{i}"], bounds[f"max_{i}"]
        if mn == mx:
            continue
        s = F.floor((F.col(c).cast("double") - F.lit(mn)) * F.lit(float((1 << bits) - 1)) / F.lit(mx - mn))
        s = F.coalesce(s.cast("bigint"), F.lit(0).cast("bigint"))
        for b in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(s, b).bitwiseAND(F.lit(1).cast("bigint")), b * len(cols) + i))
    return z


def cluster_by_keys(df: DataFrame, cols: list, path: str) -> DataFrame:
    """Z-order clustering: globally sorted by the Z-value of ``cols``.

    The sort deals rows into ranges of Z (ties by the columns themselves) and AQE merges ranges up to its advisory size, so the number of
    files follows the bytes; a file covers a compact Z range, and Parquet min/max statistics skip
    files for point and box lookups on any of the columns.
    """
    df.withColumn("z_value", z_value(df, cols)).sort("z_value", *cols).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def row_hash(cols: list) -> Column:
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]), 256)


def change_feed(v1: DataFrame, v2: DataFrame, key: str) -> DataFrame:
    """Row changes between two snapshots: insert, delete, update_preimage, update_postimage.

    One full outer join on the key; rows are compared by a hash of their
    non-key columns with ``eqNullSafe``; an update emits its pre- and post-image.
    """
    cols = [c for c in v1.columns if c != key]
    a = v1.select(key, row_hash(cols).alias("_h1"), F.struct(*cols).alias("_r1"))
    b = v2.select(key, row_hash(cols).alias("_h2"), F.struct(*cols).alias("_r2"))
    j = a.join(b, key, "full")
    ch = F.when(F.col("_h1").isNull(), F.array(F.struct(F.lit("insert").alias("t"), F.col("_r2").alias("r")))) \
        .when(F.col("_h2").isNull(), F.array(F.struct(F.lit("delete").alias("t"), F.col("_r1").alias("r")))) \
        .when(~F.col("_h1").eqNullSafe(F.col("_h2")),
              F.array(F.struct(F.lit("update_preimage").alias("t"), F.col("_r1").alias("r")),
                      F.struct(F.lit("update_postimage").alias("t"), F.col("_r2").alias("r"))))
    e = j.select(key, F.explode(ch).alias("c"))
    return e.select(key, *[F.col(f"c.r.{c}").alias(c) for c in cols], F.col("c.t").alias("_change_type"))


def table_row_counts(tables: dict, expected: list) -> DataFrame:
    """One row per expected table: count, or NULL and present=false when absent. One column of a table is enough."""
    spark = next(iter(tables.values())).sparkSession
    counts = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = c if counts is None else counts.unionByName(c)
    exp = spark.createDataFrame([(t,) for t in expected], "table_name string")
    j = exp.join(counts, "table_name", "left")
    return j.select("table_name", "row_count", F.col("row_count").isNotNull().alias("present"))


def limit_result(df: DataFrame, order: list, n: int = 100) -> DataFrame:
    """Function results capped at ``n`` rows by a total order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)
