"""Catalog DDL and writes.

Tables are plain Parquet (no Delta jar in the image). Data never passes
through the driver: every write is ``DataFrameWriter`` / ``INSERT`` from
executors. Locations live under the shared checkpoint folder
(``spark.checkpoint.dir``) or a path the caller passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .schemas import DOMAINS, TABLES, TableSpec


def _ddl_columns(spec: TableSpec) -> str:
    cols = []
    for name, typ, nullable, comment in spec.columns:
        c = f"`{name}` {typ.simpleString().upper()}"
        if comment:
            c += " COMMENT '" + comment.replace("'", "\\'") + "'"
        cols.append(c)
    return ",\n  ".join(cols)


def create_tables(spark: SparkSession, base_path: str, specs=None) -> DataFrame:
    """Domain databases and typed, commented Parquet tables; idempotent (IF NOT EXISTS).

    Partitioned tables are partitioned by their declared DATE column. Returns one
    row per (database, table, column) from the catalog.
    """
    specs = specs or list(TABLES.values())
    for db, comment in DOMAINS.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} COMMENT '{comment}' LOCATION '{base_path}/{db}.db'")
    for s in specs:
        part = f"\nPARTITIONED BY ({s.partition})" if s.partition and s.partition in [c[0] for c in s.columns] else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {s.qualified} (\n  {_ddl_columns(s)}\n) USING parquet{part}\n"
                  f"COMMENT '{s.name}'")
    rows = []
    for s in specs:
        for f in spark.table(s.qualified).schema.fields:
            rows.append((s.domain, s.name, f.name, f.dataType.simpleString()))
    return spark.createDataFrame(rows, "database string, table_name string, column_name string, data_type string")


def overwrite_table(df: DataFrame, table: str) -> DataFrame:
    """Replace a declared table's content, matching columns BY NAME.

    Column order comes from the table, so a reordered input cannot shift
    values into the wrong columns. For partitioned tables the session's
    ``partitionOverwriteMode`` decides static vs dynamic (A05 sets dynamic).
    """
    spark = df.sparkSession
    target_cols = spark.table(table).columns
    df.select(*target_cols).write.insertInto(table, overwrite=True)
    return spark.table(table)


def insert_overwrite_partitions(df: DataFrame, table: str) -> DataFrame:
    """Dynamic partition overwrite: only the partitions present in ``df`` are replaced."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        return overwrite_table(df, table)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def evolving_write(existing: DataFrame, batch: DataFrame, path: str) -> DataFrame:
    """Append a batch that may carry new columns; the union takes the merged schema."""
    merged = existing.unionByName(batch, allowMissingColumns=True)
    merged.write.mode("overwrite").parquet(path)
    return existing.sparkSession.read.parquet(path)


def partitioned_write(df: DataFrame, path: str, date_col: str, ts_col: str | None = None) -> DataFrame:
    """Write partitioned by a DATE (derived from a timestamp when ``ts_col`` is given). Rows are brought
    together by date; AQE splits a hot date by its advisory size and merges small ones."""
    if ts_col is not None:
        df = df.withColumn(date_col, F.to_date(ts_col))
    df.hint("rebalance", date_col).write.mode("overwrite").partitionBy(date_col).parquet(path)
    return df.sparkSession.read.parquet(path)


def compact_files(df: DataFrame, path: str, target_bytes: int = 128 * 1024 * 1024) -> DataFrame:
    """A10: fewer, larger files, without a shuffle of the rows. The rows are written as they come, and the files read
    back in splits of about ``target_bytes`` (small files together, large ones in parts), each of which is a new file."""
    spark = df.sparkSession
    packing = {"spark.sql.files.maxPartitionBytes": str(target_bytes), "spark.sql.files.openCostInBytes": "0",
               "spark.sql.files.minPartitionNum": "1"}
    loose = written(df, "loose")
    prev = {k: spark.conf.get(k, None) for k in packing}
    try:
        for k, v in packing.items():
            spark.conf.set(k, v)
        loose.write.mode("overwrite").parquet(path)
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.parquet(path)
