"""Reading the driver tables (A07 ``scan_table``).

Each table is read lazily with ``spark.read.parquet`` so Catalyst prunes columns
and pushes filters into the scan. ``timestamp_ntz`` columns are cast to
``timestamp`` (session time zone is pinned to UTC) because watermarks and the
domain schemas need ``TimestampType``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    casts = [F.col(f.name).cast("timestamp").alias(f.name)
             if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
             for f in df.schema.fields]
    return df.select(*casts)


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def scan_table(spark: SparkSession, name: str, sf_dir: str | None = None) -> DataFrame:
    """A named table from the catalog, or the driver file when ``sf_dir`` is given."""
    if sf_dir is not None:
        return read_table(spark, sf_dir, name)
    return spark.table(name)
