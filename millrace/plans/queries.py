"""Registered queries: each key of SURVEY §2 as ``(spark, sf_dir) -> DataFrame``.

A query builds the domain tables it needs from the driver tables (lazily, as one
plan) and applies the library operator. Parameters that are part of a query's
definition (as-of dates, windows, k) are fixed here and repeated in the oracle.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.retrieval import VectorIndex, build_vector_index
from ..operators.textsearch import TextIndex, shared_index
from ..session import shared
from ..sources.tables import Tables
from . import builders as B

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


class Ctx:
    """Per-call accessor for driver tables and built domain tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.t = Tables(spark, sf_dir)
        self._built: dict[str, DataFrame] = {}

    def only(self, name: str, *columns: str) -> DataFrame:
        """Some columns of a domain table, built with only the joins that these need."""
        build = B.BUILDERS[name]
        return (build(self.t, want=set(columns)) if name in B.PRUNED else build(self.t)).select(*columns)

    def text_index(self, table: str, id_col: str, text_col: str, **options) -> TextIndex:
        """The search index of a table's texts, shared by the queries of an application."""
        return shared_index(getattr(self, table), id_col, text_col, name=f"{self.sf_dir}/{table}", **options)

    def vector_index(self, table: str, id_col: str, vec_col: str, meta_cols: list) -> VectorIndex:
        """The stored cell index of a table's vectors, shared by the queries of an application."""
        df = getattr(self, table)
        return shared(df, ("vectors", f"{self.sf_dir}/{table}", id_col, vec_col, *meta_cols), lambda: build_vector_index(df, id_col, vec_col, meta_cols))

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        if name in B.BUILDERS:
            if name not in self._built:
                self._built[name] = B.BUILDERS[name](self.t)
            return self._built[name]
        return getattr(self.t, name)


# Builders are registered queries too.
for _name, _key in [("suppliers", "build_suppliers"), ("inventory", "build_inventory"),
                    ("shipments", "build_shipments"), ("customers", "build_customers"),
                    ("transactions", "build_transactions"), ("telemetry", "build_telemetry"),
                    ("tickets", "build_tickets"), ("standard_operating_procedures", "build_sops"),
                    ("incident_reports", "build_incidents"), ("sales_proposals", "build_proposals"),
                    ("support_tickets", "build_support_tickets")]:
    QUERIES[_key] = (lambda n: lambda spark, sf: getattr(Ctx(spark, sf), n))(_name)
