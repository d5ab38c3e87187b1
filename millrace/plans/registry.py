"""Imports every query module so their keys register; exposes the full maps."""

from __future__ import annotations

import importlib

_QUERY_MODULES = ["q_scoring", "q_lookup", "q_kpi", "q_quality", "q_retrieval", "q_routing", "q_layout", "q_streams"]


def all_queries():
    for m in _QUERY_MODULES:
        importlib.import_module(f"millrace.plans.{m}")
    from .queries import QUERIES
    return dict(QUERIES)


def all_oracles():
    from oracle.queries import ORACLE
    for m in _QUERY_MODULES:
        try:
            importlib.import_module(f"oracle.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"oracle.{m}":
                raise
    return {k: bigint_count_if(v) for k, v in ORACLE.items()}


def bigint_count_if(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; Spark's returns BIGINT. Wrap every call in a cast."""
    out, i, name = [], 0, "count_if("
    while True:
        j = sql.find(name, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(name)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = bigint_count_if(sql[j + len(name):k - 1])
        out.append(sql[i:j] + "CAST(" + name + inner + ") AS BIGINT)")
        i = k
