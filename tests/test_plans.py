"""Physical-plan assertions: pushdown, pruning, broadcast of fixed
dimensions only, partial top-k, no Python in the scoring path."""

import __spark_entry__ as E

from conftest import SF_CHECK

Q = E.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def joins(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_track_shipments_pushes_the_date_filter_into_the_scan(spark):
    p = plan(Q["track_shipments"](spark, SF_CHECK))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p


def test_usage_prunes_columns_and_pushes_dates(spark):
    p = plan(Q["part_usage_rate"](spark, SF_CHECK))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p
    assert "GreaterThanOrEqual(o_orderdate" in p


def test_builders_join_only_what_is_asked_for(spark):
    assert joins(Q["part_usage_rate"](spark, SF_CHECK)) == 1  # lineitem and orders
    assert joins(Q["supplier_scorecard"](spark, SF_CHECK)) == 2  # nation for the supplier's city; suppliers and their deliveries
    assert joins(Q["upsell_score"](spark, SF_CHECK)) == 1
    assert joins(Q["dq_unique_keys"](spark, SF_CHECK)) == 1  # nation, in the supplier builder


def test_checks_join_only_what_their_rules_read(spark):
    most = {"table_row_counts": 2, "dq_id_format": 1, "dq_enums": 2, "dq_ranges": 5, "dq_business_rules": 3}
    got = {k: joins(Q[k](spark, SF_CHECK)) for k in most}
    assert all(got[k] <= n for k, n in most.items()), got


def test_scoring_paths_have_no_python(spark):
    for k in ["predict_shortage", "predict_churn", "create_purchase_orders", "lookup_customer", "inventory_status",
              "track_shipments", "reorder_list", "sales_kpis", "customer_360"]:
        p = plan(Q[k](spark, SF_CHECK))
        assert "EvalPython" not in p and "PythonUDF" not in p, k


def test_top_k_uses_partial_window_group_limit(spark):
    p = plan(Q["keyword_search"](spark, SF_CHECK))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_only_fixed_dimensions_are_hinted_for_broadcast(spark):
    df = Q["build_transactions"](spark, SF_CHECK)
    logical = df._jdf.queryExecution().logical().toString()
    # the only broadcast hints are on nation and region (25 and 5 rows by definition)
    assert logical.count("ResolvedHint (strategy=broadcast)") == 2


def test_kpi_top1_is_an_aggregate_not_a_window(spark):
    p = plan(Q["equipment_status"](spark, SF_CHECK))
    assert "Window" not in p


def test_clustering_returns_and_checks_its_z_value(spark):
    import __spark_entry__ as E
    assert "z_value" in E.oracle_sql()["cluster_by_keys"]
    found = Q["cluster_by_keys"](spark, SF_CHECK)
    assert found.columns[-1] == "z_value"
    # 31 bits a column: every part and warehouse has a code of its own
    assert found.select("z_value").distinct().count() == found.count()


def test_part_terms_sort_no_inventory_rows(spark):
    """Terms of parts are hashed in the scan's task, which holds five rows a part; sorted aggregates would sort them all."""
    from millrace.plans.q_lookup import part_terms
    from millrace.plans.queries import Ctx
    found = part_terms(Ctx(spark, SF_CHECK))
    p = plan(found)
    assert "HashAggregate" in p and "Sort" not in p
    assert found.count() == found.select("part_id").distinct().count() == Ctx(spark, SF_CHECK).part.count()
    assert "SortAggregate" not in plan(Q["create_purchase_orders"](spark, SF_CHECK))
    # Rows above their reorder level are dropped in both scans of inventory, before any join.
    optimized = Q["create_purchase_orders"](spark, SF_CHECK)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Filter" in line and "1001" in line and "<=" in line for line in optimized.split("\n")) == 2
