"""Properties and brute-force cross-checks on small fixtures."""

import datetime as dt
import random

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import evaluation as EV
from millrace.operators import governance as I
from millrace.operators import kpi as G
from millrace.operators import layout as A
from millrace.operators import quality as J
from millrace.operators import retrieval as D
from millrace.operators.textmatch import contains_join
from millrace.session import scratch_path

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=25,
                unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(0, 30), st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=25,
                unique_by=lambda t: t[0]))
def test_change_feed_applied_to_v1_gives_v2(spark, v1, v2):
    a = spark.createDataFrame(v1, "k int, x int, y int")
    b = spark.createDataFrame(v2, "k int, x int, y int")
    ch = A.change_feed(a, b, "k").collect()
    state = {k: (x, y) for k, x, y in v1}
    for r in ch:
        if r._change_type in ("delete", "update_preimage"):
            assert state.pop(r.k) == (r.x, r.y)
    for r in ch:
        if r._change_type in ("insert", "update_postimage"):
            state[r.k] = (r.x, r.y)
    assert state == {k: (x, y) for k, x, y in v2}


def test_layout_jobs_preserve_the_bag(spark):
    rows = [(i, i % 7, (i * 13) % 11) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    z = A.cluster_by_keys(df, ["a", "b"], scratch_path(spark, "t-z"))
    assert sorted(z.select("id", "a", "b").collect()) == sorted(df.collect())
    # One extreme value: a point lookup still overlaps few ranges of the order.
    far = spark.createDataFrame([(i, i * 7919 % 1000, i * 104729 % 1000) for i in range(4000)] + [(4000, 2**30, 2**30), (4001, None, 5)], df.schema)
    keyed = A.cluster_by_keys(far, ["a", "b"], scratch_path(spark, "t-far")).select("a", "b", "z_value").orderBy("z_value", "a", "b").collect()
    files = [keyed[k:k + 63] for k in range(0, len(keyed), 63)]
    hit = [sum(min(r.a or 0 for r in f) <= x <= max(r.a or 0 for r in f) for f in files) for x in (3, 250, 777)]
    assert len(files) > 60 and max(hit) <= len(files) // 4
    from millrace.sources.sinks import compact_files
    c = compact_files(df.repartition(20), scratch_path(spark, "t-compact"), target_bytes=1 << 20)
    assert sorted(c.collect()) == sorted(df.collect())


def test_a_lookup_passes_on_the_first_rows_of_a_batch_only(spark):
    """The lowest stock of a query, with ties, NULLs and repeated rows, is that of all pairs; few rows reach the sort."""
    from millrace.operators import lookup as L
    rng = random.Random(4)
    rows = [(f"i{rng.randrange(900):03}", f"p{k % 7}", rng.choice(["red bolt", "red ring", "big bolt", None]), "w", "loc", rng.choice([None, *range(200)]), 50) for k in range(5000)]
    names = ["inventory_id", "part_id", "part_name", "warehouse_id", "warehouse_location", "current_quantity", "reorder_level"]
    kinds = ["string"] * 5 + ["int"] * 2
    inv = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds))).coalesce(2)
    for targets in (inv, inv.where("current_quantity IS NOT NULL")):
        queries = spark.createDataFrame([("bolt",), ("red",), ("ring",), ("nut",)], "part_query string")
        held = [r for r in rows if targets is inv or r[5] is not None]
        got = {r.part_query: (r.inventory_id, r.part_id) for r in L.inventory_status(queries, targets).collect()}
        low = lambda r: (r[5] is not None, r[5] or 0, r[0], r[1])
        want = {q: min((r for r in held if q in (r[2] or "")), key=low, default=(None, None)) for q in ("bolt", "red", "ring", "nut")}
        assert got == {q: (r[0], r[1]) for q, r in want.items()}
        pairs = contains_join(queries, "part_query", targets, "part_name")
        few = contains_join(queries, "part_query", targets, "part_name", first_by=["current_quantity", "inventory_id"])
        assert pairs.count() > 5000 and few.count() < 100


def test_compaction_shuffles_no_rows(spark, monkeypatch):
    """Many small files become few, and a large one several, of about the wanted size; the settings are as before."""
    from pyspark.sql.readwriter import DataFrameWriter
    from millrace.sources.sinks import compact_files
    plans, save = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (plans.append(w._df._jdf.queryExecution().executedPlan().toString()), save(w, *a, **k))[1])
    spark.conf.set("parquet.block.size", str(1 << 18))
    try:
        big = spark.range(0, 400_000, 1, 1).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
        small = spark.range(400_000, 400_600, 1, 30).select(F.col("id"), F.lit("x").alias("h"))
        conf = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
        c = compact_files(big.union(small), scratch_path(spark, "t-packed"), target_bytes=4 << 20)
    finally:
        spark.conf.unset("parquet.block.size")
    assert plans and not any("Exchange" in p or "RoundRobin" in p for p in plans)
    assert c.count() == c.select("id").distinct().count() == 400_600
    size = sum(f.stat().st_size for f in map(__import__("pathlib").Path, (f.removeprefix("file://") for f in c.inputFiles())))
    assert size > 20 << 20 and size // (4 << 20) <= len(c.inputFiles()) <= 2 * size // (4 << 20) + 1
    assert conf == {k: spark.conf.get(k, None) for k in conf}


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([(i, 1, "upsert", i % 3) for i in range(10)], "id int, version int, op string, v int") \
        .drop("op")
    upd = spark.createDataFrame([(2, 2, "delete", 0), (3, 2, "upsert", 9), (11, 2, "upsert", 5)],
                                "id int, version int, op string, v int")
    once = D.upsert_vectors(base, upd)
    twice = D.upsert_vectors(once, upd)
    assert sorted(once.collect()) == sorted(twice.collect())
    got = {r.id: r.v for r in once.collect()}
    assert 2 not in got and got[3] == 9 and got[11] == 5 and len(got) == 10


def test_tenant_rows_and_complement_cover_everything(spark):
    rows = spark.createDataFrame([(i, ["A", "B", "C", None][i % 4]) for i in range(40)], "rid int, tenant string")
    ent = spark.createDataFrame([("p1", "A"), ("p1", "B"), ("p2", "C")], "principal string, tenant_id string")
    mine = I.tenant_rows(rows, ent, "tenant", principal="p1")
    rest = rows.join(mine, "rid", "left_anti")
    assert mine.count() + rest.count() == 40
    assert {r.tenant for r in mine.collect()} == {"A", "B"}
    vis = I.tenant_rows(rows, ent, "tenant").select("principal", "tenant", "rid")
    assert I.tenant_leaks(vis, ent, "tenant").count() == 0


def test_knn_ties_go_to_the_smaller_id_and_zero_vectors_are_left_out(spark):
    rows = [(i, [1.0, 0.0], "a") for i in range(50)] + [(60, [0.0, 0.0], "a"), (61, None, "b"), (62, [0.0, 1.0], None), (63, [0.0, 2.0], None)]
    ix = D.unit_vectors(spark.createDataFrame(rows, "vid long, v array<double>, label string"), "vid", "v", ["label"])
    q = ix.select(F.col("id").alias("query_id"), "vector", "label")
    got = {}
    for r in D.knn_exact(ix, q, k=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id))
    assert 60 not in got and 61 not in got and [i for _, i in sorted(got[49])] == [0, 1, 2]
    same = {(r.query_id, r.id) for r in D.knn_exact(ix, q, k=3, match_col="label").collect()}
    assert {(62, 62), (62, 63), (63, 62), (63, 63)} <= same and not any(i >= 60 for qid, i in same if qid < 50)


def test_knn_exact_equals_numpy(spark, monkeypatch):
    rng = np.random.default_rng(3)
    X = rng.standard_normal((120, 16))
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in X[i]]) for i in range(120)], "id long, vector array<double>")
    q = df.select(F.col("id").alias("query_id"), "vector")
    monkeypatch.setattr(D, "KNN_BLOCK", 50)  # several blocks on both sides
    got = D.knn_exact(df, q, k=5, exclude_self=True)
    S = X @ X.T
    np.fill_diagonal(S, -np.inf)
    want = {(i, int(j)) for i in range(120) for j in np.argsort(-S[i])[:5]}
    assert {(r.query_id, r.id) for r in got.collect()} == want


def clustered(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((60, 32))
    X = np.repeat(centres, 6, axis=0) + 0.15 * rng.standard_normal((360, 32))
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    return X, spark.createDataFrame([(i, [float(x) for x in X[i]]) for i in range(360)], "id long, vector array<double>")


def test_ann_finds_clustered_neighbours_among_few_candidates(spark):
    """On vectors with near neighbours: recall at least 0.9 with at most a fifth of all pairs scored."""
    X, df = clustered(spark)
    q = df.select(F.col("id").alias("query_id"), "vector")
    index = D.build_vector_index(df, "id", "vector", [], cells=40)
    assert index.rows.count() == 360 and index.centroids.shape == (40, 32)
    ann = D.ann_search(index, q, k=5, probes=3, exclude_self=True)
    assert D.recall_at_k(ann, D.knn_exact(df, q, k=5, exclude_self=True), 5).first().recall_at_k >= 0.9
    size = {r.bucket: r.n for r in index.rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    pairs = sum(size.get(int(c), 0) for row in D._nearest(X, index.centroids, 3) for c in row)
    assert pairs <= 0.2 * 360 * 360
    for r in ann.collect():
        assert abs(r.score - float(X[r.query_id] @ X[r.id])) < 1e-6


def test_ann_with_all_cells_is_exact_in_any_block_size(spark, monkeypatch):
    """A hot cell (a third of the rows are copies) is dealt into blocks; ties go to the smaller id."""
    X, df = clustered(spark)
    copies = spark.range(1000, 1180).select("id", F.array(*[F.lit(float(x)) for x in X[0]]).alias("vector"))
    df = df.unionByName(copies)
    q = df.where("id % 3 = 0").select(F.col("id").alias("query_id"), "vector")
    index = D.build_vector_index(df, "id", "vector", [], cells=8)
    exact = sorted(map(tuple, D.knn_exact(df, q, k=5, exclude_self=True).collect()))
    monkeypatch.setattr(D, "KNN_BLOCK", 50)
    assert sorted(map(tuple, D.ann_search(index, q, k=5, probes=8, exclude_self=True).collect())) == exact


def test_vector_index_of_no_rows_and_of_fewer_rows_than_cells(spark):
    _, df = clustered(spark)
    q = df.limit(3).select(F.col("id").alias("query_id"), "vector")
    none = D.build_vector_index(df.where("false"), "id", "vector", [])
    assert none.rows.count() == 0 and D.ann_search(none, q).collect() == []
    few = D.build_vector_index(df.where("id < 5"), "id", "vector", [])
    assert len(few.centroids) == 5 and D.ann_search(few, q, k=9).count() == 15


@SETTINGS
@given(st.lists(st.text(alphabet="abcxy", min_size=0, max_size=6), min_size=1, max_size=12),
       st.lists(st.text(alphabet="abcxy", min_size=0, max_size=12), min_size=1, max_size=20))
def test_contains_join_equals_brute_force(spark, qs, ts):
    q = spark.createDataFrame([(x,) for x in set(qs)], "q string")
    t = spark.createDataFrame(list(enumerate(ts)), "tid int, t string")
    got = {(r.q, r.tid) for r in contains_join(q, "q", t, "t").collect()}
    want = {(x, i) for x in set(qs) if x for i, y in enumerate(ts) if x in y}
    assert got == want


def test_asof_join_equals_brute_force(spark):
    random.seed(7)
    ships = [("S%d" % i, "P%d" % random.randint(0, 3), dt.date(2020, 1, 1) + dt.timedelta(days=random.randint(0, 60)))
             for i in range(40)]
    txs = [("T%d" % i, "P%d" % random.randint(0, 4), dt.datetime(2020, 1, 1) + dt.timedelta(hours=random.randint(0, 1500)))
           for i in range(60)]
    s = spark.createDataFrame(ships, "shipment_id string, part_id string, shipment_date date")
    t = spark.createDataFrame(txs, "transaction_id string, product_id string, transaction_date timestamp")
    got = {r.transaction_id: r.last_shipment_id for r in G.asof_stock_at_order(t, s).collect()}
    for tid, pid, ts in txs:
        cands = [(d, sid) for sid, p, d in ships if p == pid and d <= ts.date()]
        assert got[tid] == (max(cands)[1] if cands else None)


def test_peak_concurrency_equals_brute_force(spark):
    random.seed(11)
    base = dt.datetime(2024, 1, 1)
    spans = [(i, base + dt.timedelta(seconds=random.randint(0, 600)), random.randint(1, 120_000)) for i in range(200)]
    df = spark.createDataFrame(spans, "span_id int, start timestamp, duration_ms long")
    # One instant holds a third of all starts, one minute most of the spans; ranges of a few instants each.
    hot = [(1000 + i, base + dt.timedelta(seconds=300), 500) for i in range(100)] + [(2000, None, 5), (2001, base, None)]
    df = df.unionByName(spark.createDataFrame(hot, df.schema))
    spans += hot[:100] + [(2001, base, 10**12)]
    r = EV.peak_concurrency(df, ranges=37).first()
    assert EV.peak_concurrency(df, ranges=1).first() == r
    assert EV.peak_concurrency(df.where("false")).first().peak_concurrency is None
    pts = []
    for _, s, d in spans:
        t = int((s - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
        pts += [(t, 1), (t + d * 1000, -1)]
    level = best = 0
    for _, dlt in sorted(pts):
        level += dlt
        best = max(best, level)
    assert r.peak_concurrency == best


def test_reallocation_never_exceeds_surplus_or_deficit(spark):
    rows = [("P%d" % (i % 9), "W%d" % (i % 5), (i * 37) % 400, 50 + (i * 11) % 100) for i in range(45)]
    inv = spark.createDataFrame(rows, "part_id string, warehouse_id string, current_quantity int, reorder_level int")
    out = G.reallocate_stock(inv).collect()
    stock = {(p, w): (q, l) for p, w, q, l in rows}
    sent, got = {}, {}
    for r in out:
        assert r.transfer_qty > 0
        sent[(r.part_id, r.from_warehouse)] = sent.get((r.part_id, r.from_warehouse), 0) + r.transfer_qty
        got[(r.part_id, r.to_warehouse)] = got.get((r.part_id, r.to_warehouse), 0) + r.transfer_qty
    for k, v in sent.items():
        assert v <= stock[k][0] - 2 * stock[k][1]
    for k, v in got.items():
        assert v <= stock[k][1] - stock[k][0]
    # greedy fill: a part is fully served or its surplus is exhausted
    for p in {k[0] for k in stock}:
        need = sum(max(0, l - q) for (pp, _), (q, l) in stock.items() if pp == p)
        have = sum(max(0, q - 2 * l) for (pp, _), (q, l) in stock.items() if pp == p)
        moved = sum(v for (pp, _), v in got.items() if pp == p)
        assert moved == min(need, have)


def test_quality_checks_report_exactly_the_seeded_faults(spark):
    from millrace.plans.builders import suppliers
    from millrace.sources.tables import Tables
    good = suppliers(Tables(spark, "/root/testdata/sf0.001"))
    bad = good.limit(3).withColumn("rating", F.lit(9.9)).withColumn("status", F.lit("BROKEN")) \
        .withColumn("supplier_id", F.concat(F.lit("XX"), F.col("supplier_id")))
    t = {"suppliers": good.unionByName(bad)}
    ranges = {r.rule: r.failed_rows for r in J.ranges(t).collect()}
    enums = {r.rule: r.failed_rows for r in J.enums(t).collect()}
    ids = {r.rule: r.failed_rows for r in J.id_format(t).collect()}
    assert ranges["rating_3_to_5"] == 3 and ranges["lead_time_ge_3"] == 0
    assert enums["enum:status"] == 3
    assert ids["id_format:supplier_id"] == 3
    dup = {r.rule: r.failed_rows for r in J.unique_keys({"suppliers": good.unionByName(good.limit(2))}).collect()}
    assert dup["unique:supplier_id"] == 4


def test_knn_in_steps_of_bounded_scores_equals_numpy(spark, monkeypatch):
    rng = np.random.default_rng(8)
    X = rng.standard_normal((150, 8))
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in X[i]]) for i in range(150)], "id long, vector array<double>")
    assert D.KNN_BLOCK >= 1 << 16  # a row is shuffled once a block of the other side
    monkeypatch.setattr(D, "KNN_SCORES", 64)
    S = X @ X.T
    np.fill_diagonal(S, -np.inf)
    got = D.knn_exact(df, df.select(F.col("id").alias("query_id"), "vector"), k=4, exclude_self=True)
    assert {(r.query_id, r.id) for r in got.collect()} == {(i, int(j)) for i in range(150) for j in np.argsort(-S[i])[:4]}


def test_cells_sort_little_more_than_their_sample(spark, monkeypatch):
    import hashlib
    X, df = clustered(spark)
    monkeypatch.setattr(D, "TRAIN_ROWS", 20)
    monkeypatch.setattr(D, "TRAIN_ROUNDS", 0)
    sorted_rows, limit = [], type(df).limit
    monkeypatch.setattr(type(df), "limit", lambda self, n: sorted_rows.append(self.count()) or limit(self, n))
    found = D.train_cells(df, 20)
    first = sorted(range(360), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:20]
    assert np.allclose(found, X[first], atol=1e-6)
    assert 20 <= max(sorted_rows) <= 25


def test_single_precision_only_rules_pairs_out(monkeypatch):
    """Near ties, repeated ids and vectors of other lengths: the same rows as in double precision, few pairs of which are
    scored twice."""
    import pyarrow as pa
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 64))
    x[2000:] = x[:2000] + rng.normal(size=(2000, 64)) * 1e-9  # further apart than nine decimals, nearer than floats
    x /= np.sqrt((x * x).sum(axis=1))[:, None] / rng.choice([1.0, 3.0], 4000)[:, None]
    ids = rng.permutation(4000).astype(np.int64)
    ids[:20] = ids[20]  # a query has all rows of its id left out
    lists = lambda m: pa.chunked_array([pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * 64, m.ravel())])
    exact, counted = D._exact, []
    monkeypatch.setattr(D, "_exact", lambda q, x, row, col: counted.append(len(row)) or exact(q, x, row, col))
    got = D._block_topk(5, True)(pa.table({"id": ids, "vector": lists(x)}), pa.table({"query_id": ids[20:320], "vector": lists(x[20:320])}))
    s = np.round(x[20:320] @ x.T, 9)
    s[ids[20:320, None] == ids[None, :]] = -np.inf
    want = [(int(ids[20 + i]), int(ids[j]), s[i, j]) for i in range(300) for j in np.lexsort((ids, -s[i]))[:5]]
    rows = sorted(zip(got["query_id"].to_pylist(), got["id"].to_pylist(), got["score"].to_pylist()))
    want.sort()
    assert [r[0] for r in rows] == [w[0] for w in want]
    assert sum(r[:2] == w[:2] for r, w in zip(rows, want)) >= 0.99 * len(want)  # the last decimal of a product may differ
    assert max(abs(r[2] - w[2]) for r, w in zip(rows, want) if r[:2] == w[:2]) < 3e-9
    assert sum(counted) < 0.02 * 300 * 4000


def test_a_norm_is_computed_once_a_vector(spark):
    """Zero, NULL, empty and float vectors; the norm stands outside the function that is called for every element."""
    rows = [(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [None, 1.0])]
    df = spark.createDataFrame(rows, "id int, v array<float>").select("id", D.l2_normalize(F.col("v")).alias("u"))
    assert {r.id: r.u for r in df.collect()} == {1: [0.6, 0.8], 2: None, 3: None, 4: None, 5: None}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
