"""Queries for §2.4 retrieval (D01–D14) and I04 permitted search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import densetext as DT
from ..operators import retrieval as D
from .queries import Ctx, query

K = 10
# Retriever presets (name, domain table, id column, text column, k).
PRESETS = [("sop", "standard_operating_procedures", "id", "procedure_text", 5),
           ("incidents", "incident_reports", "id", "incident_description", 3),
           ("proposals", "sales_proposals", "id", "proposal_content", 3),
           ("tickets", "support_tickets", "id", "ticket_content", 3)]
DOMAIN_RETRIEVERS = {"supply_chain": ["sop", "incidents"]}


def vindex(c: Ctx):
    return D.unit_vectors(c.embeddings, "vec_id", "embedding", ["label"])


def vqueries(ix):
    return ix.select(F.col("id").alias("query_id"), "vector", "label")


def user_queries(c: Ctx):
    """Every user message of every conversation is a query (whole text)."""
    return c.conversations.where(F.col("role") == "user").select(
        F.concat_ws("-", "conv_id", "turn").alias("query_id"), "conv_id", "text")


@query("embed_text")
def q_embed_text(spark, sf):
    return D.embed_text(Ctx(spark, sf).text_index("documents", "doc_id", "text", with_norm=True))


@query("embed_dense")
def q_embed_dense(spark, sf):
    """D01 as dense vectors, a row a dimension."""
    dense = DT.embed_dense(Ctx(spark, sf).text_index("documents", "doc_id", "text", with_norm=True))
    return dense.select("doc_id", F.posexplode("vector").alias("dim", "value"))


@query("build_vector_index")
def q_build_vector_index(spark, sf):
    c = Ctx(spark, sf)
    return c.vector_index("embeddings", "vec_id", "embedding", ["label"]).rows.select("id", "label", "bucket", "content_hash")


def vector_updates(c: Ctx):
    """Direct-access updates from the labels table: toxic documents are deleted, the others
    get their quality label attached (version 2)."""
    lb = c.labels.join(c.embeddings, c.labels.doc_id == c.embeddings.vec_id)
    v = D.l2_normalize(F.col("embedding"))
    return lb.select(F.col("doc_id").alias("id"), F.lit(2).alias("version"),
                     F.when(F.col("toxic") == 1, "delete").otherwise("upsert").alias("op"),
                     "label", F.col("quality").alias("quality"), v.alias("vector"))


def upserted(c: Ctx):
    base = vindex(c).select("id", F.lit(1).alias("version"), "label", F.lit(None).cast("int").alias("quality"), "vector")
    out = D.upsert_vectors(base, vector_updates(c))
    return out.withColumn("content_hash", D.content_hash(F.col("vector"), F.col("label"), F.col("quality")))


@query("upsert_vectors")
def q_upsert_vectors(spark, sf):
    return upserted(Ctx(spark, sf)).select("id", "label", "quality", "version", "content_hash")


@query("knn_exact")
def q_knn_exact(spark, sf):
    ix = vindex(Ctx(spark, sf))
    return D.knn_exact(ix, vqueries(ix), k=K, exclude_self=True)


@query("ann_search")
def q_ann_search(spark, sf):
    c = Ctx(spark, sf)
    return D.ann_search(c.vector_index("embeddings", "vec_id", "embedding", ["label"]), vqueries(vindex(c)), k=K, exclude_self=True)


@query("filtered_search")
def q_filtered_search(spark, sf):
    ix = vindex(Ctx(spark, sf))
    return D.knn_exact(ix, vqueries(ix), k=K, exclude_self=True, match_col="label")


@query("ann_recall")
def q_ann_recall(spark, sf):
    c = Ctx(spark, sf)
    ix = vindex(c)
    found = D.ann_search(c.vector_index("embeddings", "vec_id", "embedding", ["label"]), vqueries(ix), k=K, exclude_self=True)
    return D.recall_at_k(found, D.knn_exact(ix, vqueries(ix), k=K, exclude_self=True), K)


def kw(c: Ctx, k=K):
    return D.keyword_search(c.text_index("documents", "doc_id", "text"), user_queries(c), "query_id", "text", k)


@query("keyword_search")
def q_keyword_search(spark, sf):
    return kw(Ctx(spark, sf))


@query("hybrid_search")
def q_hybrid_search(spark, sf):
    c = Ctx(spark, sf)
    return D.hybrid_text_search(c.text_index("documents", "doc_id", "text", with_norm=True), user_queries(c), "query_id", "text", K)


@query("project_results")
def q_project_results(spark, sf):
    c = Ctx(spark, sf)
    return D.project_results(kw(c), c.documents, "doc_id", ["source", "lang", "n_chars"])


def preset_results(c: Ctx, names=None):
    out = None
    for name, table, id_col, text_col, k in PRESETS:
        if names and name not in names:
            continue
        r = D.keyword_search(c.text_index(table, id_col, text_col), user_queries(c), "query_id", "text", k) \
            .select(F.lit(name).alias("retriever"), "query_id", "rank", F.col("doc_id").alias("id"), "score")
        out = r if out is None else out.unionByName(r)
    return out


@query("retriever_presets")
def q_retriever_presets(spark, sf):
    return preset_results(Ctx(spark, sf))


@query("sync_index")
def q_sync_index(spark, sf):
    c = Ctx(spark, sf)
    return D.sync_index(vindex(c), upserted(c))


@query("search_domain")
def q_search_domain(spark, sf):
    c = Ctx(spark, sf)
    return D.search_domain([preset_results(c, DOMAIN_RETRIEVERS["supply_chain"])], k=5)


@query("search_no_result")
def q_search_no_result(spark, sf):
    c = Ctx(spark, sf)
    return D.no_result_queries(user_queries(c), "query_id", "text", c.documents, "text")


def permitted_sources(c: Ctx):
    """Entitlement rule: conversation n may read documents of sources src(n mod 20) and src((n+1) mod 20)."""
    return user_queries(c).select("query_id", F.explode(F.array(
        F.concat(F.lit("src"), F.pmod("conv_id", F.lit(20)).cast("string")),
        F.concat(F.lit("src"), F.pmod(F.col("conv_id") + 1, F.lit(20)).cast("string")))).alias("group"))


@query("permitted_search")
def q_permitted_search(spark, sf):
    c = Ctx(spark, sf)
    return D.keyword_search(c.text_index("documents", "doc_id", "text", group_col="source"), user_queries(c), "query_id", "text", K,
                            query_groups=permitted_sources(c))
