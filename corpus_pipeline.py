"""A training-corpus pipeline: quality rules, near-dedup, secret redaction, source mixing, tokens.

``STAGES`` lists (name, function) in order; a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, minhash, mixing, quality, secretscan
from millrace.llm.common import SPACE_CLASS, fresh_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REST = ("text", "lang", "n_chars")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs, carry=REST).withColumnRenamed("host", "source").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id; of rows that repeat an id
    and a text, one row stays."""
    kept = minhash.near_duplicates(docs, with_text_key=True).where("kept").select(F.col("doc_id").alias("kept_id"), "text_key").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (minhash.text_key() == F.col("text_key"))
    return (docs.join(kept.hint("merge"), same, "left_semi")
            .withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"]).select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are cut out of the texts; a NULL text stays NULL. No document goes."""
    found = secretscan.find_secrets(docs, carry=("text", "lang", "source", "n_chars"))
    text = F.when(F.size("spans") > 0, secretscan.redact(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    return found.select("doc_id", text.alias("text"), "lang", "source",
                        F.when(F.size("spans") > 0, F.length(text).cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; the partial repetition at a source's edge holds the
    document's first words."""
    mixed = mixing.mix(docs, carry=("text", "lang", "source", "n_chars")).where("taken > 0")
    rest = F.col("taken") % F.col("size")
    pattern = F.concat(F.lit(f"^(?:[{SPACE_CLASS}]*+[^{SPACE_CLASS}]++){{"), rest.cast("string"), F.lit("}+"))
    first_words = F.when(rest > 0, F.regexp_extract_all("text", pattern, F.lit(0))[0])
    # One entry a repetition: NULL for the whole text, else the first words of it.
    copies = F.concat(F.array_repeat(F.lit(None).cast("string"), F.floor(F.col("taken") / F.col("size")).cast("int")),
                      F.when(rest > 0, F.array(first_words)).otherwise(F.array().cast("array<string>")))
    repeated = mixed.select(*COLUMNS, F.explode(copies).alias("_part"))
    return repeated.withColumns({"text": F.coalesce("_part", "text"),
                                 "n_chars": F.when(F.col("_part").isNull(), F.col("n_chars")).otherwise(F.length("_part").cast("bigint"))}).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the BPE ids."""
    encoded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), carry=("source",))
    return encoded.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", drop_low_quality),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode_tokens),
]

#: Near-duplicate components and BPE cannot be stated in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
