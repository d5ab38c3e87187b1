"""Texts with very many matches, and token counts on inputs that come out of a shuffle."""

import time

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, common, pii, secretscan, tokencount

MANY = 200_000


@pytest.mark.parametrize("group", [2, 3, 64])
def test_running_values(spark, monkeypatch, group):
    monkeypatch.setattr(common, "GROUP", group)
    arrays = [[], [5], [3, 1, 2], list(range(50, 0, -1)), [k * 7919 % 31 for k in range(100)]]
    d = spark.createDataFrame([(k, a) for k, a in enumerate(arrays)], "k int, a array<bigint>")
    rows = d.select("k", common.running(F.col("a"), lambda x, y: x + y).alias("s"), common.running(F.col("a"), lambda x, y: F.greatest(x, y)).alias("m")).collect()
    for r in rows:
        a = arrays[r.k]
        assert r.s == [sum(a[:i + 1]) for i in range(len(a))] and r.m == [max(a[:i + 1]) for i in range(len(a))]


def test_a_text_of_very_many_matches(spark):
    mails = " ".join(f"u{k}@b.co" for k in range(MANY))
    secrets = " ".join(f"token={k:08d}" for k in range(MANY))
    d = spark.createDataFrame([(1, mails, "a"), (2, secrets, "a")], "doc_id long, text string, source string").cache()
    d.count()
    t = time.time()
    found = {r.doc_id: r for r in pii.pii_digest(pii.find_pii(d)).select("doc_id", "n_email", F.length("spans").alias("n")).collect()}
    assert found[1].n_email == MANY and found[2].n_email == 0
    spans = secretscan.find_secrets(d, carry=("text",))
    got = spans.where("doc_id = 2").select(F.size("spans").alias("n"), secretscan.redact(F.col("text"), F.col("spans")).alias("t")).first()
    assert got.n == MANY and got.t == " ".join(["[secret]"] * MANY)
    assert time.time() - t < 120  # quadratic work would take hours


def test_redaction_merges_spans_and_keeps_other_scripts(spark):
    texts = ["aé😀bcdefgh", "abcdefghij", ""]
    spans = [[(1, 3), (2, 4), (4, 5), (7, 8)], [(0, 2), (2, 3), (5, 10)], []]
    d = spark.createDataFrame(list(zip(texts, spans)), "t string, s array<struct<start:bigint,end:bigint>>")
    got = [r[0] for r in d.select(secretscan.redact(F.col("t"), F.col("s"), "#")).collect()]
    assert got == ["a#" + texts[0][5:7] + "#" + texts[0][8:], "#de#", ""]


def test_opaque_spans_give_way_to_base_spans(spark):
    opaque = "Ab1" + "x" * 20
    rows = [(1, f"{opaque} token={opaque} {opaque}"), (2, f"AKIA{'A1' * 10}b{'c' * 9}"), (3, "0" * 30 + opaque)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secretscan.find_secrets(d).collect()}
    n = len(opaque)
    assert got[1] == [("opaque", 0, n), ("assign", n + 1, 2 * n + 7), ("opaque", 2 * n + 8, 3 * n + 8)]
    assert [k for k, *_ in got[2]] == ["access"]
    assert [k for k, *_ in got[3]] == ["hex"]


@pytest.mark.parametrize("how", ["plain", "repartition", "dedup", "sorted"])
def test_token_counts_of_shuffled_inputs(spark, how):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    rows = [(k if k % 50 else None, None if k % 41 == 0 else "word " * (k % 13) + f"text {k}") for k in range(1000)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    d = {"plain": d, "repartition": d.repartition(8), "dedup": d.dropDuplicates(["text", "doc_id"]), "sorted": d.orderBy("text")}[how]
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        got = sorted(map(tuple, tokencount.document_tokens(d, P.path("piece_bpe_32k.model")).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    keep = set(rows) if how == "dedup" else rows
    assert got == sorted(((i, len(model.encode(t or ""))) for i, t in keep), key=str)


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    d = spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id long, text string").coalesce(1)
    path = str(tmp_path / "tokens")
    listed = tokencount.write_token_files(d, P.path("piece_bpe_32k.model"), path)
    (tmp_path / "tokens" / "lost.bin").write_bytes(b"\x05\x00\x02\x00")
    assert tokencount.count_tokens(spark, path, 2, listed=listed).count() == 2
    assert tokencount.count_tokens(spark, path, 2).count() == 3


def test_word_counts_cover_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(bpe, "COUNTED_WORDS", 3)
    rows = [("The the, THE cat's 4 dogs-dogs",), (None,), ("",), ("École dogs " + "x" * 200,)]
    counts = bpe.word_counts(spark.createDataFrame(rows * 5, "text string").repartition(3)).groupBy("word").agg(F.sum("n").alias("n"))
    assert {r.word: r.n for r in counts.collect()} == {"the": 15, "cat": 5, "s": 5, "dogs": 15, "École": 5}


def test_pieces_end_at_blanks():
    raw = b"aa bb  cccccccccc d"
    cuts = list(bpe.spans_at_blanks(raw, 4))
    assert b"".join(raw[a:b] for a, b in cuts) == raw and [w for a, b in cuts for w in raw[a:b].split()] == raw.split()
