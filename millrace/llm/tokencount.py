"""Token counts by separator scan over flat, unindexed token files.

A token file is a run of little-endian 16-bit ids in which one id ends every document. The files
are cut into blocks; each block is searched for the separator with one vector comparison; a prefix
scan over the block summaries of a file gives every block the tokens carried in from before and the
number of documents before it, so documents of any length are stitched across blocks.

Defined cases: NULL or empty text is a document of no tokens (a separator alone); tokens after the
last separator of a file are a last, unterminated document; an empty file holds no documents;
an empty table gives an empty result; a file of an odd number of bytes is an error; further columns
of the input do not matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, ship_code, text_or_empty, written

TOKEN = np.dtype("<u2")
#: Bytes of a block; a multiple of the token size.
BLOCK_BYTES = 4 << 20


def write_token_files(docs: DataFrame, model_path: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text with the SentencePiece model and write flat token files, one per task, each document ended by
    the end-of-document id (</s>). Returns file, ordinal, doc_id: the documents of each file in order, as the same task
    lists them. Spark writes this list; a file is named by its task attempt and belongs to the result only if the list
    names it, so a lost or repeated task leaves at most a file that nobody reads."""
    import sentencepiece
    spark = docs.sparkSession
    ship_code(spark)
    eod = sentencepiece.SentencePieceProcessor(model_file=model_path).eos_id()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        name, out, n = f"{uuid.uuid4().hex}.bin", None, 0
        try:
            for b in batches:
                if out is None and len(b):
                    store, folder = fs.FileSystem.from_uri(path)
                    store.create_dir(folder, recursive=True)
                    out = store.open_output_stream(f"{folder}/{name}")
                texts = b.column("text").to_pylist()
                for at in range(0, len(texts), 500):  # bounds the ids held at once
                    for ids in model.encode(texts[at:at + 500], num_threads=1):
                        if eod in ids:
                            raise ValueError("a text holds the end-of-document id")
                        out.write(np.array([*ids, eod], dtype=TOKEN).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(b), pa.string()), pa.array(np.arange(n, n + len(b))), b.column("doc_id")],
                                                 names=["file", "ordinal", "doc_id"])
                n += len(b)
        finally:
            if out is not None:
                out.close()

    listed = rows.mapInArrow(encode, f"file string, ordinal bigint, doc_id {rows.schema['doc_id'].dataType.simpleString()}")
    return written(listed, "token-list")


def scan_blocks(spark: SparkSession, path: str, eod: int, block_bytes: int = BLOCK_BYTES, listed: DataFrame | None = None) -> DataFrame:
    """Per block: path, offset, n_tokens, n_sep, head (tokens before the first separator), tail
    (after the last) and ``inner``, the lengths of the documents that lie between two separators. Of the files under
    ``path``; with ``listed`` only of those whose names it holds in ``file``."""
    ship_code(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").where("length > 0")
    if listed is not None:
        files = files.join(listed.select("file").distinct(), F.substring_index("path", "/", -1) == F.col("file"), "left_semi")
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(block_bytes).cast("bigint"))).alias("offset"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        for b in batches:
            for p, length, offset in zip(b["path"], b["length"], b["offset"]):
                if length % TOKEN.itemsize:
                    raise ValueError(f"{p}: {length} bytes are not whole tokens")
                store, name = fs.FileSystem.from_uri(p)
                with store.open_input_file(name) as f:
                    f.seek(offset)
                    tokens = np.frombuffer(f.read(block_bytes), dtype=TOKEN)
                at = np.flatnonzero(tokens == eod)
                yield pd.DataFrame({
                    "path": [p], "offset": [offset], "n_tokens": [len(tokens)], "n_sep": [len(at)],
                    "head": [int(at[0]) if len(at) else len(tokens)],
                    "tail": [int(len(tokens) - 1 - at[-1]) if len(at) else len(tokens)],
                    "inner": [(np.diff(at) - 1).astype(np.int64)]})

    return blocks.repartition(n, "path", "offset").mapInPandas(
        scan, "path string, offset bigint, n_tokens bigint, n_sep bigint, head bigint, tail bigint, inner array<bigint>")


def stitch(blocks: DataFrame) -> DataFrame:
    """path, ordinal (of the document in its file), n_tokens, from written block summaries."""
    in_file = Window.partitionBy("path").orderBy("offset")  # the blocks of one file
    upto = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    marked = blocks.withColumns({
        "run": F.sum(F.when(F.col("n_sep") > 0, 1).otherwise(0)).over(upto),
        "first": F.coalesce(F.sum("n_sep").over(before), F.lit(0))})
    # A run is a block with separators and the blocks without one that follow it: what they leave open.
    left = marked.groupBy("path", "run").agg(F.sum("tail").alias("open"), F.max(F.col("first") + F.col("n_sep")).alias("ordinal"))
    carried = left.select("path", (F.col("run") + 1).alias("run"), F.col("open").alias("carry"))
    ended = (marked.where("n_sep > 0").join(carried, ["path", "run"], "left")
             .select("path", "first", F.posexplode(F.concat(F.array(F.coalesce("carry", F.lit(0)) + F.col("head")), F.col("inner"))).alias("k", "n_tokens"))
             .select("path", (F.col("first") + F.col("k")).alias("ordinal"), "n_tokens"))
    last = left.withColumn("top", F.max("run").over(Window.partitionBy("path"))).where("run = top and open > 0")
    return ended.unionByName(last.select("path", "ordinal", F.col("open").alias("n_tokens")))


def count_tokens(spark: SparkSession, path: str, eod: int, block_bytes: int = BLOCK_BYTES, listed: DataFrame | None = None) -> DataFrame:
    """path, ordinal, n_tokens of every document in the token files under ``path``."""
    return stitch(written(scan_blocks(spark, path, eod, block_bytes, listed), "token-blocks"))


def document_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens: the texts as token files, scanned. The files hold no ids: the n-th document of a file has the
    id that its writing task listed n-th. A listed document that the scan does not find, or the other way round, is an
    error."""
    import sentencepiece
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    listed = write_token_files(docs, model_path, path, id_col, text_col)
    if listed.isEmpty():
        return listed.select("doc_id", F.lit(0).cast("bigint").alias("n_tokens"))
    counts = count_tokens(spark, path, sentencepiece.SentencePieceProcessor(model_file=model_path).eos_id(), block_bytes, listed)
    counts = counts.select(F.substring_index("path", "/", -1).alias("file"), "ordinal", "n_tokens", F.lit(True).alias("_scanned"))
    both = listed.withColumn("_listed", F.lit(True)).join(counts, ["file", "ordinal"], "full")
    lost = F.when(F.col("_scanned").isNull() | F.col("_listed").isNull(), F.raise_error(F.lit("token files and their list disagree")).cast("bigint"))
    return both.select("doc_id", F.coalesce(lost, F.col("n_tokens")).alias("n_tokens"))
