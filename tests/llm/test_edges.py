"""Every operator on awkward rows and on an empty table: NULLs in any column, empty, blank and long texts,
repeated rows, equal ids, and further columns whose names clash with the operators' own."""

import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, fingerprint, htmltree, mixing, minhash, pii, quality, secretscan, substring, tokencount
import corpus_pipeline
import public_tokenizers as P

LONG = "word " * 30000 + "1 2 3 4 " * 3000 + "x" * 50000
ROWS = [
    (1, "a b c d e f g", "en", "s1", 13), (1, "a b c d e f g", "en", "s1", 13), (1, "other text with the same id", "en", "s1", 27),
    (2, None, None, None, None), (3, "", "en", "s1", 0), (4, " \n\t ", "en", None, 4), (None, "no id here", "en", "s2", 10),
    (None, None, None, None, None), (5, LONG, "en", "s3", len(LONG)), (6, LONG + " y", "en", "s3", None),
    (7, "token = \"abcdef123456\" password:hunter22 mail a@b.co 4111 1111 1111 1111 +1 234 567 8901 from 10.0.0.1", "en", "s2", 1),
    (8, "é中😀 \u0000 \x1c <|endoftext|> <b>&amp;", "xx", "", 5),
]
CLASH = ["host", "source_size", "id", "key", "n", "sig", "doc", "tag", "place", "gram", "bucket", "role", "spans", "taken", "target",
         "size", "ids", "kept", "component", "pivot", "part", "ordinal", "path", "value", "start", "end", "kind", "page_id", "_row", "_t"]

OPS = {
    "near": lambda d: minhash.near_duplicates(d),
    "substring": lambda d: substring.remove_repeats(d),
    "html": lambda d: htmltree.extract(d, id_col="doc_id", url_col="source", html_col="text"),
    "secrets": lambda d: secretscan.secret_digest(secretscan.find_secrets(d)),
    "quality": lambda d: quality.judge(d),
    "mix": lambda d: mixing.mix(d),
    "tokens": lambda d: tokencount.document_tokens(d, P.path("piece_bpe_32k.model")),
    "bpe": lambda d: bpe.digest(d, P.path("word_bpe_49k.json")),
    "pii": lambda d: pii.pii_digest(pii.find_pii(d)),
    "fingerprint": lambda d: fingerprint.fingerprints(d),
}


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("awkward") / "documents.parquet")
    d = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    d.withColumns({c: F.lit(7) for c in CLASH}).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("op", sorted(OPS))
def test_awkward_rows(awkward, op):
    out = OPS[op](awkward).collect()
    assert len(out) == len(ROWS)
    ids = [r["page_id" if op == "html" else "doc_id"] for r in out]
    assert sorted(map(str, ids)) == sorted(str(r[0]) for r in ROWS)
    assert all(v is not None for r in out for k, v in r.asDict().items() if k not in ("doc_id", "page_id", "url", "host", "component_id"))


@pytest.mark.parametrize("op", sorted(OPS))
def test_empty_table(awkward, op):
    empty = awkward.where("doc_id = -1")
    full = OPS[op](awkward)
    out = OPS[op](empty)
    assert out.columns == full.columns and out.count() == 0


def test_defined_results(awkward):
    near = {(r.doc_id, r.n_shingles): r for r in OPS["near"](awkward).collect()}
    assert near[2, 0].kept and near[3, 0].component_id == 3 and near[4, 0].component_id == 4
    # The two long texts differ by one shingle at the end.
    assert {r.component_id for r in near.values() if r.doc_id in (5, 6)} == {5}
    cut = {(r.doc_id, r.n_bytes): r for r in OPS["substring"](awkward).collect()}
    assert cut[6, len(LONG) + 2].n_removed == len(LONG) and cut[2, 0].n_removed == 0
    text = {r.doc_id: r for r in OPS["pii"](awkward).collect()}[7]
    assert (text.n_email, text.n_ip, text.n_card, text.n_phone) == (1, 1, 1, 1)
    secret = {r.doc_id: r for r in OPS["secrets"](awkward).collect()}[7]
    assert secret.n_assign == 2
    finger = OPS["fingerprint"](awkward).collect()
    assert len({r.fingerprint for r in finger if r.n_chars == 0}) == 1
    tokens = {r.doc_id: r.n_tokens for r in OPS["tokens"](awkward).collect() if r.doc_id in (2, 3)}
    assert tokens == {2: 0, 3: 0}


def test_pipeline_on_awkward_rows(spark, awkward):
    docs = awkward.select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
        docs.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert docs.count() >= 0
