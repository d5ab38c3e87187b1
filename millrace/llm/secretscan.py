"""Secret scan with corpus-wide ownership frequency.

Patterns propose spans. Every proposed value is hashed, and the hashes are aggregated over the whole
corpus by distinct repository and owner. A value that many owners hold, or that stands in far more repositories
than its few owners would put a secret of theirs in, is a widely copied example; another value looks live. The base kinds (assign, access, hex) always stay in
the result; opaque tokens (mixed letters and digits) are added where they look live.

Defined cases: NULL text counts as empty; a NULL owner is an owner of its own; spans are code
points, end exclusive; repeated rows and equal ids each give a row; an empty table gives an empty
result; further columns of the input do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, regex_spans, running, sha256_hex, text_or_empty, written

# The stated patterns; possessive where a match cannot depend on giving characters back.
ASSIGN = (r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.=-]++")
ASSIGN_VALUE = r"^[A-Za-z_]+[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)$"
# A maximal run below the least length is never a match, so the length can be part of the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
OPAQUE = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"

BASE = ("assign", "access", "hex")
MIN_ASSIGN_CHARS = 6
#: A value held by this many owners or more is a widely copied example.
EXAMPLE_OWNERS = 3
#: A value in this many repositories an owner or more is one as well.
EXAMPLE_REPOS = 100


def propose(text: Column) -> Column:
    """array<struct<start,kind,end,value>> of base spans and opaque candidates, by start, then kind."""
    def of(kind: str, spans: Column, value) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), value(s["value"]).alias("value")))

    assign = F.filter(of("0assign", regex_spans(text, ASSIGN), lambda v: F.regexp_extract(v, ASSIGN_VALUE, 1)),
                      lambda s: F.length(s["value"]) >= MIN_ASSIGN_CHARS)
    access = of("1access", regex_spans(text, ACCESS), lambda v: v)
    hexes = of("2hex", regex_spans(text, HEX), lambda v: v)
    opaque = F.filter(of("3opaque", regex_spans(text, OPAQUE), lambda v: v),
                      lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]"))
    # The digit before the kind makes the listed order the sort order; it is cut off on output.
    return F.array_sort(F.concat(assign, access, hexes, opaque))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_col: str = "doc_id", example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per input row: doc_id, ``spans`` array<struct<start,kind,end,live>> (base spans and the
    opaque ones that look live, not overlapping a base span), and the ``carry`` columns.

    Only rows with a candidate are written and joined; the others pass by without a shuffle, at the price of a
    second scan. Candidate hashes are counted by partial sums, so a value that a third of the rows
    hold shrinks to one row per owner before it meets other rows.
    """
    proposed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(owner_col).alias("_owner"), F.col(repo_col).cast("string").alias("_repo"),
        propose(text_or_empty(text_col)).alias("_spans"), *[F.col(c).alias(f"_carry_{c}") for c in carry])
    some = written(proposed.where(F.size("_spans") > 0).withColumn("_row", F.monotonically_increasing_id()), "secrets")
    each = (some.select("_row", "_owner", "_repo", F.explode("_spans").alias("s"))
            .select("_row", "_owner", "_repo", "s.start", "s.kind", "s.end", F.sha2(F.col("s.value").cast("binary"), 256).alias("_hash")))
    ownership = (each.groupBy("_hash", "_owner", "_repo").agg(F.count(F.lit(1)).alias("_n"))
                 .groupBy("_hash", "_owner").agg(F.count(F.lit(1)).alias("_repos"))
                 .groupBy("_hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("_repos").alias("n_repos")))
    widely = ownership.where((F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos * F.col("n_owners"))).select("_hash", F.lit(True).alias("_example"))
    rated = each.join(widely, "_hash", "left").withColumn("live", F.col("_example").isNull())
    # An opaque span gives way to a base span that overlaps it: one that starts at or before it and ends in it or
    # later, or one that starts at or behind its start and before its end. Running values, so linear in a text's spans.
    is_base = F.col("kind").substr(1, 1) < "3"

    def upto(order):
        return Window.partitionBy("_row").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(F.when(is_base, F.col("end"))).over(upto(F.col("start").asc()))
    following = F.min(F.when(is_base, F.col("start"))).over(upto(F.col("start").desc()))
    taken = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False))
    kept = rated.withColumn("_taken", taken).where(is_base | (F.col("live") & ~F.col("_taken")))
    # By start, then the kind as listed: the digit before the kind.
    spans = F.transform(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live"))), lambda s: F.struct(
        s["start"].alias("start"), F.substring(s["kind"], 2, 20).alias("kind"), s["end"].alias("end"), s["live"].alias("live")))
    per_row = kept.groupBy("_row").agg(spans.alias("spans"))
    kept_columns = [F.col(f"_carry_{c}").alias(c) for c in carry]
    none = F.array().cast("array<struct<start:bigint,kind:string,end:bigint,live:boolean>>")
    found = some.join(per_row, "_row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"), *kept_columns)
    return proposed.where(F.size("_spans") == 0).select("doc_id", none.alias("spans"), *kept_columns).unionByName(found)


def _labels(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def secret_digest(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *[_count("spans", k).alias(f"n_{k}") for k in BASE],
        sha256_hex(_labels(base)).alias("base_sha256"), _labels(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("bigint").alias("n_example"))


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with the union of the spans replaced by ``mask``: the gaps between spans merged where they overlap or
    touch, joined by it. Linear in the text and the spans; where the text is not ASCII, finding each place in UTF-8
    costs a scan up to it."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def masked(cut) -> Column:
        def pieces(found: Column, ends: Column) -> Column:
            def piece(s: Column, k: Column) -> Column:
                at = F.when(k == 0, F.lit(0).cast("bigint")).otherwise(F.get(ends, k - 1))
                inside = (s["start"] < at) | ((s["start"] == at) & (at > 0))
                return F.when(inside, F.lit("")).otherwise(F.concat(cut(at, s["start"] - at), F.lit(mask)))
            last = F.element_at(ends, -1)
            return F.concat(F.array_join(F.transform(found, piece), ""), cut(last, F.length(text) - last))
        return let(ordered, lambda found: let(running(F.transform(found, lambda s: s["end"]), lambda x, y: F.greatest(x, y)), lambda ends: pieces(found, ends)))

    def part(value: Column):
        return lambda at, n: F.substring(value, (at + 1).cast("int"), n.cast("int")).cast("string")
    ascii_only = F.length(text) == F.octet_length(text)  # places in bytes are places in code points
    return F.when(F.size(spans) == 0, text).otherwise(
        F.when(ascii_only, let(text.cast("binary"), lambda raw: masked(part(raw)))).otherwise(masked(part(text))))
