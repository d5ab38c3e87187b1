"""Shared helpers: the cluster's checkpoint folder, written intermediates, words and regex spans as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_code  # noqa: F401

#: A word is a maximal run of anything but these six ASCII white-space characters.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"

def fresh_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"llm-{name}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """array<string> of the words of a text, in order."""
    return F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable cannot be inlined by the optimizer."""
    return F.transform(F.array(value), body)[0]


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


SPAN = "struct<start:bigint,end:bigint,value:string,before:string,after:string>"


#: Elements of a group of a running value, and levels of groups: groups of groups hold 64^4 elements.
GROUP, LEVELS = 64, 3


def running(values: Column, op, kind: str = "bigint", levels: int = LEVELS) -> Column:
    """The running value of an associative ``op`` over an array of ``kind``: element k is op over elements 0 to k.

    Growing an array element by element copies it each time, which is quadratic; so that is done within groups, and the
    running value over the groups' ends, found in the same way, is added to each group."""
    def grown(a: Column) -> Column:
        none = F.array().cast(f"array<{kind}>")
        return F.aggregate(a, none, lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) == 0, x).otherwise(op(F.try_element_at(acc, F.size(acc)), x)))))

    def either(a: Column) -> Column:
        return F.when(F.size(a) <= GROUP, grown(a)).otherwise(let(
            F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / GROUP).cast("int")), lambda g: grown(F.slice(a, g * GROUP + 1, GROUP))), joined))

    def joined(groups: Column) -> Column:
        return let(running(F.transform(groups, lambda g: F.element_at(g, -1)), op, kind, levels - 1), lambda ends: F.flatten(F.transform(
            groups, lambda g, k: F.when(k == 0, g).otherwise(F.transform(g, lambda x: op(F.get(ends, k - 1), x))))))

    return let(values, either if levels else grown)


def regex_spans(text: Column, pattern: str, context: int = 0) -> Column:
    """array<SPAN>: the leftmost non-overlapping matches of ``pattern`` (which must not match
    the empty string), in code points, end exclusive. ``before`` and ``after`` hold up to
    ``context`` code points of the text between this match and its neighbours.

    The text is split at the matches; a running sum over the lengths of gaps and matches
    gives the positions: the work is linear in the text, with a factor log2 of the matches.
    """
    empty = F.array().cast(f"array<{SPAN}>")

    def build(found: Column) -> Column:
        def located(gaps: Column) -> Column:
            sizes = F.transform(found, lambda m, k: F.length(gaps[k]).cast("bigint") + F.length(m))

            def spans(ends: Column) -> Column:
                return F.transform(found, lambda m, k: F.struct(
                    (ends[k] - F.length(m)).alias("start"), ends[k].alias("end"), m.alias("value"),
                    (F.right(gaps[k], F.lit(context)) if context else F.lit("")).alias("before"),
                    (F.left(gaps[k + 1], F.lit(context)) if context else F.lit("")).alias("after")))
            return let(running(sizes, lambda x, y: x + y), spans)

        return F.when(F.size(found) == 0, empty).otherwise(let(F.split(text, pattern), located))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), build)


def labelled(kind: str, spans: Column) -> Column:
    """array<string> of ``kind:start:end``."""
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))
