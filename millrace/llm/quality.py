"""Quality rules with host-level verdicts (native DataFrame functions only).

Each document is measured against rules. The failures of every rule are aggregated by host, a beta
prior a rule is fitted to the hosts' rates by moments (empirical Bayes) and every host's rate is shrunk
towards it. A host is suspect by a rule where its posterior lies well above the rule's mean over hosts.
The verdicts are joined back to the documents: on a host that any rule makes suspect, a document that
breaks a soft rule is rejected as well. A document that breaks no rule is kept on every host.

Defined cases: NULL or empty text has no words and fails; a NULL host is a host of its own;
repeated rows are measured and counted once each; an empty table gives an empty result; further
columns of the input do not matter (results are built from the named columns only).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, SPACES, let, text_or_empty, words, written

#: Base rules: fewer words than this, or more than this share of words in repeated 3-word windows.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Soft rules, in percent: symbols per word, duplicate lines per line with a word, mean word length.
MAX_SYMBOL_PERCENT = 50
MAX_DUP_LINE_PERCENT = 30
MIN_WORD_CHARS, MAX_WORD_CHARS = 2, 15
#: Rules in the order of the column ``broken``; the first two are the base rules.
RULES = ("few_words", "repeats", "symbols", "dup_lines", "word_length")
#: A host is suspect by a rule where its shrunken rate exceeds the mean rate by this factor and by this many
#: standard deviations of its posterior.
RATE_FACTOR = 1.5
RATE_DEVIATIONS = 2.0


def repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice in the array ``w``.

    Windows are sorted as (hash, words, position) within the row, so equal windows are
    neighbours; equality is decided on the words, the hash only speeds the comparisons up.
    """
    def windows(n: Column) -> Column:
        return F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
            F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"),
            w[i].alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c"), i.alias("i"))))

    def same(x: Column, y: Column) -> Column:
        return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def covered(s: Column) -> Column:
        hit = F.filter(s, lambda x, k: F.when(k > 0, same(x, s[k - 1])).otherwise(False)
                       | F.when(k < F.size(s) - 1, same(x, s[k + 1])).otherwise(False))
        at = F.transform(hit, lambda x: x["i"])
        return F.size(F.array_distinct(F.concat(at, F.transform(at, lambda i: i + 1), F.transform(at, lambda i: i + 2))))

    # Most texts repeat no window: a distinct count of the window hashes settles that without sorting.
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
    return (F.when(F.size(w) < 4, 0)
            .when(let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h)), 0)
            .otherwise(let(windows(F.size(w)), covered))).cast("bigint")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, host, ``carry`` columns and the rule measures."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text_or_empty(text_col).alias("_t"),
                       *[F.col(c).alias(f"_carry_{c}") for c in carry])
    lines = F.filter(F.split(F.col("_t"), "\n"), lambda s: s.rlike(f"[^{SPACE_CLASS}]"))
    m = base.select(
        "doc_id", "host", *[f"_carry_{c}" for c in carry],
        let(words(F.col("_t")), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), repeat_words(w).alias("r"))).alias("_w"),
        F.length(F.translate(F.col("_t"), SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length("_t") - F.length(F.translate(F.col("_t"), SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        let(lines, lambda a: F.struct(F.size(a).cast("bigint").alias("n"),
                                      (F.size(a) - F.size(F.array_distinct(a))).cast("bigint").alias("d"))).alias("_l"))
    m = m.select("doc_id", "host", *[f"_carry_{c}" for c in carry], F.col("_w.n").alias("n_words"), "word_chars",
                 "n_symbols", F.col("_l.d").alias("n_dup_lines"), F.col("_l.n").alias("n_lines"),
                 F.col("_w.r").alias("n_repeat_words"))
    broken = (F.col("n_words") < MIN_WORDS,
              100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
              100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"),
              100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
              (F.col("word_chars") < MIN_WORD_CHARS * F.col("n_words")) | (F.col("word_chars") > MAX_WORD_CHARS * F.col("n_words")))
    return m.withColumn("broken", F.array(*broken)).withColumns({
        "base_failed": F.col("broken")[0] | F.col("broken")[1],
        "soft_failed": F.col("broken")[2] | F.col("broken")[3] | F.col("broken")[4]})


def host_rates(measured: DataFrame) -> DataFrame:
    """Per host and rule: documents ``n``, failures ``f``, the rule's mean rate ``m`` over hosts, the rate shrunk by
    the rule's fitted beta prior, and the posterior's standard deviation.

    Moments over hosts: mean m and variance v of f/n, less the mean binomial noise; the prior
    strength is m(1-m)/v - 1. With one host, or no spread beyond noise, all hosts share the mean.
    """
    failures = F.array(*[F.struct(F.lit(rule).alias("rule"), F.count_if(F.col("broken")[k]).alias("f")) for k, rule in enumerate(RULES)])
    # A few rows a host; written, as the prior and the rates read them.
    by_host = written(measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"), failures.alias("rules"))
                      .select("host", "n", F.inline("rules")), "quality-rates")
    rate = F.col("f") / F.col("n")
    prior = (by_host.groupBy("rule").agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg(1.0 / F.col("n")).alias("inv_n"))
             .select("rule", "m", (F.col("v") - F.col("m") * (1 - F.col("m")) * F.col("inv_n")).alias("v"))
             .select("rule", "m", F.when(F.col("v") > 1e-9, F.greatest(F.col("m") * (1 - F.col("m")) / F.col("v") - 1, F.lit(0.0)))
                     .otherwise(F.lit(1e9)).alias("strength")))
    shrunk = by_host.join(F.broadcast(prior), "rule").select(  # a row a rule
        "host", "rule", "n", "f", "m", (F.col("n") + F.col("strength")).alias("weight"),
        ((F.col("f") + F.col("m") * F.col("strength")) / (F.col("n") + F.col("strength"))).alias("host_rate"))
    return shrunk.withColumn("deviation", F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("weight") + 1)))


def suspects(measured: DataFrame, factor: float = RATE_FACTOR, deviations: float = RATE_DEVIATIONS) -> DataFrame:
    """Hosts that at least one rule makes suspect."""
    above = (F.col("host_rate") > factor * F.col("m")) & (F.col("host_rate") > F.col("m") + deviations * F.col("deviation"))
    return (host_rates(measured).groupBy(F.col("host").alias("_host")).agg(F.max(above).alias("_suspect")).where("_suspect"))


def verdict(measured: DataFrame, bad_hosts: DataFrame) -> DataFrame:
    """Join the host verdicts back: ``host_suspect`` and ``kept``."""
    out = measured.join(bad_hosts, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
    out = out.withColumn("host_suspect", F.coalesce("_suspect", F.lit(False))).drop("_suspect")
    return out.withColumn("kept", ~F.col("base_failed") & ~(F.col("host_suspect") & F.col("soft_failed")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          factor: float = RATE_FACTOR, deviations: float = RATE_DEVIATIONS) -> DataFrame:
    """Measures and verdict per document. The measures are written once, because the host aggregate
    and the join back both read them."""
    m = written(measure(docs, id_col, text_col, host_col), "quality")
    return verdict(m, suspects(m, factor, deviations))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
         carry: tuple[str, ...] = (), factor: float = RATE_FACTOR, deviations: float = RATE_DEVIATIONS) -> DataFrame:
    """The documents that ``judge`` keeps: doc_id, host and the ``carry`` columns. Texts are measured a second
    time instead of being written with their measures."""
    bad = written(suspects(measure(docs, id_col, text_col, host_col), factor, deviations), "quality-hosts")
    kept = verdict(measure(docs, id_col, text_col, host_col, carry), bad).where("kept")
    return kept.select("doc_id", "host", *[F.col(f"_carry_{c}").alias(c) for c in carry])
