"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document gets its counts and the rules: too few words, repeated words
(both are the base rule), symbols and repeated lines.  Failures of each rule
are summed by host; a host's failure rate of a rule is shrunk with a beta prior
that is fitted to all hosts by moments (mean of the rates; their variance less
the binomial noise), so a host with few documents is judged mostly by the
prior.  A host is rejected

* if a rule's rate is credibly (``SIGMAS`` posterior deviations) above the
  spread of all hosts (the prior's mean and ``SIGMAS`` of its deviations) and
  above ``HOST_LEAST``, so that a rare fault takes no clean documents with it; or
* if its shrunk rate of base failures exceeds ``HOST_LIMIT``: most of it fails.

Its verdict is joined back to its documents.  ``kept`` is false where the base
rule fails or the host is rejected.

Hosts are summed by a partial aggregate (a hot host is one row per task); the
join back is an equi-join on the host of narrow rows, whose skewed side
adaptive execution splits, or a broadcast where the stored host table is
within Spark's own limit.

Defined cases: a null or empty text has no words and fails the base rule; a
null host is a host of its own; repeated rows are each counted; other columns
are ignored by ``judge`` and passed on by ``keep``; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.util import free, stage

#: Shrunk failure rate above which a host is rejected: most of it fails.
HOST_LIMIT = 0.5
#: Failure rate of any rule below which a host stays, however rare the fault is elsewhere.
HOST_LEAST = 0.3
#: Posterior and prior deviations that count as credible (about 97.5 %, one side).
SIGMAS = 2.0
#: Bounds of the prior's strength, in documents.
PRIOR_MIN, PRIOR_MAX = 2.0, 1000.0
MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Symbols of a hundred words, and repeated lines of a hundred, beyond which a document fails.
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 30
RULES = ["short", "repeats", "symbols", "dup_lines"]

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), "")


def _repeat_words(w: Column) -> Column:
    """Words in 3-word windows that are found twice or more.  Hashes only
    show the texts without any; the others are sorted by whole windows."""
    n = F.size(w) - 2

    def windows(h: Column) -> Column:
        z = F.sort_array(F.arrays_zip(h.alias("h"), F.slice(w, 1, n).alias("a"), F.slice(w, 2, n).alias("b"),
                                      F.slice(w, 3, n).alias("c"), F.sequence(F.lit(0), n - 1).alias("i")))

        def covered(z: Column) -> Column:
            def same(x: Column, y: Column) -> Column:
                return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

            again = F.filter(z, lambda x, j: F.coalesce(same(x, F.get(z, j - 1)), F.lit(False))
                             | F.coalesce(same(x, F.get(z, j + 1)), F.lit(False)))
            at = F.sort_array(F.transform(again, lambda x: x["i"]))
            return let(at, lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
                F.lit(0), lambda s, x: s + x))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(z, covered))

    h = F.transform(F.slice(w, 1, n), lambda x, j: F.xxhash64(x, F.get(w, j + 1), F.get(w, j + 2)))
    return F.when(n < 2, 0).otherwise(let(h, windows))


def counts(text: Column) -> Column:
    """Struct of the base counts of one text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "")
    n_dup = let(lines, lambda x: F.struct(F.size(x).alias("all"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    return let(F.struct(words_of(text).alias("w"), n_dup.alias("l")), lambda x: let(x["w"], lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, _SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        x["l"]["dup"].cast("bigint").alias("n_dup_lines"),
        _repeat_words(w).cast("bigint").alias("n_repeat_words"),
        x["l"]["all"].cast("bigint").alias("n_lines"))))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])


def rules(c: Column) -> Column:
    """Struct of the rules that a text fails."""
    return F.struct(
        base_failed(c).alias("base"), (c["n_words"] < MIN_WORDS).alias("short"),
        (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"]).alias("repeats"),
        (100 * c["n_symbols"] > SYMBOL_PERCENT * c["n_words"]).alias("symbols"),
        (100 * c["n_dup_lines"] > DUP_LINE_PERCENT * c["n_lines"]).alias("dup_lines"))


def _rejected(hosts: DataFrame) -> Column:
    """The verdict on a host, from one prior a rule."""
    names = ["failed", *RULES]
    rate = {r: F.col(f"host_{r}") / F.col("host_docs") for r in names}
    p = hosts.agg(F.avg(1 / F.col("host_docs")).alias("inv"),
                  *[f(rate[r]).alias(f"{k}_{r}") for r in names for k, f in (("m", F.avg), ("v", F.var_pop))]).first()

    def shrunk(r: str) -> tuple[Column, float, float]:
        m = p[f"m_{r}"] or 0.0
        spread = (p[f"v_{r}"] or 0.0) - m * (1 - m) * (p["inv"] or 0.0)
        strength = PRIOR_MAX if spread <= 0 else min(PRIOR_MAX, max(PRIOR_MIN, m * (1 - m) / spread - 1))
        return (F.col(f"host_{r}") + F.lit(m * strength)) / (F.col("host_docs") + F.lit(strength)), m, strength

    bad = shrunk("failed")[0] > HOST_LIMIT
    for r in RULES:
        q, m, s = shrunk(r)
        limit = max(HOST_LEAST, m + SIGMAS * (m * (1 - m) / (s + 1)) ** 0.5)
        bad = bad | (q - SIGMAS * F.sqrt(q * (1 - q) / (F.col("host_docs") + (s + 1))) > limit)
    return bad


def host_verdicts(docs: DataFrame, host: str = "host", failed: str = "rules") -> DataFrame:
    """``(host, host_docs, host_failed, host_<rule>..., host_rejected)`` from
    one row per document with its :func:`rules`; stored."""
    total = lambda f, r: F.sum(F.col(f"`{failed}`.{f}").cast("bigint")).alias(f"host_{r}")
    hosts = stage(docs.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"), total("base", "failed"), *[total(r, r) for r in RULES]), "hosts")
    return hosts.withColumn("host_rejected", _rejected(hosts))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Counts and verdicts of every document."""
    m = docs.select(F.col(id_col), F.col(host_col).alias("host"), counts(F.col(text_col)).alias("c"))
    m = stage(m.select(id_col, "host", "c.*", rules(F.col("c")).alias("rules")), "quality")
    h = host_verdicts(m).withColumnRenamed("host", "h")
    base = F.col("rules.base")
    return (m.join(h, m["host"].eqNullSafe(h["h"]), "left").withColumn("base_failed", base)
            .withColumn("kept", ~base & ~F.col("host_rejected")).drop("h", "rules"))


def keep(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that pass, with their own columns."""
    flag, host = free(docs, "__rules", "__host")  # a caller's columns may have any name
    m = stage(docs.withColumn(flag, rules(counts(F.col(text_col)))), "quality-docs")
    bad = host_verdicts(m, host_col, flag).where("host_rejected").select(F.col("host").alias(host))
    ok = m.where(~F.col(f"`{flag}`.base"))
    return ok.join(bad, ok[host_col].eqNullSafe(bad[host]), "left_anti").drop(flag)
