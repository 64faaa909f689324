"""Operator 4 [native]: quality rules by document and by host.

Document rules come from whole texts with DataFrame functions only.  Rule
failures are counted by host, the rate of each rule is shrunk towards the rate
of all hosts by a beta prior whose strength is estimated from the spread
between hosts (method of moments), and the verdict on a host is joined back to
its documents.

Windows of words are compared by a 64-bit hash inside one text (two different
windows of one text of n words share a hash with a chance below n^2 / 2^65).

Cases: null text has no words and fails the base rule; null and empty hosts are
one host; repeated rows count as often as they occur; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.tables import table
from .common import stage

#: fixed values of the contract
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
#: document rules that are counted by host besides the two of ``base_failed``
RULES = {
    "few_words": lambda: F.col("n_words") < MIN_WORDS,
    "repeats": lambda: 100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"),
    "symbols": lambda: 10 * F.col("n_symbols") > F.col("n_words"),
    "dup_lines": lambda: 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
}
#: a host is rejected when the shrunk failure rate of a rule is above this
HOST_LIMIT = 0.5
#: host tables up to this many rows are broadcast; larger ones are joined by a shuffle
MAX_HOSTS = 200_000
#: strength of the prior, in documents: at least, and if all hosts have one rate
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda variable holds it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words covered by windows that occur twice or more in the text.

    Windows are sorted with their place by hash; neighbours with one hash are
    repeats.  Their places in order cover ``min(8, distance to the next)`` words each."""
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1),
                          lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(pairs: Column) -> Column:
        hit = F.filter(F.transform(pairs, lambda p, i: F.when(
            (F.get(pairs, i - 1)["h"] == p["h"]) | (F.get(pairs, i + 1)["h"] == p["h"]), p["i"])),
            lambda x: x.isNotNull())
        return _let(F.array_sort(hit), covered)

    def of(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(pairs, repeated)).otherwise(F.lit(0).cast("long"))

    return F.when(F.size(words) >= WINDOW + 1, _let(windows, of)).otherwise(F.lit(0).cast("long"))


def document_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Counts of every whole text: doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                  text.alias("_text"))
    words = F.filter(F.split("_text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    long = lambda c: c.cast("long")
    counts = F.struct(
        long(F.length(F.translate("_text", SPACE, ""))).alias("word_chars"),
        long(F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).alias("n_symbols"),
        _let(lines, lambda x: F.struct(long(F.size(x)).alias("n"), long(F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
        _let(words, lambda w: F.struct(long(F.size(w)).alias("n"), _repeat_words(w).alias("rep"))).alias("words"))
    return (d.select("doc_id", "host", counts.alias("_c"))
             .select("doc_id", "host", F.col("_c.words.n").alias("n_words"), F.col("_c.word_chars").alias("word_chars"),
                     F.col("_c.n_symbols").alias("n_symbols"), F.col("_c.lines.n").alias("n_lines"),
                     F.col("_c.lines.dup").alias("n_dup_lines"), F.col("_c.words.rep").alias("n_repeat_words")))


def host_verdicts(rules: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host, n_docs, the shrunk rate of each rule, host_rejected."""
    hosts = rules.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                      *[F.sum(F.when(r(), 1).otherwise(0)).alias(f"f_{k}") for k, r in RULES.items()])
    # one row: mean and spread of the hosts' rates
    prior = hosts.agg(*[c for k in RULES for c in (
        (F.sum(f"f_{k}") / F.sum("n_docs")).alias(f"m_{k}"),
        F.var_pop(F.col(f"f_{k}") / F.col("n_docs")).alias(f"v_{k}"))]).first()
    h = hosts
    for k in RULES:
        m, v = prior[f"m_{k}"], prior[f"v_{k}"]
        if v is None:  # no documents
            m, s = 0.0, MAX_STRENGTH
        else:
            s = MAX_STRENGTH if v <= 0 else min(MAX_STRENGTH, max(MIN_STRENGTH, m * (1 - m) / v - 1))
        h = h.withColumn(f"rate_{k}", (F.col(f"f_{k}") + F.lit(m * s)) / (F.col("n_docs") + F.lit(s)))
    bad = F.greatest(*[F.col(f"rate_{k}") for k in RULES]) > F.lit(limit)
    return h.select("host", "n_docs", *[f"rate_{k}" for k in RULES], bad.alias("host_rejected"))


def verdicts(rules: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Base rule, host verdict and final verdict of every row of :func:`document_rules`.

    A small table of hosts is broadcast, so that a host with many documents isn't
    gathered; the way beyond ``MAX_HOSTS`` is a join whose skewed keys Spark splits."""
    hosts = stage(host_verdicts(rules, limit).select("host", "host_rejected"), "hosts")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return (rules.withColumn("base_failed", base)
                 .join(F.broadcast(hosts) if hosts.count() <= MAX_HOSTS else hosts, "host")
                 .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the counts are written once: hosts and documents both read them
    rules = stage(document_rules(table(spark, sf_dir, "documents")), "op4-rules")
    return verdicts(rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                  "base_failed", "kept")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM r) GROUP BY doc_id),
f AS (SELECT w.doc_id, host, len(ws)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
b AS (SELECT *, (n_words < 20)::INT AS x1, (100 * n_repeat_words > 30 * n_words)::INT AS x2,
             (10 * n_symbols > n_words)::INT AS x3, (10 * n_dup_lines > 3 * n_lines)::INT AS x4 FROM f),
h AS (SELECT host, count(*) AS n, sum(x1) AS f1, sum(x2) AS f2, sum(x3) AS f3, sum(x4) AS f4 FROM b GROUP BY host),
p AS (SELECT sum(f1) / sum(n) AS m1, var_pop(f1 / n) AS v1, sum(f2) / sum(n) AS m2, var_pop(f2 / n) AS v2,
             sum(f3) / sum(n) AS m3, var_pop(f3 / n) AS v3, sum(f4) / sum(n) AS m4, var_pop(f4 / n) AS v4 FROM h),
s AS (SELECT *, CASE WHEN v1 <= 0 THEN 1e6 ELSE least(1e6, greatest(1.0, m1 * (1 - m1) / v1 - 1)) END AS s1,
                CASE WHEN v2 <= 0 THEN 1e6 ELSE least(1e6, greatest(1.0, m2 * (1 - m2) / v2 - 1)) END AS s2,
                CASE WHEN v3 <= 0 THEN 1e6 ELSE least(1e6, greatest(1.0, m3 * (1 - m3) / v3 - 1)) END AS s3,
                CASE WHEN v4 <= 0 THEN 1e6 ELSE least(1e6, greatest(1.0, m4 * (1 - m4) / v4 - 1)) END AS s4 FROM p),
v AS (SELECT host, greatest((f1 + m1 * s1) / (n + s1), (f2 + m2 * s2) / (n + s2),
                            (f3 + m3 * s3) / (n + s3), (f4 + m4 * s4) / (n + s4)) > 0.5 AS bad FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (x1 = 1 OR x2 = 1) AS base_failed, (x1 = 0 AND x2 = 0 AND NOT v.bad) AS kept
FROM b JOIN v ON v.host = b.host
"""
