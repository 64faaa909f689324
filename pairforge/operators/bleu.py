"""Sentence BLEU (A5) and its mean.

A row's score needs nothing from other rows: the n-grams of both sides are
sorted together and folded once, which counts every gram's clipped matches.
No shuffle, and everything stays JVM-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import BLEU_EPSILON


def _grams(tokens, n: int):
    return F.when(F.size(tokens) >= n, F.transform(
        F.sequence(F.lit(1), F.size(tokens) - n + 1),
        lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(
        F.array().cast("array<string>"))


def _clipped(hyp, ref):
    """Σ over distinct grams of min(count in hyp, count in ref)."""
    def tag(grams, side):
        return F.transform(grams, lambda g: F.struct(g.alias("g"), F.lit(side).alias("side")))

    def step(acc, x):
        same = acc["g"].eqNullSafe(x["g"])
        h = F.when(same, acc["h"]).otherwise(F.lit(0)) + F.when(x["side"] == 1, 1).otherwise(0)
        r = F.when(same, acc["r"]).otherwise(F.lit(0)) + F.when(x["side"] == 2, 1).otherwise(0)
        before = F.when(same, F.least(acc["h"], acc["r"])).otherwise(F.lit(0))
        return F.struct(x["g"].alias("g"), h.alias("h"), r.alias("r"), (acc["m"] + F.least(h, r) - before).alias("m"))

    zero = F.struct(F.lit(None).cast("string").alias("g"), F.lit(0).alias("h"), F.lit(0).alias("r"), F.lit(0).alias("m"))
    return F.aggregate(F.array_sort(F.concat(tag(hyp, 1), tag(ref, 2))), zero, step, lambda a: a["m"])


def sentence_bleu(df: DataFrame, ref_col: str, hyp_col: str, keys, out: str = "bleu",
                  max_n: int = 2, eps: float = BLEU_EPSILON) -> DataFrame:
    """Smoothed (method 1) sentence BLEU with uniform weights over 1..``max_n``.

    ``ref_col`` / ``hyp_col`` are ARRAY<STRING> token lists; ``keys`` identify
    a row and are returned with ``out``.  Tokens must not contain spaces
    (they come from a whitespace split).
    """
    keys = list(keys)
    ref, hyp = F.col(ref_col), F.col(hyp_col)
    per_row = df.select(*keys, F.size(hyp).cast("long").alias("_lh"), F.size(ref).cast("long").alias("_lr"),
                        *[_clipped(_grams(hyp, n), _grams(ref, n)).alias(f"_m{n}") for n in range(1, max_n + 1)])
    lh, lr = F.col("_lh").cast("double"), F.col("_lr").cast("double")
    logp = None
    for n in range(1, max_n + 1):
        den = F.greatest(F.lit(1.0), lh - n + 1)
        m = F.col(f"_m{n}").cast("double")
        p = F.when(m == 0, F.lit(eps) / den).otherwise(m / den)
        term = F.log(p) / max_n
        logp = term if logp is None else logp + term
    bp = (F.when(lh > lr, F.lit(1.0)).when(lh == 0, F.lit(0.0))
          .otherwise(F.exp(F.lit(1.0) - lr / lh)))
    score = F.when(F.col("_m1") == 0, F.lit(0.0)).otherwise(bp * F.exp(logp))
    return per_row.select(*keys, score.alias(out), F.col("_lh").alias("hyp_len"),
                          F.col("_lr").alias("ref_len"))


def mean_bleu(df: DataFrame, bleu_col: str = "bleu", group_cols=()) -> DataFrame:
    """Plain mean of sentence scores, 0.0 for no rows."""
    agg = F.coalesce(F.avg(bleu_col), F.lit(0.0)).alias("mean_bleu")
    if group_cols:
        return df.groupBy(*group_cols).agg(agg)
    return df.agg(agg)
