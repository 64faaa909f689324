"""Evaluation metrics: token accuracy (A3), label-smoothed loss (A4),
token statistics (A2).  All reduce to per-row sums and one algebraic
aggregate, so they combine map-side whatever the grouping skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import EVAL_TEMPERATURE, LABEL_SMOOTHING, PAD_ID, UNK_ID
from ..functions.arrays import apply_temperature, logsumexp
from ..session import stored


def token_accuracy_cols(pred, y, pad: int = PAD_ID):
    """(correct, counted) for one row of id arrays; labels equal to ``pad`` are ignored."""
    p = F.col(pred) if isinstance(pred, str) else pred
    t = F.col(y) if isinstance(y, str) else y
    pairs = F.arrays_zip(p.alias("p"), t.alias("y"))
    counted = F.size(F.filter(t, lambda v: v != F.lit(pad)))
    correct = F.size(F.filter(pairs, lambda s: (s["y"] != F.lit(pad)) & (s["p"] == s["y"])))
    return correct.cast("long"), counted.cast("long")


def token_accuracy(df: DataFrame, pred: str, y: str, group_cols=(), pad: int = PAD_ID) -> DataFrame:
    """A3: micro accuracy = Σ correct / Σ counted (not a mean of per-row means).

    ``pred``/``y`` are either id arrays (one row per sequence) or ids (one row
    per token)."""
    dt = dict(df.dtypes)[y]
    if dt.startswith("array"):
        correct, counted = token_accuracy_cols(pred, y, pad)
    else:
        counted = (F.col(y) != F.lit(pad)).cast("long")
        correct = ((F.col(y) != F.lit(pad)) & (F.col(pred) == F.col(y))).cast("long")
    aggs = [F.sum(correct).alias("correct"), F.sum(counted).alias("counted")]
    g = df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    return g.withColumn("accuracy", F.col("correct") / F.col("counted"))


def token_loss_col(logits, y, eps: float = LABEL_SMOOTHING, t: float = EVAL_TEMPERATURE):
    """Per-token label-smoothed cross entropy on ``logits / t``."""
    z = apply_temperature(logits, t)
    lse = logsumexp(z)
    nll = lse - F.element_at(z, F.col(y) + 1)
    # mean over classes of -log p_c = lse - mean(z)
    smooth = lse - F.aggregate(z, F.lit(0.0).cast("double"), lambda a, x: a + x) / F.size(z)
    return F.lit(1.0 - eps) * nll + F.lit(eps) * smooth


def label_smoothed_ce(df: DataFrame, logits: str, y: str, group_cols=(), eps: float = LABEL_SMOOTHING,
                      t: float = EVAL_TEMPERATURE, pad: int = PAD_ID) -> DataFrame:
    """A4: mean label-smoothed cross entropy over tokens with ``y != pad``."""
    keep = F.col(y) != F.lit(pad)
    loss = F.when(keep, token_loss_col(logits, y, eps, t))
    aggs = [F.sum(loss).alias("loss_sum"), F.sum(keep.cast("long")).alias("n_tokens")]
    g = df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    return g.withColumn("loss", F.col("loss_sum") / F.col("n_tokens"))


def token_stats(df: DataFrame, ids: str, group_cols, max_len: int, vocab_size: int | None = None,
                percentiles=()) -> DataFrame:
    """A2: tokens per row, truncated share, unk share (and vocabulary coverage).

    ``percentiles`` adds ``p50_tokens`` and so on: the least length that so many rows
    don't exceed.  They come from a count per length, which is added up map-side and
    merges exactly (lengths are few, whatever the number of rows)."""
    # the rows are read once: per group one count for every length and for every id in use
    g, n = list(group_cols), F.col("_n")
    cells = df.select(*g, F.size(ids).cast("long").alias("_n"), F.size(F.filter(ids, lambda v: v == F.lit(UNK_ID))).alias("_unk"),
                      F.coalesce(F.array_distinct(ids) if vocab_size else F.array().cast("array<int>"), F.array().cast("array<int>")).alias("_used"))
    # place 0 stands for the row itself
    cells = cells.select(*g, "_n", "_unk", F.posexplode(F.concat(F.array(F.lit(-1)), "_used")).alias("_at", "_id"))
    row = F.col("_at") == 0
    cells = stored(cells.groupBy(*g, (~row).alias("_is_id"), F.when(row, F.col("_n")).otherwise(F.col("_id")).alias("_n"))
                        .agg(F.count(F.lit(1)).alias("_f"), F.sum(F.when(row, F.col("_unk"))).alias("_unk")), "token-stats")
    lens = cells.filter(~F.col("_is_id"))
    total, known = F.sum(n * F.col("_f")), F.sum(F.when(n.isNotNull(), F.col("_f")))
    out = lens.groupBy(*g).agg(
        F.sum("_f").alias("n_rows"), total.alias("n_tokens"), (total / known).alias("mean_tokens"), F.max(n).cast("int").alias("max_tokens"),
        (F.sum(F.when(n > F.lit(max_len), F.col("_f")).when(n.isNotNull(), F.lit(0))) / known).alias("truncated_share"),
        (F.sum("_unk") / total).alias("unk_share"))
    if percentiles:
        w = Window.partitionBy(*g).orderBy("_n")
        upto = F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("_f").over(Window.partitionBy(*g))
        lens = lens.withColumn("_c", upto).groupBy(*g).agg(
            *[F.min(F.when(F.col("_c") >= float(p), n)).alias(f"p{round(100 * p)}_tokens") for p in percentiles])
        out = out.join(lens, g, "left")
    if vocab_size:
        used = cells.filter("_is_id").groupBy(*g).agg(F.count(F.lit(1)).alias("_used"))
        out = out.join(used, g, "left").withColumn(
            "coverage", F.coalesce(F.col("_used"), F.lit(0)) / F.lit(vocab_size)).drop("_used")
    return out
