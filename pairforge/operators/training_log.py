"""Training-metric analytics on a ``metric_log`` table.

``metric_log(run_id, epoch, step, name, value, weight)`` holds one logged
value per step; validation checks are the rows of one monitored ``name``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import EARLY_STOP_PATIENCE, SAMPLE_EVERY, TOP_CHECKPOINTS
from .scan import running, running_many


def metric_log_from_events(events: DataFrame) -> DataFrame:
    """The ``events`` table read as a metric log.

    run = user, step = event id, metric name = event type, epoch = day of the
    timestamp, weight (batch size) = ``k`` of the JSON properties plus one.
    """
    return events.select(
        F.col("user_id").alias("run_id"),
        F.floor(F.unix_timestamp("ts") / 86400).cast("long").alias("epoch"),
        F.col("event_id").alias("step"),
        F.col("event_type").alias("name"),
        F.col("value").cast("double").alias("value"),
        (F.get_json_object("props", "$.k").cast("long") + 1).alias("weight"))


def epoch_metrics(log: DataFrame) -> DataFrame:
    """Per run, epoch and metric, the weight-averaged step values."""
    return (log.groupBy("run_id", "epoch", "name")
               .agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("value"),
                    F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n_steps")))


def top_k_per_group(df: DataFrame, group_cols, order_cols, k: int, out: str = "rank") -> DataFrame:
    """The ``k`` best rows per group.

    ``order_cols`` must make the order total (end with a unique tie-breaker).
    A ``row_number() <= k`` filter is planned as a window group limit, which
    keeps only ``k`` rows per group inside every task before the shuffle, so
    a hot group arrives as at most ``k`` rows per task.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def top_checkpoints(log: DataFrame, monitor: str, k: int = TOP_CHECKPOINTS) -> DataFrame:
    """The ``k`` best checks per run by ``monitor`` (max mode), ties to the
    earlier check, plus the last check of every run."""
    checks = log.filter(F.col("name") == monitor).select("run_id", "step", "value")
    best = top_k_per_group(checks, ["run_id"], [F.col("value").desc(), F.col("step")], k, "rank")
    last = checks.groupBy("run_id").agg(F.max("step").alias("step"))
    best = best.withColumn("is_last", F.lit(False))
    last = (last.join(checks, ["run_id", "step"])
                .withColumn("rank", F.lit(None).cast("int")).withColumn("is_last", F.lit(True)))
    both = best.unionByName(last)
    return (both.groupBy("run_id", "step", "value")
                .agg(F.min("rank").alias("rank"), F.max("is_last").alias("is_last")))


def early_stop(log: DataFrame, monitor: str, patience: int = EARLY_STOP_PATIENCE) -> DataFrame:
    """Per run, the first check after ``patience`` checks in a row without a
    strictly better ``monitor`` value (max mode).  ``stop_check`` is null
    when the run never stops."""
    c = log.filter(F.col("name") == monitor).select("run_id", "step", "value")
    c = running_many(c, ["run_id"], "step", [(F.lit(1).cast("long"), "check_no", "sum", True),
                                               ("value", "prev_best", "max", False)])
    improved = F.col("prev_best").isNull() | (F.col("value") > F.col("prev_best"))
    c = c.withColumn("_imp", F.when(improved, F.col("check_no")))
    c = running(c, ["run_id"], "step", "_imp", "last_best", "max", inclusive=True)
    since = F.col("check_no") - F.col("last_best")
    return (c.groupBy("run_id").agg(
        F.min(F.when(since >= patience, F.col("check_no"))).alias("stop_check"),
        F.min(F.when(since >= patience, F.col("step"))).alias("stop_step"),
        F.max("value").alias("best_value"),
        F.count(F.lit(1)).alias("n_checks")))


def sample_cadence(log: DataFrame, every: int = SAMPLE_EVERY) -> DataFrame:
    """Steps at which a sample is drawn (``step % every == 0``)."""
    return log.filter(F.col("step") % F.lit(every) == 0)
