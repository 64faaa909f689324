"""Running aggregates per group that do not gather a hot group in one task.

A running max/sum over ``order_col`` inside ``part_cols`` is computed in
blocks of about equally many rows: block limits are quantiles of each group's
``order_col`` values, so sparse and dense stretches are cut alike.  Each (group,
block) is scanned on its own, block totals are scanned per group (at most
``MAX_BLOCKS`` rows), and the two are combined.  A group holding a third of all
rows is thus spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.arrays import first_above
from ..session import fits_broadcast, stored

_COMBINE = {"max": F.greatest, "sum": lambda a, b: a + b}
_AGG = {"max": F.max, "sum": F.sum}


#: rows of a block, about; most blocks of a group
DEPTH, MAX_BLOCKS = 100_000, 4096


def with_blocks(df: DataFrame, part_cols, order_col: str, depth: int = DEPTH, out: str = "_blk") -> DataFrame:
    """Number the rows' blocks: contiguous in ``order_col``, of about ``depth`` rows of a group each.

    Quantiles come from a mergeable sketch; that they are approximate changes the
    size of blocks only."""
    largest = df.groupBy(*part_cols).count().agg(F.max("count")).first()[0] or 0
    n = min(MAX_BLOCKS, -(-largest // depth))
    if n <= 1:
        return df.withColumn(out, F.lit(0))
    at = F.array(*[F.lit(k / n) for k in range(1, n)])
    limits = stored(df.groupBy(*part_cols).agg(F.percentile_approx(order_col, at).alias("_limits")), "block-limits")
    limits = F.broadcast(limits) if fits_broadcast(limits) else limits
    return df.join(limits, list(part_cols)).withColumn(out, first_above("_limits", order_col, n)).drop("_limits")


def running_many(df: DataFrame, part_cols, order_col: str, specs, depth: int = DEPTH) -> DataFrame:
    """Several running aggregates in one blocked pass (one set of shuffles).

    ``specs`` are ``(value, out, fn, inclusive)``: ``out`` = fn(value) over rows
    of the same group with a smaller (``inclusive``: or equal) ``order_col``.
    ``order_col`` must be unique within a group, a number and not null.  An empty prefix
    gives null (sum: 0)."""
    part_cols = list(part_cols)
    d = with_blocks(df, part_cols, order_col, depth)
    win = Window.partitionBy(*part_cols, "_blk").orderBy(order_col)
    bw = Window.partitionBy(*part_cols).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    block_aggs, outs = [], []
    for i, (value, out, fn, inclusive) in enumerate(specs):
        v = F.col(value) if isinstance(value, str) else value
        agg = _AGG[fn]
        d = d.withColumn(f"_v{i}", v)
        d = d.withColumn(f"_loc{i}", agg(f"_v{i}").over(
            win.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)))
        block_aggs.append(agg(f"_v{i}").alias(f"_bv{i}"))
        outs.append((i, out, fn))
    blocks = d.groupBy(*part_cols, "_blk").agg(*block_aggs)
    for i, _, fn in outs:
        blocks = blocks.withColumn(f"_pre{i}", _AGG[fn](f"_bv{i}").over(bw))
    blocks = blocks.select(*part_cols, "_blk", *[f"_pre{i}" for i, _, _ in outs])
    d = d.join(blocks, [*part_cols, "_blk"])
    drop = ["_blk"]
    for i, out, fn in outs:
        pre, loc = F.col(f"_pre{i}"), F.col(f"_loc{i}")
        res = F.when(pre.isNull(), loc).when(loc.isNull(), pre).otherwise(_COMBINE[fn](pre, loc))
        if fn == "sum":
            res = F.coalesce(res, F.lit(0))
        d = d.withColumn(out, res)
        drop += [f"_v{i}", f"_loc{i}", f"_pre{i}"]
    return d.drop(*drop)


def running(df: DataFrame, part_cols, order_col: str, value, out: str, fn: str = "max",
            inclusive: bool = False, depth: int = DEPTH) -> DataFrame:
    """One running aggregate; see :func:`running_many`."""
    return running_many(df, part_cols, order_col, [(value, out, fn, inclusive)], depth)


def group_row_number(df: DataFrame, part_cols, order_col: str, out: str,
                     depth: int = DEPTH) -> DataFrame:
    """1-based position of a row inside its group by ``order_col`` (unique)."""
    return running(df, part_cols, order_col, F.lit(1).cast("long"), out, "sum",
                   inclusive=True, depth=depth)
