"""Shuffling, batch numbering, padding and collation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import PAD_ID
from ..functions.arrays import right_pad
from .ordering import bucket_offsets, with_bucket_rank, with_hash_rank

MAX_BLOCKS = 65536


def shuffle_rank(df: DataFrame, seed, epoch: int, key_col: str = "line_no",
                 rank_col: str = "rank") -> DataFrame:
    """B1: a new reproducible order per epoch: rank by md5(seed:epoch:key)."""
    return with_hash_rank(df, seed, [key_col], rank_col, extra_key=[F.lit(epoch)])


def file_order_rank(df: DataFrame, key_col: str = "line_no", rank_col: str = "rank") -> DataFrame:
    """Consecutive rank in ``key_col`` order (validation keeps file order).

    Buckets are blocks of ``key_col`` values, at most ``MAX_BLOCKS`` of them,
    each holding at most one block width of distinct keys.
    """
    hi = df.agg(F.max(key_col)).first()[0]
    width = max(1, -(-(int(hi or 0) + 1) // MAX_BLOCKS))
    b = F.floor(F.col(key_col) / F.lit(width)).cast("long")
    offsets, _ = bucket_offsets(df, b)
    return with_bucket_rank(df, b, [key_col], rank_col, offsets=offsets)


def assign_batches(df: DataFrame, batch_size: int, rank_col: str = "rank",
                   out: str = "batch_id") -> DataFrame:
    """B2: consecutive groups of ``batch_size`` ranks; the last one may be short."""
    return df.withColumn(out, F.floor(F.col(rank_col) / F.lit(batch_size)).cast("long"))


def pad_batches(df: DataFrame, cols, batch_col: str = "batch_id", pad: int = PAD_ID) -> DataFrame:
    """Right-pad each column to that column's longest row inside the batch."""
    w = Window.partitionBy(batch_col)
    for c in cols:
        df = df.withColumn(c, right_pad(c, F.max(F.size(c)).over(w), pad))
    return df


def batch_max_len(df: DataFrame, cols, batch_col: str = "batch_id") -> DataFrame:
    """The longest array per column in each batch."""
    return df.groupBy(batch_col).agg(*[F.max(F.size(c)).alias(f"max_{c}") for c in cols])


def collate(df: DataFrame, cols, batch_col: str = "batch_id", rank_col: str = "rank",
            pad: int = PAD_ID) -> DataFrame:
    """One row per batch with rectangular matrices (rows in rank order).

    A batch holds ``batch_size`` rows, so each group is bounded.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("_r"),
                                                *[F.col(c) for c in cols])))
    g = df.groupBy(batch_col).agg(rows.alias("_rows"))
    out = [F.col(batch_col), F.transform("_rows", lambda s: s["_r"]).alias("ranks")]
    for c in cols:
        out.append(_pad_field("_rows", c, pad).alias(c))
    return g.select(*out)


def _pad_field(rows: str, field: str, pad: int):
    m = F.aggregate(F.col(rows), F.lit(0), lambda acc, s: F.greatest(acc, F.size(s[field])))
    return F.transform(rows, lambda s: right_pad(s[field], m, pad))
