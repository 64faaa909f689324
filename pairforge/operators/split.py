"""Exact reproducible splits and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ordering import hash_key


def split_size(n: int, frac: float) -> int:
    """``round(frac * n)`` with ties to even, as a frame sampler counts rows."""
    return int(round(float(frac) * n))


def hash_cut(df: DataFrame, k: int | None, frac: float, hash_col: str, digits: int = 4) -> str:
    """The hash text below which exactly ``k`` (or ``round(frac·N)``) rows lie, by radix selection.

    Each round counts the rows of one prefix by their next ``digits`` hex digits (at
    most 16^digits numbers) and goes on inside the one bucket that straddles the cut."""
    prefix, h = "", F.col(hash_col)
    while True:
        inside = df.filter(h.startswith(prefix)) if prefix else df
        counts = inside.groupBy(F.substring(h, len(prefix) + 1, digits).alias("d")).count().collect()
        counts = sorted((r[0], r[1]) for r in counts)
        if not prefix:
            n = sum(c for _, c in counts)
            k = split_size(n, frac) if k is None else k
            if k >= n:
                return "g"  # above every hex digit
        if prefix and counts[0][0] == "":
            raise ValueError("key columns must be unique per row")
        for d, c in counts:
            if k == 0:
                return prefix + d
            if c > k:
                prefix += d
                break
            k -= c
        else:
            raise AssertionError("the cut lies in the prefix")


def exact_split(df: DataFrame, frac: float, seed, key_cols, out: str = "is_train",
                digits: int = 4) -> DataFrame:
    """Exactly ``round(frac·N)`` rows get ``out = true``, chosen by md5 order of their (unique) keys.

    The cut is found by counting hash prefixes; the flag is then one comparison per row:
    nothing is ranked, joined or shuffled with the rows."""
    h = hash_key(seed, *list(key_cols))
    cut = hash_cut(df.select(h.alias("_h")), None, frac, "_h", digits)
    return df.withColumn(out, h < F.lit(cut))


def train_rows(split_df: DataFrame, flag: str = "is_train") -> DataFrame:
    return split_df.filter(F.col(flag)).drop(flag)


def remove_rows(df: DataFrame, taken: DataFrame, key_cols) -> DataFrame:
    """Rows of ``df`` whose key is not in ``taken`` (left anti join)."""
    return df.join(taken.select(*key_cols), list(key_cols), "left_anti")


def head_rows(df: DataFrame, n: int, line_col: str = "line_no") -> DataFrame:
    """the first ``n`` rows in file order (a filter, pushed to the scan)."""
    return df.filter(F.col(line_col) < F.lit(n))


def sample_one(df: DataFrame, seed, key_cols) -> DataFrame:
    """R2: one uniformly chosen row, reproducible (top-1 by md5, no full sort)."""
    key_cols = list(key_cols)
    return (df.withColumn("_h", hash_key(seed, *key_cols))
              .orderBy("_h", *key_cols).limit(1).drop("_h"))
