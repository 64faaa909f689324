"""Row numbering without a single-partition window (K1, K2).

Three shapes, all ending in ``offset + local position``:

* :func:`with_bucket_rank` – the order key has a value-derived, monotone
  bucket (a hash prefix, a line-number block).  Counts per bucket form a
  table bounded by the number of buckets; it is the only thing broadcast.
* :func:`with_order_rank` – any unique order key.  The keys alone are range
  partitioned (by sampled splitters), sorted and stored with their places, so every
  later job sees the same splitters; the ranks are joined back to the rows.
* :func:`with_line_no` – file order of a text scan, from the scan's own
  split metadata, added up in two levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import fits_broadcast, stored

#: most buckets whose counts may reach the driver
MAX_BUCKETS = 2_000_000
#: input splits that one task adds up
SPLIT_BLOCK = 1024
_LOCAL_BITS = 33


def hash_key(seed, *cols) -> F.Column:
    """md5 hex of ``seed:c1:c2…`` — a reproducible random order key."""
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                  for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_bucket(hex_col, digits: int = 4) -> F.Column:
    """Leading ``digits`` hex characters of ``hex_col`` as a number (monotone in the key)."""
    c = F.col(hex_col) if isinstance(hex_col, str) else hex_col
    return F.conv(F.substring(c, 1, digits), 16, 10).cast("long")


def _offsets(spark, counts_rows, bucket_col: str):
    """Running offsets of a bounded bucket → count table, computed on the driver."""
    rows = sorted((r[0], r[1]) for r in counts_rows)
    acc, out = 0, []
    for b, n in rows:
        out.append((b, acc, n))
        acc += n
    df = spark.createDataFrame(out, f"{bucket_col} long, _off long, _cnt long")
    return df, acc


def bucket_offsets(df: DataFrame, bucket: F.Column, bucket_col: str = "_b"):
    """(offsets DataFrame, total rows) for a monotone bucket expression.

    The count table has one row per bucket; callers choose buckets whose
    number is bounded (a fixed hash prefix, a block count), so collecting it
    is bounded too.
    """
    counts = df.select(bucket.alias(bucket_col)).groupBy(bucket_col).count().collect()
    if len(counts) > MAX_BUCKETS:
        raise ValueError(f"{len(counts)} buckets: choose a coarser bucket expression")
    return _offsets(df.sparkSession, counts, bucket_col)


def with_bucket_rank(df: DataFrame, bucket: F.Column, order_cols, rank_col: str = "rank",
                     offsets=None) -> DataFrame:
    """0-based global rank by ``order_cols`` (which must be unique per row).

    ``bucket`` must be monotone in the order: bucket(a) < bucket(b) ⇒ a < b.
    """
    if offsets is None:
        offsets, _ = bucket_offsets(df, bucket)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    w = Window.partitionBy("_b").orderBy(*order)
    return (df.withColumn("_b", bucket)
              .join(F.broadcast(offsets), "_b")
              .withColumn(rank_col, F.col("_off") + F.row_number().over(w) - 1)
              .drop("_b", "_off", "_cnt"))


def with_hash_rank(df: DataFrame, seed, key_cols, rank_col: str = "rank",
                   digits: int = 4, extra_key=()) -> DataFrame:
    """Rank by ``(md5(seed:keys), keys)``: a reproducible shuffle."""
    h = hash_key(seed, *extra_key, *key_cols)
    d = df.withColumn("_h", h)
    return with_bucket_rank(d, hash_bucket("_h", digits), ["_h", *key_cols], rank_col).drop("_h")


def with_order_rank(df: DataFrame, order_cols, rank_col: str = "line_no",
                    num_partitions: int | None = None) -> DataFrame:
    """0-based rank by a unique composite key (nulls first), for any key distribution."""
    spark = df.sparkSession
    order_cols = list(order_cols)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = stored(df.select(*order_cols).repartitionByRange(n, *order_cols)
                    .sortWithinPartitions(*order_cols)
                    .withColumn("_mid", F.monotonically_increasing_id()), "order-keys")
    part = F.shiftrightunsigned("_mid", _LOCAL_BITS)
    counts = keys.groupBy(part.alias("_b")).count().collect()  # one number per range
    offsets, _ = _offsets(spark, counts, "_b")
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    ranks = (keys.withColumn("_b", part).join(F.broadcast(offsets), "_b")
                 .select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(order_cols)], (F.col("_off") + local).alias(rank_col)))
    ranks = F.broadcast(ranks) if fits_broadcast(ranks) else ranks
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(order_cols)]
    return df.join(ranks, same).drop(*[f"_k{i}" for i in range(len(order_cols))])


def natural_order(path) -> F.Column:
    """A text that sorts as ``path`` does with its numbers read as numbers: digits are padded to 20 places."""
    parts = F.regexp_extract_all(path, F.lit("[0-9]+|[^0-9]+"), 0)
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[0-9]") & (F.length(p) < 20), F.lpad(p, 20, "0")).otherwise(p)), "")


def with_line_no(df: DataFrame, col: str = "line_no") -> DataFrame:
    """K1: consecutive 0-based number in file order of a file scan.

    Must be called directly on a ``spark.read`` result.  Splits are ordered by
    (file path in natural order, split start); inside a split rows keep read order,
    which ``monotonically_increasing_id`` follows.  The stored table of splits is added
    up in blocks of ``SPLIT_BLOCK``; only the blocks' sums reach the driver.
    """
    d = (df.withColumn("_f", F.col("_metadata.file_path"))
           .withColumn("_s", F.col("_metadata.file_block_start"))
           .withColumn("_mid", F.monotonically_increasing_id()))
    splits = stored(d.groupBy("_f", "_s").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
                     .withColumn("_o", natural_order("_f")), "splits")
    ranked = with_order_rank(splits, ["_o", "_f", "_s"], "_r").withColumn("_b", F.floor(F.col("_r") / F.lit(SPLIT_BLOCK)).cast("long"))
    offsets, _ = _offsets(df.sparkSession, ranked.groupBy("_b").agg(F.sum("_n")).collect(), "_b")
    w = Window.partitionBy("_b").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (ranked.join(F.broadcast(offsets), "_b")
                    .select("_f", "_s", "_m0", (F.col("_off") + F.coalesce(F.sum("_n").over(w), F.lit(0))).alias("_off")))
    right = F.broadcast(ranked) if fits_broadcast(ranked) else ranked
    return (d.join(right, ["_f", "_s"])
             .withColumn(col, F.col("_off") + F.col("_mid") - F.col("_m0"))
             .drop("_f", "_s", "_mid", "_m0", "_off"))
