"""Driver tables and the stand-in pair table built from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ordering import with_order_rank

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def conversation_pairs(spark: SparkSession, sf_dir: str, keep_keys: bool = False) -> DataFrame:
    """``pairs(line_no, src, tgt)``: a user turn *t* with the assistant turn *t+1*.

    The pairing is the positional zip of the reference (J1) restated as an
    equi-join on (conv_id, turn + 1); ``line_no`` is the rank by
    (conv_id, turn), computed without a single-partition window.
    """
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    u = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("src"))
    a = (conv.filter(F.col("role") == "assistant")
             .select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt")))
    p = u.join(a, ["conv_id", "turn"])
    p = with_order_rank(p, ["conv_id", "turn"], "line_no")
    cols = ["line_no", "src", "tgt"] + (["conv_id", "turn"] if keep_keys else [])
    return p.select(*cols)
