"""Structured Streaming twins of the batch jobs (ST1, ST2).

Both write through ``foreachBatch`` into a Parquet folder, one folder per
micro-batch, with a streaming checkpoint next to it: a batch that is tried
again replaces its folder, and a query restarted on a given path goes on
where it stopped.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import clean_text
from ..session import scratch_path


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def parquet_stream(spark: SparkSession, folder: str, name: str, schema, files_per_trigger: int = 1,
                   bytes_per_trigger: int | None = None) -> DataFrame:
    """A file stream over the table ``folder/name.parquet``: a folder of part files, or one file.

    With ``bytes_per_trigger`` a micro-batch takes as many files as that holds (one at least)."""
    size = ("maxFilesPerTrigger", files_per_trigger) if bytes_per_trigger is None else ("maxBytesPerTrigger", bytes_per_trigger)
    r = spark.readStream.schema(schema).option(*size)
    path = os.path.join(folder, f"{name}.parquet")
    if is_folder(spark, path):
        return r.parquet(path)
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def encode_stream(sdf: DataFrame, text_col: str, encoder, key_col: str, clean: bool = True,
                  stop_word: str = "quit", parts: int | None = None) -> DataFrame:
    """ST1: stateless stream: drop ``quit`` lines → cleanup (P3) → ``encoder``.

    With ``parts`` the rows of a micro-batch are dealt to so many tasks: a file, or a row group
    of it, would otherwise be one task."""
    if parts:
        sdf = sdf.select(key_col, text_col).repartition(parts)
    d = sdf.filter(~F.lower(F.col(text_col)).eqNullSafe(F.lit(stop_word)))  # null text stays
    if clean:
        d = d.withColumn(text_col, clean_text(text_col))
    return encoder(d.select(key_col, text_col))


def run_to_table(sdf: DataFrame, name: str, output_mode: str = "append", out: str | None = None,
                 dropped: list | None = None) -> str:
    """Run a stream until its input is consumed; returns the output folder.

    Every micro-batch writes ``batch_id=N`` anew, so a batch that is tried again
    leaves no duplicates.  With a given ``out`` a later call goes on where this
    one ended.  ``dropped`` gets the number of rows older than the watermark."""
    spark = sdf.sparkSession
    out = out or scratch_path(spark, name)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    q = (sdf.writeStream.outputMode(output_mode).foreachBatch(sink)
            .option("checkpointLocation", os.path.join(out + "_checkpoint"))
            .trigger(availableNow=True).start())
    q.awaitTermination()
    if dropped is not None:
        dropped.append(sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                           for s in json.loads(p.json if isinstance(p.json, str) else json.dumps(p))["stateOperators"]))
    return out


def epoch_metrics_stream(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """ST2: A7 on a stream, in update mode.

    Without a watermark no event is ever late: files may come in any order and
    the state holds one row per (run, day, name).  A ``watermark`` on ``ts`` bounds
    the state, and events older than it are dropped (``run_to_table`` counts them)."""
    d = events.withColumn("ts", F.col("ts").cast("timestamp"))
    d = d.withWatermark("ts", watermark) if watermark else d
    d = (d.select(F.col("user_id").alias("run_id"),
                       F.window("ts", "1 day").alias("w"),
                       F.col("event_type").alias("name"),
                       F.col("value").cast("double").alias("value"),
                       (F.get_json_object("props", "$.k").cast("long") + 1).alias("weight")))
    return (d.groupBy("run_id", "w", "name")
             .agg(F.sum(F.col("value") * F.col("weight")).alias("_vw"), F.sum("weight").alias("weight"),
                  F.count(F.lit(1)).alias("n_steps"))
             .select("run_id", F.floor(F.unix_timestamp(F.col("w.start")) / 86400).cast("long").alias("epoch"),
                     "name", (F.col("_vw") / F.col("weight")).alias("value"), "weight", "n_steps"))


def latest_per_key(df: DataFrame, keys) -> DataFrame:
    """Final state of an update-mode output: the row of the last batch per key."""
    cols = [c for c in df.columns if c not in keys and c != "batch_id"]
    agg = F.max_by(F.struct(*cols), "batch_id").alias("_s")
    return df.groupBy(*keys).agg(agg).select(*keys, *[F.col(f"_s.{c}").alias(c) for c in cols])
