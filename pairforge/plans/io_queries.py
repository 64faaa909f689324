"""Registered queries for sources, sinks and streams (S1-S8, ST1, ST2)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators import tokenizer as TK
from ..session import scratch_path
from ..sources import files as FS
from ..sources.tables import conversation_pairs, table
from ..streaming import jobs as SJ
from .queries import _round


def _flat(c):
    """A line-aligned corpus cannot hold line breaks: they become spaces."""
    return F.regexp_replace(F.col(c), "\r\n|\r|\n", " ")


def q_aligned_text(spark, sf_dir):
    """S1 + K1 + J1 + P2: both sides written as line files, read back and zipped."""
    p = conversation_pairs(spark, sf_dir).select("line_no", _flat("src").alias("src"), _flat("tgt").alias("tgt"))
    base = scratch_path(spark, "aligned")
    FS.write_text_lines(p, "src", os.path.join(base, "src"))
    FS.write_text_lines(p, "tgt", os.path.join(base, "tgt"))
    return FS.read_aligned_text(spark, os.path.join(base, "src"), os.path.join(base, "tgt"))


def q_pairs_csv_roundtrip(spark, sf_dir):
    """S2 + S3: the aligned pairs through a pandas-compatible CSV and back."""
    p = q_aligned_text(spark, sf_dir)
    path = scratch_path(spark, "pairs_csv")
    FS.write_pairs_csv(p, path)
    return FS.read_pairs_csv(spark, path)


def q_ensure_pairs(spark, sf_dir):
    """Load-or-build of the pair table: the first call builds, the second one loads."""
    path = scratch_path(spark, "pairs_store")
    FS.ensure_pairs(spark, path, lambda: conversation_pairs(spark, sf_dir))

    def never():
        raise AssertionError("a finished store is loaded, not built")
    return FS.ensure_pairs(spark, path, never)


def q_pairs_csv_raw(spark, sf_dir):
    """S2 + S3 on raw texts: quoted line breaks survive the round trip."""
    path = scratch_path(spark, "pairs_csv_raw")
    FS.write_pairs_csv(conversation_pairs(spark, sf_dir), path)
    return FS.read_pairs_csv(spark, path)


def q_preview(spark, sf_dir):
    """The first five pairs in file order."""
    return FS.preview(conversation_pairs(spark, sf_dir), 5)


def q_vocab_roundtrip(spark, sf_dir):
    """S5 + S6: a vocabulary written as TSV and read back."""
    from .model_queries import document_seeds
    path = scratch_path(spark, "vocab_tsv")
    FS.write_vocab(document_seeds(spark, sf_dir), path)
    return FS.read_vocab(spark, path).select("id", "piece", _round("score", "score"))


def q_stream_encode(spark, sf_dir):
    """ST1: documents as a file stream → quit filter → cleanup → T3 → Parquet sink."""
    from .model_queries import document_seeds
    v = document_seeds(spark, sf_dir)
    schema = table(spark, sf_dir, "documents").schema
    sdf = SJ.parquet_stream(spark, sf_dir, "documents", schema, bytes_per_trigger=1 << 30)
    enc = SJ.encode_stream(sdf, "text", lambda d: TK.encode(d, "text", v, "ids"), "doc_id",
                           parts=4 * spark.sparkContext.defaultParallelism)
    out = SJ.run_to_table(enc.select("doc_id", "ids"), "stream_encode")
    return spark.read.parquet(out).select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                                          F.md5(F.array_join("ids", ",")).alias("ids_md5"))


def q_stream_epoch_metrics(spark, sf_dir):
    """ST2: epoch metrics from the events stream (update mode, watermark on ts)."""
    schema = table(spark, sf_dir, "events").schema
    sdf = SJ.parquet_stream(spark, sf_dir, "events", schema)
    out = SJ.run_to_table(SJ.epoch_metrics_stream(sdf), "stream_epoch_metrics", "update")
    r = SJ.latest_per_key(spark.read.parquet(out), ["run_id", "epoch", "name"])
    return r.select("run_id", "epoch", "name", _round("value", "value"), "weight", "n_steps")


REGISTRY = {
    "aligned_text": q_aligned_text,
    "pairs_csv_roundtrip": q_pairs_csv_roundtrip,
    "ensure_pairs": q_ensure_pairs,
    "pairs_csv_raw": q_pairs_csv_raw,
    "preview": q_preview,
    "vocab_roundtrip": q_vocab_roundtrip,
    "stream_encode": q_stream_encode,
    "stream_epoch_metrics": q_stream_epoch_metrics,
}
