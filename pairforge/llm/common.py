"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path

#: fixed value: a word of the contracts.  ``bytes.split()`` splits on exactly these
#: ASCII white-space bytes, so ``text.encode().split()`` gives the same words.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 400
#: a process keeps at most this many cached words (values are pure functions of the
#: word, so clearing the cache never changes a result)
CACHE_WORDS = 200_000

#: Spark removes the shuffle files of a query when it ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_HASHES: dict[bytes, int] = {}
#: paths of the tables that ``stage`` has written and that still stand
_MADE: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor costs at most the current step.  The shuffle files
    of the step go as soon as it is written, so a job of many steps holds the
    disk of its largest one."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _MADE.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_stage(df: DataFrame) -> None:
    """Delete a table that ``stage`` wrote; nothing may read it any more."""
    _MADE.remove(df.staged_path)
    _delete(df.sparkSession, df.staged_path)


@contextmanager
def temporary(spark: SparkSession):
    """Tables that ``stage`` writes inside go at the end, but for those given to the yielded function.

    What leaves the block must read only tables that are kept."""
    start, kept = len(_MADE), []
    yield lambda df: kept.append(df.staged_path) or df
    made, _MADE[start:] = _MADE[start:], kept
    for path in set(made) - set(kept):
        _delete(spark, path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch, so that a Python worker holds a few MB of text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def spread_rows(df: DataFrame) -> DataFrame:
    """One more partition per core where a scan gives fewer partitions than cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def encode_text(text) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def lower_ascii(data: bytes) -> bytes:
    """A-Z only (``bytes.lower`` leaves all other bytes alone)."""
    return data.lower()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit names of words; a bounded cache spares repeated hashing."""
    cache = _HASHES
    if len(cache) > CACHE_WORDS:
        cache.clear()
    try:
        return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    except KeyError:
        h = xxhash.xxh64_intdigest
        for w in set(words):
            if w not in cache:
                cache[w] = h(w)
        return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def forget_words() -> None:
    """Free what a task leaves behind in its Python process: the next step may need the memory."""
    _HASHES.clear()
    pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit name of an ordered pair."""
    with np.errstate(over="ignore"):
        return mix(mix(a + np.uint64(0x9E3779B97F4A7C15 + salt)) + b * np.uint64(0xD6E8FEB86659FD93))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Names of all n consecutive names (empty if there are fewer)."""
    if len(h) < n:
        return h[:0]
    out = h[: len(h) - n + 1]
    for k in range(1, n):
        out = combine(out, h[k: len(h) - n + 1 + k], k)
    return out


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def crc32_mod(col, k: int):
    """crc32 of the id as text, modulo ``k`` (null id: crc32 of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % k


#: by category: number signs such as ² or ½ are no letters
LETTER = regex.compile(r"\p{L}")
