"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "pairforge",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster this is ``spark.checkpoint.dir`` as configured for the
    session; without it a cluster run is refused.  Only a local session gets a
    folder of our own.
    """
    sc = spark.sparkContext
    ship_package(spark)
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if not conf_dir:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is not set: a folder shared by all executors of {master} is needed")
        conf_dir = tempfile.mkdtemp(prefix="pairforge-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def spread(df):
    """Spread rows over all cores when a scan has fewer partitions than cores.

    CPU-heavy per-row work (regexes over whole documents, tokenization) on an
    input of a few large files would otherwise run in a few tasks.  On a big
    input the scan already has many more partitions than cores and this is a
    no-op, so no shuffle is added at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def spread_table(df):
    """Spread a table that is read from files over all cores, by its rows.

    A split of a file may hold no rows (a row group is read by one task, however many splits
    the file has), so splits alone don't tell: one job over no columns counts the rows of each.
    A table whose largest split is more than twice a core's share is dealt anew."""
    from pyspark.sql import functions as F

    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits >= cores:
        rows = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
        most, total = rows.agg(F.max("n"), F.sum("n")).first()
        if (most or 0) * cores <= 2 * (total or 0):
            return df
    return df.repartition(max(cores, splits))


def materialize(df):
    """Cut lineage: a reliable checkpoint in the shared checkpoint folder.

    The frame is persisted first so that the checkpoint write reads the
    computed partitions instead of computing them a second time; the
    checkpointed frame keeps the partitioning of its plan.
    """
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    d = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = d.checkpoint(eager=True)
    d.unpersist()
    return out


def stored(df, name: str):
    """Cut lineage: write a table into the shared checkpoint folder and read it back.

    Computed once (a checkpoint needs a copy in memory for that); it leaves no
    partitioning behind, which :func:`materialize` keeps."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def drop_stored(df) -> None:
    """Delete a table that :func:`stored` wrote; nothing may read it any more."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: a table that every task holds may have this many bytes
BROADCAST_BYTES = 128 << 20


def _bytes_of(col, t):
    """Size of a value in memory, about."""
    from pyspark.sql import functions as F, types as T

    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)) + 16
    if isinstance(t, T.ArrayType):
        if isinstance(t.elementType, (T.StringType, T.BinaryType, T.ArrayType)):
            return F.aggregate(F.coalesce(col, F.array().cast(t)), F.lit(16).cast("long"),
                               lambda n, x: n + _bytes_of(x, t.elementType).cast("long"))
        fields = len(t.elementType.fields) + 1 if isinstance(t.elementType, T.StructType) else 1
        return F.greatest(F.size(col), F.lit(0)) * (8 * fields) + 16
    return F.lit(16)


def count_and_fit(df, limit: int = BROADCAST_BYTES) -> tuple[int, bool]:
    """Number of rows of a table, and whether it is small enough to be broadcast: one job adds up its bytes."""
    from pyspark.sql import functions as F

    size = sum((_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16)).cast("long")
    n, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return n, (total or 0) <= limit


def fits_broadcast(df, limit: int = BROADCAST_BYTES) -> bool:
    return count_and_fit(df, limit)[1]


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (once per context)."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="pairforge-py-"), "pairforge.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
