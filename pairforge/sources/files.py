"""File sources and sinks: aligned text, pair CSV, vocabulary TSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import NA_STRINGS  # noqa: F401  (documented NA set used by na_to_null)
from ..functions.text import na_to_null, stringify_nulls, strip_text
from ..operators.ordering import with_line_no
from ..session import stored


def read_lines(spark: SparkSession, path: str, col: str = "value") -> DataFrame:
    """UTF-8 text lines with their 0-based ``line_no`` in file order (K1)."""
    return with_line_no(spark.read.text(path)).withColumnRenamed("value", col)


def read_aligned_text(spark: SparkSession, src_path: str, tgt_path: str, strip: bool = True) -> DataFrame:
    """S1 + J1: pair line *i* of ``src_path`` with line *i* of ``tgt_path``.

    Unequal line counts are an error.  Lines are stripped (P2) as the corpus
    builder does."""
    s = read_lines(spark, src_path, "src")
    t = read_lines(spark, tgt_path, "tgt")
    # both numberings are gapless, so the sides have equal counts exactly if no line is alone
    p = stored(s.join(t.withColumn("_t", F.lit(True)), "line_no", "full")
                .select("line_no", "src", "tgt", F.col("_t").isNotNull().alias("_t"), F.col("src").isNotNull().alias("_s")), "aligned")
    if not p.filter(~F.col("_s") | ~F.col("_t")).isEmpty():
        ns, nt = p.agg(F.count_if("_s"), F.count_if("_t")).first()
        raise ValueError(f"line counts differ: {ns} vs {nt}")
    if strip:
        p = p.select("line_no", strip_text("src").alias("src"), strip_text("tgt").alias("tgt"))
    return p.select("line_no", "src", "tgt")


def write_text_lines(df: DataFrame, col: str, path: str, order: str = "line_no") -> None:
    """One row per line, in ``order``; line breaks inside a value would break
    the alignment, so they are rejected."""
    bad = df.filter(F.col(col).rlike("[\\r\\n]")).limit(1).count()
    if bad:
        raise ValueError(f"column {col} holds line breaks")
    df.orderBy(order).select(F.col(col).alias("value")).write.text(path)


def _csv_options(w):
    return (w.option("header", True).option("quote", '"').option("escape", '"')
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_pairs_csv(df: DataFrame, path: str, names=("en", "fr"), cols=("src", "tgt"),
                    order: str = "line_no") -> None:
    """Header row, no index, ``"`` quoting with doubled quotes, no trimming."""
    out = df.orderBy(order).select(*[F.col(c).alias(n) for c, n in zip(cols, names)])
    _csv_options(out.write).option("lineSep", "\n").csv(path)


def read_pairs_csv(spark: SparkSession, path: str, names=("en", "fr"), multi_line: bool = True) -> DataFrame:
    """S3 + P1: the pair CSV back as ``(line_no, src, tgt)``; pandas NA strings
    become null.  The schema is explicit, never inferred.

    ``multi_line`` reads quoted line breaks as part of a value (a file is then
    one task); without it files are split, and the values must hold none."""
    schema = ", ".join(f"`{n}` string" for n in names)
    raw = _csv_options(spark.read.schema(schema)).option("multiLine", multi_line).option("lineSep", "\n").csv(path)
    d = with_line_no(raw)
    return d.select("line_no", na_to_null(names[0]).alias("src"), na_to_null(names[1]).alias("tgt"))


def rename_pairs(df: DataFrame, by: str = "position", names=("en", "fr")) -> DataFrame:
    """To ``src``/``tgt``; the positional form needs exactly two columns."""
    if by == "position":
        if len(df.columns) != 2:
            raise ValueError(f"expected 2 columns, got {len(df.columns)}")
        return df.toDF("src", "tgt")
    return df.withColumnRenamed(names[0], "src").withColumnRenamed(names[1], "tgt")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ensure_pairs(spark: SparkSession, path: str | None, builder) -> DataFrame:
    """Read the stored pair table, or build, store (Parquet) and read it.

    A store without its ``_SUCCESS`` mark is half-written and built anew."""
    if not path:
        raise ValueError("data path not specified")
    if not path_exists(spark, path.rstrip("/") + "/_SUCCESS"):
        # nothing there, or a write that never finished
        builder().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``piece<TAB>score`` lines; id = line position.  Quoting is off (``"``
    is itself a piece)."""
    raw = (spark.read.schema("piece string, score double").option("sep", "\t")
                .option("quote", "\u0000").option("escape", "\u0000").csv(path))
    return with_line_no(raw, "id").select(F.col("id").cast("int"), "piece", "score")


def write_vocab(vocab: DataFrame, path: str) -> None:
    """The same layout, in id order."""
    vocab.orderBy("id").select(F.concat_ws("\t", "piece", F.col("score").cast("string")).alias("value")) \
         .write.text(path)


def tokenizer_corpus(df: DataFrame, col: str, k: int = 3, order: str = "line_no") -> DataFrame:
    """S7 lines: ``k`` consecutive rows joined by TAB (nulls as ``nan``); the
    last line may be short.  ``order`` must be consecutive 0-based positions."""
    g = (df.groupBy(F.floor(F.col(order) / k).cast("long").alias("group_id"))
           .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"),
                                                     stringify_nulls(col).alias("_t")))).alias("_r")))
    return g.select("group_id", F.array_join(F.transform("_r", lambda s: s["_t"]), "\t").alias("line"))


def write_tokenizer_corpus(df: DataFrame, col: str, path: str, k: int = 3, order: str = "line_no") -> None:
    """Write the corpus lines as text in order."""
    tokenizer_corpus(df, col, k, order).orderBy("group_id").select(F.col("line").alias("value")).write.text(path)


def preview(df: DataFrame, n: int = 5, order: str = "line_no") -> DataFrame:
    """The first ``n`` rows in file order (top-n, no full sort)."""
    return df.orderBy(order).limit(n)


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns)."""
    return df.count(), len(df.columns)
