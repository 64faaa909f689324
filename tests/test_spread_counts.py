"""Work on whole documents is dealt to all cores and keeps its results: cleanup, pair counts, streams, splits without rows."""

import glob
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pairforge.functions.arrays import char_ids
from pairforge.functions.text import SPACES, clean_text, strip_text
from pairforge.operators import decoding as D, tokenizer as TK, vocab_learn as V
from pairforge.constants import WS
from pairforge.functions.normalize import nmt_nfkc
from pairforge.session import spread_table
from pairforge.streaming import jobs as SJ


def odd_texts(n, seed=3):
    draw = random.Random(seed)
    signs = "abzé'_.,!?-½²٣ßİΣς\U0001f600\U0001d49ć▁" + SPACES[:6] + "   " + "\x01\x02\x7f"
    return [None, "", ".", "..", " . ", *("".join(draw.choice(signs) for _ in range(draw.randint(1, 40))) for _ in range(n))]


def test_one_pass_cleans_as_two(spark):
    df = spark.createDataFrame([(t,) for t in odd_texts(800)], "t string")
    two = F.regexp_replace(F.regexp_replace(strip_text(F.lower("t")), f"[^\\p{{L}}\\p{{N}}_'{WS}]", " "), f"[.{WS}]{{2,}}", " ")
    assert df.filter(~clean_text("t").eqNullSafe(two)).count() == 0


@pytest.mark.parametrize("portion", [10, 1_000_000])
def test_pairs_of_texts_equal_pairs_of_their_ids(spark, monkeypatch, portion):
    monkeypatch.setattr(D, "PAIR_PORTION", portion)
    df = spark.createDataFrame([(t,) for t in odd_texts(60)], "t string")

    def rows(d):
        return sorted((r.prev_id, r.token_id, round(r.logit, 9)) for r in d.collect())

    assert rows(D.char_bigram_scores(df, "t")) == rows(D.bigram_scores(df.select(char_ids("t").alias("ids")), "ids"))
    coarse = lambda x: F.when(x > 2, (3 + x % 7).cast("int")).otherwise(x)
    ids = F.transform(char_ids("t"), coarse)
    assert rows(D.char_bigram_scores(df, "t", coarse)) == rows(D.bigram_scores(df.select(ids.alias("ids")), "ids"))
    assert D.char_bigram_scores(df.limit(0), "t").count() == 0


def test_splits_without_rows_do_not_count(spark, tmp_path):
    draw = random.Random(1)
    t = pa.table({"k": list(range(4000)), "t": ["%0200x" % draw.getrandbits(800) for _ in range(4000)]})
    pq.write_table(t, tmp_path / "one.parquet", row_group_size=4000)  # many splits, one row group
    size, cost = (spark.conf.get(f"spark.sql.files.{k}") for k in ("maxPartitionBytes", "openCostInBytes"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = spark.read.parquet(str(tmp_path / "one.parquet"))
        cores = spark.sparkContext.defaultParallelism
        assert df.rdd.getNumPartitions() >= cores
        per = lambda d: [r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect()]
        assert cores == 1 or len(per(df)) == 1
        assert max(per(spread_table(df))) * cores <= 2 * 4000
        assert spread_table(df).agg(F.sum("k")).first()[0] == sum(range(4000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_a_micro_batch_takes_many_files_and_uses_all_tasks(spark, tmp_path):
    from pairforge.plans import io_queries as IO, model_queries as MQ
    docs = spark.createDataFrame([(i, t, "de", "s", 1) for i, t in enumerate(["quit", "Quit", *odd_texts(40)])],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    outs, run = [], SJ.run_to_table
    SJ.run_to_table = lambda *a, **k: outs.append(run(*a, **k)) or outs[-1]
    try:
        got = {r.doc_id: r.ids_md5 for r in IO.q_stream_encode(spark, str(tmp_path)).collect()}
    finally:
        SJ.run_to_table = run
    assert len(glob.glob(os.path.join(outs[0].removeprefix("file:"), "batch_id=*"))) == 1
    want = {r.doc_id: r.ids_md5 for r in MQ.q_encode_documents(spark, str(tmp_path)).collect()}
    assert got == {k: v for k, v in want.items() if k > 1}
    # a batch is dealt to the given number of tasks
    sdf = SJ.parquet_stream(spark, str(tmp_path), "documents", docs.schema, bytes_per_trigger=1 << 30)
    out = run(SJ.encode_stream(sdf, "text", lambda d: d.withColumn("p", F.spark_partition_id()), "doc_id", parts=5), "t_parts")
    assert spark.read.parquet(out).select("p").distinct().count() == 5


def test_plain_words_are_cut_as_all_others():
    pattern = TK.cut_pattern(["▁ab", "c"])
    for t in ("abc", "Ab", "a1", "é", "a'b", "_"):
        if t.isascii() and t.isalpha():
            assert TK.split_words(nmt_nfkc(t), pattern) == ["▁" + t] == TK.re.findall(V.word_pattern(False), nmt_nfkc(t))
