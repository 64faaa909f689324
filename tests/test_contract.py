import __spark_entry__ as E
from pairforge.plans import queries as Q
from pairforge.streaming import jobs as SJ
from pairforge.sources.tables import table


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"len_bucket", "n_pairs", "mean_src_words", "mean_tgt_words", "mean_bleu"}


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_stream_twin_equals_batch(spark, sf):
    batch = {(r.run_id, r.epoch, r.name): (r.value, r.weight) for r in Q.q_epoch_metrics(spark, sf).collect()}
    sdf = SJ.parquet_stream(spark, sf, "events", table(spark, sf, "events").schema)
    out = SJ.run_to_table(SJ.epoch_metrics_stream(sdf), "t_stream", "update")
    r = SJ.latest_per_key(spark.read.parquet(out), ["run_id", "epoch", "name"]).collect()
    stream = {(x.run_id, x.epoch, x.name): (round(x.value, 6), x.weight) for x in r}
    assert stream == batch


def test_encode_stream_equals_batch(spark, sf):
    from pyspark.sql import functions as F

    from pairforge.functions.text import clean_text
    from pairforge.operators import tokenizer as TK
    rows = [(0, "<pad>", 0.0), (1, "<s>", 0.0), (2, "</s>", 0.0), (3, "<unk>", 0.0),
            (4, "▁the", -2.0), (5, "▁", -3.0), (6, "e", -3.5), (7, "th", -4.0), (8, "n", -4.0)]
    v = spark.createDataFrame(rows, "id int, piece string, score double")
    docs = table(spark, sf, "documents")
    sdf = SJ.parquet_stream(spark, sf, "documents", docs.schema)
    enc = SJ.encode_stream(sdf, "text", lambda d: TK.encode(d, "text", v, "ids"), "doc_id")
    out = SJ.run_to_table(enc.select("doc_id", "ids"), "t_encode")
    got = {r.doc_id: r.ids for r in spark.read.parquet(out).collect()}
    batch = TK.encode(docs.filter(F.lower("text") != "quit").select("doc_id", clean_text("text").alias("text")),
                      "text", v, "ids")
    assert got == {r.doc_id: r.ids for r in batch.collect()}
