"""Streams over folders of files, and translation that sees its whole source."""

import os

from pyspark.sql import functions as F

from pairforge.operators.translate import source_scorer, translate
from pairforge.plans import queries as Q
from pairforge.sources.tables import table
from pairforge.streaming import jobs as SJ


def test_metrics_of_files_in_any_order_and_counted_drops(spark, sf, tmp_path):
    events = table(spark, sf, "events")
    day = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 86400)
    days = sorted(r[0] for r in events.select(day).distinct().collect())
    folder = tmp_path / "events.parquet"
    third = max(1, len(days) // 3)
    cuts = [days[2 * third:], days[third:2 * third], days[:third]]  # the oldest days come last
    for k, part in enumerate(cuts):
        d = tmp_path / f"part{k}"
        events.filter(day.isin(part)).coalesce(1).write.parquet(str(d))
        folder.mkdir(exist_ok=True)
        f = next(x for x in os.listdir(d) if x.endswith(".parquet"))
        os.rename(d / f, folder / f"part-{k}.parquet")
        os.utime(folder / f"part-{k}.parquet", (1_700_000_000 + 100 * k, 1_700_000_000 + 100 * k))
    batch = {(r.run_id, r.epoch, r.name): r.weight for r in Q.q_epoch_metrics(spark, sf).collect()}

    def run(watermark, dropped):
        sdf = SJ.parquet_stream(spark, str(tmp_path), "events", events.schema)
        out = SJ.run_to_table(SJ.epoch_metrics_stream(sdf, watermark), "t", "update", dropped=dropped)
        return {(x.run_id, x.epoch, x.name): x.weight
                for x in SJ.latest_per_key(spark.read.parquet(out), ["run_id", "epoch", "name"]).collect()}

    none, some = [], []
    assert run(None, none) == batch and none == [0]
    late = run("1 hour", some)
    assert len(late) < len(batch) and some[0] > 0


def test_restart_on_a_path_goes_on_and_repeats_nothing(spark, tmp_path):
    src, out = str(tmp_path / "t.parquet"), str(tmp_path / "out")
    spark.range(5).selectExpr("id as doc_id", "if(id = 2, 'quit', if(id = 3, null, 'x')) as text").coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for _ in range(2):
        sdf = SJ.encode_stream(SJ.parquet_stream(spark, str(tmp_path), "t", schema), "text", lambda d: d, "doc_id")
        SJ.run_to_table(sdf, "t", out=out)
        assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == [0, 1, 3, 4]


def test_last_source_word_changes_the_translation(spark):
    rows = [(0, "<pad>", 0.0), (1, "<s>", 0.0), (2, "</s>", 0.0), (3, "<unk>", 0.0), (4, "▁a", -1.0), (5, "▁b", -1.0), (6, "▁c", -1.0)]
    vocab = spark.createDataFrame(rows, "id int, piece string, score double")
    scores = spark.createDataFrame([(p, t, 0.0) for p in (1, 4, 5, 6) for t in (4, 5, 6, 2)], "prev_id int, token_id int, logit double")
    df = spark.createDataFrame([(0, "a b"), (1, "a c"), (2, "")], "line_no long, src string")
    for strategy, options in (("greedy", {}), ("beam", {"beam_size": 2})):
        got = {r.line_no: r for r in translate(df, vocab, vocab, source_scorer(scores), strategy, max_len=4, pad_to=8, **options).collect()}
        assert set(got) == {0, 1, 2} and got[0].translation != got[1].translation
        assert all(len(r.tokens) == 8 for r in got.values())
