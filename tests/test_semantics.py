"""Semantics switches of SURVEY §2.12 and invariance under repartitioning."""

from pyspark.sql import functions as F

from pairforge.operators import batching as B
from pairforge.operators import decoding as D
from pairforge.operators.bleu import sentence_bleu
from pairforge.operators.evaluation import sequence_bleu


def _vocab(spark):
    rows = [(0, "<pad>", 0.0), (1, "<s>", 0.0), (2, "</s>", 0.0), (3, "<unk>", 0.0),
            (4, "▁the", -1.0), (5, "▁cat", -1.0), (6, "▁sat", -1.0)]
    return spark.createDataFrame(rows, "id int, piece string, score double")


def test_q7_hypothesis_mask(spark):
    # label padding at the last position; the prediction there is a real word
    df = spark.createDataFrame([(0, [4, 5, 6], [4, 5, 0])], "ex_id long, pred array<int>, y array<int>")
    by_pred = sequence_bleu(df, "pred", "y", _vocab(spark), hyp_mask="pred").first()
    by_label = sequence_bleu(df, "pred", "y", _vocab(spark), hyp_mask="label").first()
    assert (by_pred.hyp_len, by_label.hyp_len) == (3, 2)
    assert abs(by_label.bleu - 1.0) < 1e-12 and by_pred.bleu < 1.0


def test_q6_greedy_reference_mode_pads_with_eos(spark):
    scores = spark.createDataFrame([(1, 2, 0.0), (5, 6, 0.0), (6, 2, 0.0)], "prev_id int, token_id int, logit double")
    src = spark.createDataFrame([(0, [1]), (1, [5])], "ex_id long, prefix array<int>")
    per_row = {r.ex_id: r.tokens for r in D.decode_greedy(src, scores, 10).collect()}
    ref = {r.ex_id: r.tokens for r in D.decode_greedy(src, scores, 10, mode="reference").collect()}
    assert per_row == {0: [1, 2], 1: [5, 6, 2]}
    assert ref == {0: [1, 2, 2], 1: [5, 6, 2]}


def test_reference_mode_goes_on_behind_eos(spark):
    rows = [(1, 2, 0.0), (2, 9, 0.0), (9, 2, 0.0), (5, 6, 0.0), (6, 2, 0.0)]
    scores = spark.createDataFrame(rows, "prev_id int, token_id int, logit double")
    src = spark.createDataFrame([(0, [1]), (1, [5])], "ex_id long, prefix array<int>")
    ref = {r.ex_id: r.tokens for r in D.decode_greedy(src, scores, 6, mode="reference").collect()}
    assert ref == {0: [1, 2, 9, 2, 9, 2, 9], 1: [5, 6, 2, 9, 2, 9, 2]}


def test_bleu_and_batches_invariant_under_repartitioning(spark):
    words = ["a", "b", "c", "d", "e"]
    rows = [(i, [words[(i + k) % 5] for k in range(i % 6 + 1)], [words[(2 * i + k) % 5] for k in range(i % 4 + 1)])
            for i in range(200)]
    df = spark.createDataFrame(rows, "k long, r array<string>, h array<string>")
    results = []
    for n in (1, 7, 64):
        d = df.repartition(n)
        b = {r.k: round(r.bleu, 12) for r in sentence_bleu(d, "r", "h", ["k"]).collect()}
        bt = {r.line_no: r.batch_id for r in B.assign_batches(B.shuffle_rank(d.withColumnRenamed("k", "line_no"), 5, 1), 16)
              .collect()}
        results.append((b, bt))
    assert results[0] == results[1] == results[2]


def test_shuffle_differs_per_epoch(spark):
    d = spark.range(100).withColumnRenamed("id", "line_no")
    e0 = [r.line_no for r in B.shuffle_rank(d, 1, 0).orderBy("rank").collect()]
    e1 = [r.line_no for r in B.shuffle_rank(d, 1, 1).orderBy("rank").collect()]
    assert sorted(e0) == sorted(e1) == list(range(100)) and e0 != e1
    assert F is not None
