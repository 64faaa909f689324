from pyspark.sql import functions as F

from pairforge.operators.bleu import mean_bleu, sentence_bleu
from pairforge.operators.metrics import label_smoothed_ce, token_accuracy


def test_sentence_bleu_literals(spark):
    cases = [("the cat sat", "the cat", 0.606531), ("the", "the", 0.316228),
             ("the cat", "the the the", 0.129099), ("the", "dog", 0.0), ("the", "", 0.0)]
    df = spark.createDataFrame([(i, r.split(), h.split()) for i, (r, h, _) in enumerate(cases)],
                               "k int, r array<string>, h array<string>")
    got = {row.k: round(row.bleu, 6) for row in sentence_bleu(df, "r", "h", ["k"]).collect()}
    assert got == {i: c[2] for i, c in enumerate(cases)}


def test_bleu_identity_and_mean(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"])], "k int, r array<string>")
    b = sentence_bleu(df.withColumn("h", F.col("r")), "r", "h", ["k"])
    assert abs(b.first().bleu - 1.0) < 1e-12
    assert mean_bleu(b.filter("k < 0")).first()[0] == 0.0


def test_loss_literal(spark):
    df = spark.createDataFrame([([0.0, 2.0, 0.0, 0.0], 1), ([1.0, 1.0, 1.0, 1.0], 0)], "l array<double>, y int")
    r = label_smoothed_ce(df, "l", "y").first()
    assert r.n_tokens == 1 and round(r.loss, 6) == 0.636425


def test_accuracy_literal(spark):
    df = spark.createDataFrame([([3, 4, 5, 6], [3, 9, 5, 0])], "p array<int>, y array<int>")
    r = token_accuracy(df, "p", "y").first()
    assert (r.correct, r.counted) == (2, 3)
    # micro average over rows, not a mean of per-row means
    df2 = spark.createDataFrame([([1], [1]), ([1, 1, 1], [2, 2, 1])], "p array<int>, y array<int>")
    assert abs(token_accuracy(df2, "p", "y").first().accuracy - 0.5) < 1e-12


def test_token_stats_coverage(spark):
    from pairforge.operators.metrics import token_stats
    df = spark.createDataFrame([("en", [4, 5, 3]), ("en", [4, 4]), ("fr", [6] * 12)], "lang string, ids array<int>")
    r = {x.lang: x for x in token_stats(df, "ids", ["lang"], 10, 8).collect()}
    assert (r["en"].n_rows, r["en"].n_tokens, r["en"].max_tokens) == (2, 5, 3)
    assert abs(r["en"].unk_share - 0.2) < 1e-12 and abs(r["en"].coverage - 3 / 8) < 1e-12
    assert r["fr"].truncated_share == 1.0 and abs(r["fr"].coverage - 1 / 8) < 1e-12
