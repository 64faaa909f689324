import math

import pytest

from pyspark.sql import functions as F

from pairforge.functions import arrays as A


def _one(spark, expr, value, typ="array<int>"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr).first()[0]


def test_teacher_forcing_literals(spark):
    cases = [(list(range(10, 17)), list(range(20, 25)), [10, 11, 12, 13, 14, 2], [1, 20, 21, 22], [21, 22, 23, 2]),
             ([], [], [2], [1], [2]),
             ([10], [20], [10, 2], [1], [2])]
    df = spark.createDataFrame([(s, t) for s, t, *_ in cases], "s array<int>, t array<int>")
    x, y = A.teacher_forcing("t", 6)
    got = df.select(A.truncate_with_eos("s", 6).alias("xs"), x.alias("x"), y.alias("y")).collect()
    for r, (_, _, xs, xt, yt) in zip(got, cases):
        assert (r.xs, r.x, r.y) == (xs, xt, yt)


def test_teacher_forcing_standard(spark):
    df = spark.createDataFrame([([20, 21, 22],)], "t array<int>")
    x, y = A.teacher_forcing("t", 6, "standard")
    r = df.select(x.alias("x"), y.alias("y")).first()
    assert r.x == [1, 20, 21, 22] and r.y == [20, 21, 22, 2]


def test_ngrams(spark):
    assert sorted(_one(spark, A.ngrams("v", 3), [1, 2, 3, 1, 2, 3])) == [[1, 2, 3], [2, 3, 1], [3, 1, 2]]
    assert _one(spark, A.ngrams("v", 3), [1, 2]) == []
    assert _one(spark, A.has_repeated_ngram("v", 3), [1, 2, 3, 1, 2, 3]) is True
    assert _one(spark, A.has_repeated_ngram("v", 3), [1, 2, 3, 4]) is False


def test_mask_top_n(spark):
    t = "array<double>"
    assert _one(spark, A.mask_top_n("v", 2), [3.0, 1.0, 3.0, 2.0], t) == [3.0, -1e9, 3.0, -1e9]
    assert _one(spark, A.mask_top_n("v", 2), [3.0, 2.0, 2.0, 1.0], t) == [3.0, 2.0, 2.0, -1e9]


def test_length_penalty(spark):
    df = spark.range(4).select(A.length_penalty(F.col("id")).alias("lp"))
    got = [round(r.lp, 6) for r in df.orderBy(F.col("lp")).collect()]
    assert got == [1.0, 1.096903, 1.188402, 1.275425]


def test_softmax_argmax(spark):
    v = [0.0, 2.0, 0.0, 0.0]
    sm = _one(spark, A.softmax("v"), v, "array<double>")
    assert abs(sum(sm) - 1) < 1e-12
    lsm = _one(spark, A.log_softmax("v"), v, "array<double>")
    assert all(abs(math.exp(a) - b) < 1e-12 for a, b in zip(lsm, sm))
    assert _one(spark, A.argmax("v"), [1.0, 3.0, 3.0], "array<double>") == 1
    assert _one(spark, A.apply_temperature("v", 0.0), [1.0], "array<double>")[0] == pytest.approx(1e5)


def test_pad_and_mask(spark):
    assert _one(spark, A.right_pad("v", 4), [5, 2]) == [5, 2, 0, 0]
    assert _one(spark, A.pad_mask("v"), [5, 0]) == [True, False]
    assert _one(spark, A.strip_pad("v"), [0, 5, 0, 2]) == [5, 2]
    assert _one(spark, A.char_ids(F.lit("")), [1]) == []
