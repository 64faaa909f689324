from pyspark.sql import functions as F

from pairforge.operators import batching as B
from pairforge.operators.ordering import with_hash_rank, with_line_no, with_order_rank
from pairforge.operators.split import exact_split, split_size
from pairforge.sources.files import tokenizer_corpus


def test_split_size():
    assert split_size(2007723, 0.9) == 1806951
    assert split_size(5, 0.5) == 2


def test_exact_split_properties(spark):
    for n, frac in [(5, 0.5), (1000, 0.9), (777, 0.33)]:
        df = spark.range(n).withColumnRenamed("id", "line_no")
        for parts in (1, 7):
            s = exact_split(df.repartition(parts), frac, 42, ["line_no"]).collect()
            train = {r.line_no for r in s if r.is_train}
            assert len(s) == n and len({r.line_no for r in s}) == n
            assert len(train) == split_size(n, frac)
            if parts == 1:
                first = train
            else:
                assert train == first


def test_hash_rank_is_a_permutation(spark):
    df = spark.range(1000).withColumnRenamed("id", "line_no")
    r = with_hash_rank(df.repartition(5), 3, ["line_no"]).collect()
    assert sorted(x["rank"] for x in r) == list(range(1000))


def test_order_rank_and_line_no(spark, tmp_path):
    df = spark.createDataFrame([(k // 10, k % 10) for k in range(250)], "a long, b long").repartition(6)
    r = with_order_rank(df, ["a", "b"], "line_no", 4).collect()
    assert all(x.line_no == x.a * 10 + x.b for x in r)
    p = str(tmp_path / "lines")
    spark.createDataFrame([(f"l{i}",) for i in range(300)], "value string").coalesce(3).write.text(p)
    lines = with_line_no(spark.read.text(p)).collect()
    files = sorted({x.value for x in lines})
    assert sorted(x.line_no for x in lines) == list(range(300)) and len(files) == 300


def test_batches_rectangular(spark):
    df = spark.createDataFrame([(i, list(range(i % 7 + 1))) for i in range(50)], "line_no long, x array<int>")
    b = B.assign_batches(B.shuffle_rank(df, 1, 0), 16)
    padded = B.pad_batches(b, ["x"]).groupBy("batch_id").agg(F.collect_set(F.size("x")).alias("s")).collect()
    assert all(len(r.s) == 1 for r in padded)
    sizes = sorted(r[1] for r in b.groupBy("batch_id").count().collect())
    assert sizes == [2, 16, 16, 16]
    c = B.collate(b, ["x"]).collect()
    assert all(len({len(row) for row in r.x}) == 1 for r in c)


def test_padding_literal(spark):
    df = spark.createDataFrame([(0, 0, [5, 2]), (1, 0, [6, 7, 8, 2])], "rank long, batch_id long, x array<int>")
    assert B.collate(df, ["x"]).first().x == [[5, 2, 0, 0], [6, 7, 8, 2]]


def test_corpus_lines(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, None)], "line_no long, t string")
    got = sorted((r.group_id, r.line) for r in tokenizer_corpus(df, "t").collect())
    assert got == [(0, "a\tb\tc"), (1, "d\tnan")]
