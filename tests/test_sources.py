import os

import pytest

from pairforge.functions.text import drop_missing
from pairforge.sources import files as FS


def test_aligned_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n two \nthree\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("un\ndeux\ntrois\n", encoding="utf-8")
    (tmp_path / "c.txt").write_text("un\ndeux\n", encoding="utf-8")
    rows = FS.read_aligned_text(spark, str(tmp_path / "a.txt"), str(tmp_path / "b.txt")).orderBy("line_no").collect()
    assert [(r.line_no, r.src, r.tgt) for r in rows] == [(0, "one", "un"), (1, "two", "deux"), (2, "three", "trois")]
    with pytest.raises(ValueError):
        FS.read_aligned_text(spark, str(tmp_path / "a.txt"), str(tmp_path / "c.txt"))


def test_pandas_csv_missing_values(spark, tmp_path):
    text = ('en,fr\na,b\n,c\n"say ""hi"", ok",\nNA,d\nnan,e\n"x,y",f\n"back\\slash ""q\\""",g\n'
            "None,h\nnull,i\n pad ,j\nn/a,k\n")
    p = tmp_path / "pairs.csv"
    p.write_text(text, encoding="utf-8")
    d = drop_missing(FS.read_pairs_csv(spark, str(p)), ["src", "tgt"])
    got = [(r.src, r.tgt) for r in d.orderBy("line_no").collect()]
    assert got == [("a", "b"), ("x,y", "f"), ('back\\slash "q\\"', "g"), (" pad ", "j")]


def test_csv_roundtrip_keeps_spaces(spark, tmp_path):
    df = spark.createDataFrame([(0, " pad ", 'q"uote'), (1, "a,b", "tab\there")], "line_no long, src string, tgt string")
    path = str(tmp_path / "out")
    FS.write_pairs_csv(df, path)
    back = [(r.src, r.tgt) for r in FS.read_pairs_csv(spark, path).orderBy("line_no").collect()]
    assert back == [(" pad ", 'q"uote'), ("a,b", "tab\there")]


def test_vocab_tsv_with_quote_piece(spark, tmp_path):
    p = tmp_path / "v.vocab"
    p.write_text('<pad>\t0\n<s>\t0\n</s>\t0\n<unk>\t0\n"\t-3.5\n▁a\t-4\n', encoding="utf-8")
    v = FS.read_vocab(spark, str(p)).orderBy("id").collect()
    assert [(r.id, r.piece, r.score) for r in v][4:] == [(4, '"', -3.5), (5, "▁a", -4.0)]
    out = str(tmp_path / "w")
    FS.write_vocab(FS.read_vocab(spark, str(p)), out)
    again = FS.read_vocab(spark, out).orderBy("id").collect()
    assert [(r.piece, r.score) for r in again] == [(r.piece, r.score) for r in v]


def test_ensure_pairs(spark, tmp_path):
    path = str(tmp_path / "store")
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(0, "a", "b")], "line_no long, src string, tgt string")
    assert FS.ensure_pairs(spark, path, build).count() == 1
    assert FS.ensure_pairs(spark, path, build).count() == 1
    assert len(calls) == 1 and os.path.isdir(path)
    with pytest.raises(ValueError):
        FS.ensure_pairs(spark, None, build)


def test_tokenizer_corpus_file_and_line_guard(spark, tmp_path):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, None)], "line_no long, t string")
    out = str(tmp_path / "corpus")
    FS.write_tokenizer_corpus(df, "t", out)
    lines = [r.value for r in FS.read_lines(spark, out).orderBy("line_no").collect()]
    assert lines == ["a\tb\tc", "d\tnan"]
    bad = spark.createDataFrame([(0, "x\ny")], "line_no long, t string")
    with pytest.raises(ValueError):
        FS.write_text_lines(bad, "t", str(tmp_path / "bad"))


def test_rename_preview_shape(spark):
    df = spark.createDataFrame([("a", "b")], "en string, fr string")
    assert FS.rename_pairs(df).columns == ["src", "tgt"]
    assert FS.rename_pairs(df, by="name").columns == ["src", "tgt"]
    with pytest.raises(ValueError):
        FS.rename_pairs(df.withColumn("x", df.en))
    d = spark.createDataFrame([(i, str(i), str(i)) for i in range(10)], "line_no long, src string, tgt string")
    assert [r.line_no for r in FS.preview(d.repartition(3), 3).collect()] == [0, 1, 2]
    assert FS.shape(d) == (10, 3)


def test_pair_csv_keeps_line_breaks(spark, tmp_path):
    rows = [(0, "one\ntwo\"", "un\r\ndeux"), (1, "a,b", " pad "), (2, "NA", "x")]
    p = str(tmp_path / "csv")
    FS.write_pairs_csv(spark.createDataFrame(rows, "line_no long, src string, tgt string"), p)
    got = [tuple(r) for r in FS.read_pairs_csv(spark, p).orderBy("line_no").collect()]
    assert got == [rows[0], rows[1], (2, None, "x")]


def test_half_written_store_is_built_anew(spark, tmp_path):
    p = str(tmp_path / "store")
    FS.ensure_pairs(spark, p, lambda: spark.range(3))
    (tmp_path / "store" / "_SUCCESS").unlink()
    assert FS.ensure_pairs(spark, p, lambda: spark.range(5)).count() == 5
    assert FS.ensure_pairs(spark, p, lambda: spark.range(9)).count() == 5


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    from pairforge import session as SE

    class Conf:
        def get(self, k, d=None):
            return d

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(k):
                raise KeyError(k)

    monkeypatch.setattr(SE, "ship_package", lambda s: None)
    import pytest
    with pytest.raises(ValueError, match="shared"):
        SE.ensure_checkpoint_dir(Session())
