import re

import pytest
from pyspark.sql import functions as F

from pairforge.functions.lattice import best_path
from pairforge.functions.normalize import nmt_nfkc, normalize_nmt_nfkc
from pairforge.functions.text import clean_text
from pairforge.operators import tokenizer as TK
from pairforge.operators.vocab_learn import learn_vocab


def _vocab(spark, pieces):
    rows = [(0, "<pad>", 0.0), (1, "<s>", 0.0), (2, "</s>", 0.0), (3, "<unk>", 0.0)]
    rows += [(i + 4, p, s) for i, (p, s) in enumerate(pieces)]
    return spark.createDataFrame(rows, "id int, piece string, score double")


def test_nmt_nfkc_literals():
    assert nmt_nfkc("  Hello   World ") == "▁Hello▁World"
    assert nmt_nfkc("ﬁ\u0001x\ty") == "▁fix▁y"
    assert nmt_nfkc("～") == "▁～"
    assert nmt_nfkc("") == "" and nmt_nfkc(None) is None


def test_decode_literals(spark):
    v = _vocab(spark, [(".", -1.0), (",", -1.0)])
    df = spark.createDataFrame([([1, 5, 3, 0, 2],), ([0, 1, 2],)], "ids array<int>")
    got = [r.text for r in TK.decode(df, "ids", v).collect()]
    assert got == [", ⁇ ", ""]


def test_best_path_is_optimal():
    pieces = {"▁a": (4, -1.0), "b": (5, -2.0), "▁ab": (6, -2.5), "a": (7, -3.0), "▁": (8, -1.0)}
    assert best_path("▁ab", pieces, 3, -20.0) == ["▁ab"]
    assert best_path("▁abz", pieces, 3, -20.0) == ["▁ab", None]


def test_encode_unknown_runs(spark):
    v = _vocab(spark, [("▁a", -1.0), ("▁", -2.0)])
    df = spark.createDataFrame([("a xyz a",), ("",)], "t string")
    got = [r.ids for r in TK.encode(df, "t", v).collect()]
    assert got == [[4, 5, 3, 4], []]


def test_learned_vocab_properties_and_roundtrip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("lang = 'en'").select(clean_text("text").alias("t"))
    v = learn_vocab(docs, "t", 2000)
    rows = v.orderBy("id").collect()
    assert [r.piece for r in rows[:4]] == ["<pad>", "<s>", "</s>", "<unk>"]
    pieces = [r.piece for r in rows[4:]]
    assert len(rows) <= 2000 and len(set(pieces)) == len(pieces)
    assert all(len(p) <= 16 for p in pieces)
    assert not any(len(p) > 1 and re.search("[0-9]", p) for p in pieces)
    scores = [r.score for r in rows[4:]]
    assert scores == sorted(scores, reverse=True)
    back = TK.decode(TK.encode(docs, "t", v), "ids", v, "back")
    norm = F.translate(F.regexp_replace(normalize_nmt_nfkc("t"), "^▁", ""), "▁", " ")
    res = back.select((F.col("back") == norm).alias("ok"), F.array_contains("ids", 3).alias("unk")).collect()
    assert res and all(r.ok for r in res if not r.unk)


def test_encode_matches_sentencepiece(spark, sf, tmp_path):
    spm = pytest.importorskip("sentencepiece")
    texts = [r.t for r in spark.read.parquet(f"{sf}/documents.parquet").filter("lang = 'en'")
             .select(clean_text("text").alias("t")).collect()]
    corpus = tmp_path / "c.txt"
    corpus.write_text("\n".join(t.replace("\n", " ") for t in texts), encoding="utf-8")
    prefix = str(tmp_path / "m")
    spm.SentencePieceTrainer.train(input=str(corpus), model_prefix=prefix, vocab_size=1000, model_type="unigram",
                                   bos_id=1, eos_id=2, pad_id=0, unk_id=3, normalization_rule_name="nmt_nfkc",
                                   split_digits=True, minloglevel=2)
    from pairforge.sources.files import read_vocab
    v = read_vocab(spark, prefix + ".vocab")
    sp = spm.SentencePieceProcessor(model_file=prefix + ".model")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, t string")
    got = {r.k: r.ids for r in TK.encode(df, "t", v).collect()}
    same = sum(got[i] == sp.encode_as_ids(t) for i, t in enumerate(texts))
    assert same == len(texts)


def test_pieces_across_digits_and_word_marks_are_found(spark):
    base = [(0, "<pad>", 0.0), (1, "<s>", 0.0), (2, "</s>", 0.0), (3, "<unk>", 0.0)]
    digits = spark.createDataFrame([*base, (4, "▁12", -1.0), (5, "▁", -3.0), (6, "1", -4.0), (7, "2", -4.0)], "id int, piece string, score double")
    df = spark.createDataFrame([("12",), ("12 12",)], "t string")
    assert [r.ids for r in TK.encode(df, "t", digits, "ids").collect()] == [[4], [4, 4]]
    marks = spark.createDataFrame([*base, (4, "▁a▁b", -1.0), (5, "▁a", -3.0), (6, "▁b", -4.0)], "id int, piece string, score double")
    assert TK.encode(spark.createDataFrame([("a b a",)], "t string"), "t", marks, "ids").first().ids == [4, 5]
