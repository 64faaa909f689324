"""Operator 13: the agenda against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
from pairforge.llm.pieces import CACHED_CHARS, Pieces, decode, digests, disagreements, encode, model_path, op13_sentencepiece

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pieces():
    return Pieces.load(model_path())


def test_hostile_strings_equal_the_library(pieces):
    draw = random.Random(13)
    signs = " ▁  \nab eth\tthe in12é中\U0001F600\0<s></s><unk><0x0A>⁇﻿́"
    for _ in range(5000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 14)))
        ids = pieces.library.encode(text)
        assert pieces.encode(text).tolist() == ids, repr(text)
        assert pieces.decode(ids) == pieces.library.decode(ids), repr(text)


def test_any_ids_decode_as_the_library_does(pieces):
    draw = random.Random(14)
    for _ in range(5000):
        ids = [draw.choice([0, 1, 2, 259, draw.randint(3, 258), draw.randint(3, 258), draw.randint(259, 31999)])
               for _ in range(draw.randint(0, 6))]
        assert pieces.decode(ids) == pieces.library.decode(ids), ids


def test_long_stretches_use_the_heap(pieces):
    draw = random.Random(15)
    for text in ("x" * 5000, "ab" * 3000, " " * 1000, "".join(draw.choice("there is") for _ in range(20000)),
                 "".join(draw.choice("etaoin") for _ in range(CACHED_CHARS * 3))):
        assert pieces.encode(text).tolist() == pieces.library.encode(text)


def test_rows_of_every_kind(spark, pieces):
    rows = [(1, None, "x"), (1, "", "y"), (None, " \n ", "z"), (2, "same", "a"), (2, "same", "a"), (3, "long " * 40000 + "ünï", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = digests(encode(df, model_path()), model_path()).collect()

    def wanted(i, t):
        ids = pieces.library.encode(t or "")
        return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(pieces.library.decode(ids).encode()).hexdigest())

    assert sorted(map(tuple, got), key=str) == sorted((wanted(i, t) for i, t, _ in rows), key=str)
    assert digests(encode(df.limit(0), model_path()), model_path()).collect() == []
    back = decode(encode(df, model_path()), model_path()).filter("doc_id = 2").select("decoded").collect()
    assert [r[0] for r in back] == ["same", "same"]


def test_whole_table_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert disagreements(docs, model_path()).count() == 0
    assert op13_sentencepiece(spark, SF).count() == docs.count()


def test_words_in_use_outlive_a_full_cache(monkeypatch):
    from pairforge.llm import pieces as module
    monkeypatch.setattr(module, "CACHE_WORDS", 60)
    fresh, learned = Pieces(model_path()), []
    learn = fresh.learn
    monkeypatch.setattr(fresh, "learn", lambda known, words, texts: (learned.extend(words), learn(known, words, texts)))
    texts = [f"often seen words stay w{k}x once{k}" for k in range(200)]
    found = [fresh.encode(t).tolist() for t in texts]
    assert found == fresh.library.encode(texts, num_threads=1)
    assert learned.count("often") == 1 and len(fresh.known) + len(fresh.known_before) <= 120


def test_many_rows_decode_as_one(pieces):
    rows = [pieces.encode(t).tolist() for t in ["plain words", "", "a\nb \n\n c", "日本 \U0001F600é", " ▁ x", "\x00\x01"]]
    rows += [[], [pieces.unknown], [1, rows[0][0]], [rows[0][0]] * 3, [pieces.bytes[0xE6]], [pieces.bytes[0xE6], rows[0][0], 2]]
    ends = np.cumsum([0, *map(len, rows)])
    ids = np.array([i for r in rows for i in r], np.int32)
    assert [str(x, "utf-8") if isinstance(x, memoryview) else x.decode() for x in pieces.decode_many(ids, ends)] == pieces.library.decode(rows)
