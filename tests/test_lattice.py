"""Lattices over arrays against the word-by-word rules; seed pieces against brute force."""

import math
import pickle
import random
from collections import Counter

import numpy as np
import pytest

from pairforge.functions.lattice import LONG_WORD, Lattice, Trie, best_path, expected_counts
from pairforge.operators import tokenizer as TK
from pairforge.operators import vocab_learn as V


def draws(n, seed=3):
    draw = random.Random(seed)
    for _ in range(n):
        pieces = sorted({"".join(draw.choice("abcé") for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(1, 25))})
        scores = {p: -draw.choice([1.0, 2.0, 2.5, 3.0, draw.random() * 5]) for p in pieces}
        words = ["".join(draw.choice("abcé中") for _ in range(draw.randint(0, 9))) for _ in range(draw.randint(1, 20))]
        yield draw, pieces, scores, words


def paths(found, pieces, n):
    out = [[] for _ in range(n)]
    for w, p in zip(*found):
        out[w].append(None if p >= len(pieces) else pieces[p])
    return out


def test_best_paths_and_sums_equal_the_word_by_word_rules():
    for draw, pieces, scores, words in draws(120):
        trie = pickle.loads(pickle.dumps(Trie(pieces)))
        lattice, score = Lattice(words, trie, len(pieces)), np.array([scores[p] for p in pieces])
        table = {p: (k, scores[p]) for k, p in enumerate(pieces)}
        assert paths(lattice.best(score, -20.0), pieces, len(words)) == [best_path(w, table, 4, -20.0) for w in words]
        weight, acc = np.array([draw.random() for _ in words]), {}
        z = [expected_counts(w, scores, 4, -20.0, x, acc) for w, x in zip(words, weight)]
        assert np.allclose(lattice.log_likelihoods(score, -20.0), z)
        assert np.allclose(lattice.expected(score, -20.0, weight), [acc.get(p, 0.0) for p in pieces])


def test_paths_without_the_whole_word():
    for _, pieces, scores, _ in draws(60, 4):
        score = np.array([scores[p] for p in pieces])
        found = paths(Lattice(pieces, Trie(pieces), len(pieces)).best(score, -20.0, whole=False), pieces, len(pieces))
        for word, path in zip(pieces, found):
            table = {p: (k, scores[p]) for k, p in enumerate(pieces) if p != word or len(p) == 1}
            assert path == best_path(word, table, 4, -20.0)


def test_no_pieces_and_no_words():
    assert paths(Lattice(["ab", ""], Trie([]), 0).best(np.zeros(0), -5.0), [], 2) == [[None, None], []]
    assert len(Lattice([], Trie(["a"]), 1).best(np.zeros(1), -5.0)[0]) == 0


def test_long_words_follow_the_same_rules(spark):
    rows = [(0, "<pad>", 0.0), (1, "<s>", 0.0), (2, "</s>", 0.0), (3, "<unk>", 0.0), (4, "▁", -3.0), (5, "ab", -1.0), (6, "a", -2.0), (7, "ba", -1.5)]
    encoder = TK.WordEncoder(rows)
    word = "▁" + "aba" * 20 + "zz" + "ab" * 20
    long = "▁" + "aba" * LONG_WORD + "zz" + "ab" * LONG_WORD
    table = {p: (i, s) for i, p, s in rows[4:]}
    for w in (word, long):
        want = [3 if p is None else table[p][0] for p in best_path(w, table, 2, encoder.unknown)]
        assert encoder.encode([[w]])[0] == [i for i, b in zip(want, [None, *want]) if not i == b == 3]


def brute_pieces(words, most):
    n = Counter()
    for w, f in words:
        for i in range(len(w)):
            for j in range(i + 2, min(len(w), i + most) + 1):
                n[w[i:j]] += f
    return {p: k for p, k in n.items() if k >= 2}


@pytest.mark.parametrize("chunk", [3, 7, 256])
def test_pieces_by_length_equal_all_substrings(spark, monkeypatch, chunk):
    monkeypatch.setattr(V, "CHUNK", chunk)
    draw = random.Random(chunk)
    words = [("▁" + "".join(draw.choice("abé") for _ in range(draw.randint(0, 30))), draw.randint(1, 3)) for _ in range(40)]
    words = list(dict(words).items())
    wc = spark.createDataFrame(words, "word string, freq long")
    got = {r.piece: r.n for r in V.repeated_pieces(wc, 6).collect()}
    assert got == brute_pieces(words, 6)


def test_a_word_of_a_million_characters(spark):
    wc = spark.createDataFrame([("▁" + "ab" * 500_000, 1)], "word string, freq long")
    got = {r.piece: r.n for r in V.repeated_pieces(wc, 5).collect()}
    assert got["ab"] == 500_000 and got["ba"] == 499_999 and got["ababa"] == 499_998 and len(got) == 8


def test_seed_vocab(spark):
    df = spark.createDataFrame([("ab ab abc 12 12",), ("ab",), (None,)], "t string")
    got = {r.piece: (r.id, r.score) for r in V.seed_vocab(df, "t", 3, coverage=1.0).collect()}
    # counts x length: ▁ab 4 x 3, ▁a and ab 4 x 2; then the characters
    counts = {"▁ab": 4, "ab": 4, "▁a": 4, "▁": 6, "a": 4, "b": 4, "c": 1, "1": 2, "2": 2}
    total = sum(counts.values())
    assert {p: s for p, (i, s) in got.items() if i > 3} == pytest.approx({p: math.log(n / total) for p, n in counts.items()})
    assert [got[p][0] for p in ("<pad>", "<s>", "</s>", "<unk>", "▁", "a")] == [0, 1, 2, 3, 4, 5]


def test_digits_may_stay_in_words(spark):
    df = spark.createDataFrame([("a12 a12 a12",)] * 20, "t string")
    pieces = {r.piece for r in V.learn_vocab(df, "t", 30, split_digits=False).collect()}
    assert any("12" in p for p in pieces)
    assert not any("12" in p for p in {r.piece for r in V.learn_vocab(df, "t", 30).collect()})


def test_a_sample_of_rows_is_reproducible(spark):
    df = spark.createDataFrame([(chr(0x4E00 + k),) for k in range(400)], "t string")
    few = V.learn_vocab(df, "t", 900, sample_rows=40, seed=1)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, V.learn_vocab(df.repartition(7), "t", 900, sample_rows=40, seed=1).collect()))
    assert few.count() < 100 < V.learn_vocab(df, "t", 900).count()
