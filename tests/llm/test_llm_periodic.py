"""Operator 12 against definitions and brute force."""

import hashlib
import random
from fractions import Fraction

import numpy as np
from hypothesis import given, settings, strategies as st

from pairforge.llm import periodic as P

SF = "/root/testdata/sf0.001"


def longest_lyndon(s, i):
    return max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14))
def test_groups_end_in_the_lyndon_array(s):
    _, dense = np.unique(s, return_inverse=True)
    for order in (dense, dense.max(initial=0) - dense):
        assert P.lyndon_array(order.astype(np.int64)).tolist() == [longest_lyndon(order.tolist(), i) for i in range(len(s))]


def brute(w):
    """Every maximal stretch of every period, tested for a smaller one."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            if n >= max(6, 4 * q) and not any(all(w[x] == w[x + r] for x in range(i, i + n - r)) for r in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(draw):
    w = []
    while draw.random() < 0.8:
        p = [draw.choice(b"abc"[: draw.randint(1, 3)]) for _ in range(draw.randint(1, 5))]
        w += (p * draw.randint(1, 7))[: draw.randint(1, 40)]
    return [bytes([c]) for c in w]


def test_runs_equal_brute_force():
    draw, seen = random.Random(12), 0
    for _ in range(400):
        texts = [periodic_words(draw) for _ in range(draw.randint(1, 3))]
        want = [brute(w) for w in texts]
        assert P.runs_of_texts(texts) == want
        seen += sum(map(len, want))
    assert seen > 1000


def test_equal_hashes_by_chance_are_found_out(monkeypatch):
    draw = random.Random(13)

    class Blunt(P.Hashes):
        def of(self, start, end):
            return super().of(start, end) % np.uint64(3)

    monkeypatch.setattr(P, "Hashes", Blunt)
    for _ in range(60):
        w = periodic_words(draw)
        assert P.runs_of_texts([w]) == [brute(w)]


def test_rare_words_take_no_run_away(monkeypatch):
    draw = random.Random(14)
    texts = [periodic_words(draw) + [b"x%d" % draw.randint(0, 9) for _ in range(30)] + periodic_words(draw) for _ in range(100)]
    want = P.runs_of_texts(texts)
    monkeypatch.setattr(P, "ROUNDS", 0)
    assert P.runs_of_texts(texts) == want == [brute(w) for w in texts]


def test_long_texts():
    n = 200_000
    assert P.runs_of_texts([[b"a"] * n]) == [[(0, n, 1)]]
    block = [b"%d" % (k * k % 9973) for k in range(5000)] + [b"end"]
    assert (1, 8 * 5001, 5001) in P.runs_of_texts([[b"x", *(block * 8), b"y"]])[0]


def digest(words):
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


def test_rows_of_every_kind(spark):
    tie = "a b a b a b a b x c d c d c d c d"
    rows = [(1, None, "p"), (1, "", "q"), (None, " \t\n ", "r"), (2, "a " * 6, "s"), (2, "a " * 6, "s"), (3, tie, "t"), (4, "a a a a a", "u"),
            (5, "é ü " * 9 + "z" + " z" * 30, "v"), (6, "a b c " * 60_000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted((tuple(r) for r in P.digests(P.periodic_runs(df)).collect()), key=str)
    want = [(i, *digest((t or "").encode().split())) for i, t, _ in rows[:-1]]
    want.append((6, 1, 0, 180_000, 3, 60_000_000, hashlib.sha256(b"0,180000,3\n").hexdigest(), hashlib.sha256(b"a b c").hexdigest()))
    assert got == sorted(want, key=str)
    assert P.digests(P.periodic_runs(df.limit(0))).collect() == []


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in P.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for i, text in docs:
        words = P.repeated_words(i, text)
        planted += words != (text or "").encode().split()
        if len(words) < 1500:
            assert got[i] == digest(words), i
    assert planted > 3
