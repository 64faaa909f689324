"""Text steps that are done once per distinct token, against the same steps done text by text."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pairforge.functions import lattice as L
from pairforge.functions.normalize import PORTION_BYTES, nmt_nfkc, text_portions
from pairforge.functions.text import SPACES, clean_text, strip_text
from pairforge.operators import decoding as D
from pairforge.operators import metrics as M
from pairforge.operators import scorer as S
from pairforge.operators import tokenizer as TK
from pairforge.operators import vocab_learn as V


def odd_texts(n, seed=5):
    draw = random.Random(seed)
    kinds = ["a", "b", "ab", " ", "  ", "\t", " ", "▁", "1", "23", "é", "́", "é", "ﬁ", "中", "가", "가", "𝐀", "\u0001", ""]
    return [None, "", " "] + ["".join(draw.choice(kinds) for _ in range(draw.randint(0, 30))) for _ in range(n)]


def seeds(spark):
    pieces = [("▁a", -1.0), ("▁", -2.0), ("a", -2.5), ("b", -2.5), ("ab", -3.0), ("é", -4.0), ("fi", -4.5), ("1", -5.0)]
    rows = [(0, "<pad>", 0.0), (1, "<s>", 0.0), (2, "</s>", 0.0), (3, "<unk>", 0.0)] + [(i + 4, p, s) for i, (p, s) in enumerate(pieces)]
    return rows, spark.createDataFrame(rows, "id int, piece string, score double")


def test_texts_encoded_by_token(spark):
    rows, v = seeds(spark)
    texts = odd_texts(400)
    pattern = TK.cut_pattern([p for i, p, _ in rows if i > 3])
    plain = TK.WordEncoder(rows).encode([TK.split_words(nmt_nfkc(t) if t is not None else "", pattern) for t in texts])
    got = TK.encode(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string"), "t", v).orderBy("k").collect()
    assert [r.ids for r in got] == plain
    assert TK.WordEncoder(rows).encode_texts(pa.array(texts, pa.string()).slice(3, 50), pattern).to_pylist() == plain[3:53]


def test_words_counted_once_by_plan_and_right(spark):
    texts = odd_texts(400)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [w for t in texts if t is not None for w in re.findall(V.word_pattern(), nmt_nfkc(t))]
    assert {r.word: r.freq for r in V.word_counts(df, "t").collect()} == Counter(found)
    assert {r.word: r.freq for r in V.word_counts(df, "t", normalize=False).collect()} == Counter(
        w for t in texts if t is not None for w in re.findall(V.word_pattern(), t))
    # the cleanup stands in the plan once, not once more for a filter
    plan = V._normalized_words(df.select(clean_text("t").alias("_t")), True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1


def test_portions_hold_all_texts_in_order():
    texts = pa.array(["x" * 10, None, "", "y" * 100, "z"] * 7).slice(2)
    for limit in (1, 30, PORTION_BYTES):
        parts = list(text_portions(texts, limit))
        assert [t for p in parts for t in p.to_pylist()] == texts.to_pylist()
        assert all(len(p) == 1 or sum(len(t or "") for t in p.to_pylist()) <= limit for p in parts)


def test_words_together_are_bounded_by_characters():
    words = ["w" * n for n in range(1, 201)] * 40 + ["v" * 300]
    parts = list(L.in_portions(words))
    assert sorted(i for some, _ in parts for i in some) == list(range(len(words)))
    assert all(long or sum(len(words[i]) for i in some) <= L.TOGETHER_CHARS for some, long in parts)


def test_pieces_for_the_best_hold_the_best(spark):
    draw = random.Random(1)
    words = Counter("".join(draw.choice("aaab" if draw.random() < 0.7 else "cdefgh") for _ in range(draw.randint(1, 12))) for _ in range(300))
    wc = spark.createDataFrame(list(words.items()), "word string, freq long")
    whole = {r.piece: r.n for r in V.repeated_pieces(wc, 9).collect()}
    for k in (1, 7, 40, 10_000):
        some = {r.piece: r.n for r in V.repeated_pieces(wc, 9, k).collect()}
        best = sorted(whole, key=lambda p: (-whole[p] * len(p), p))[:k]
        assert all(some.get(p) == whole[p] for p in best) and some.items() <= whole.items()
        assert V._seed_pieces(wc, k, 9) == {p: float(whole[p]) for p in best}


def test_bigrams_of_null_empty_and_long_rows(spark, monkeypatch):
    rows = [[5, 6, 5, 6], None, [], [7], [5, None, 6]]
    df = spark.createDataFrame([(r,) for r in rows], "ids array<int>")
    expected = Counter()
    for r in rows:
        s = [] if r is None else [1, *r, 2]
        expected.update(zip(s, s[1:]))
    for portion in (1, 3, 1_000):
        monkeypatch.setattr(D, "PAIR_PORTION", portion)
        column = pa.array([[9], *rows], pa.list_(pa.int32())).slice(1)
        got = Counter()
        for b in D._pair_counts([pa.RecordBatch.from_arrays([column], ["_s"])]):
            for x in b.to_pylist():
                got[x["prev_id"], x["token_id"]] += x["count"]
        assert got == expected
    got = {(r.prev_id, r.token_id) for r in D.bigram_scores(df, "ids").collect()}
    assert got == {p for p in expected if p[0] is not None}


def test_token_stats_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.createDataFrame([("en", [4, 5, 3]), ("en", [4, 4]), ("fr", [6] * 12), ("fr", None), (None, [3])], "lang string, ids array<int>")
    r = {x.lang: x for x in M.token_stats(df.mapInArrow(counted, df.schema), "ids", ["lang"], 10, 8, (0.5,)).collect()}
    assert seen.value == 5
    assert (r["en"].n_rows, r["en"].n_tokens, r["en"].mean_tokens, r["en"].p50_tokens, r["en"].coverage) == (2, 5, 2.5, 2, 3 / 8)
    assert (r["fr"].n_rows, r["fr"].n_tokens, r["fr"].max_tokens, r["fr"].truncated_share) == (2, 12, 12, 1.0)
    assert r[None].n_tokens == 1


def test_strip_takes_all_white_space(spark):
    t = SPACES + "a" + SPACES + "b" + SPACES
    r = spark.createDataFrame([(t,), (SPACES,), (None,)], "t string").select(strip_text("t").alias("s")).collect()
    assert [x.s for x in r] == ["a" + SPACES + "b", "", None]
    assert sorted(SPACES) == sorted(c for c in map(chr, range(0x110000)) if re.match(r"\s", c))


def test_best_logits_with_ties():
    draw = np.random.default_rng(2)
    for n in (1, 2, 15, 16, 17, 300):
        tokens = np.sort(draw.choice(1_000, n, replace=False))
        z = draw.integers(-4, 4, n) / 2
        z[: n // 5] = -np.inf
        for k in (1, 3, 16):
            assert S._best(tokens, z, k).tolist() == sorted(range(n), key=lambda i: (-z[i], tokens[i]))[:k]


def test_beams_of_a_scorer_equal_the_table_form(spark):
    draw = random.Random(4)
    rows = [(p, t, -draw.choice([0.5, 1.0, 1.5, 2.0])) for p in [1, *range(4, 60)] for t in draw.sample(range(2, 60), 50)]
    scores = spark.createDataFrame(rows, "prev_id int, token_id int, logit double")
    src = spark.createDataFrame([(i, [1, 4 + i], [1, 4 + i]) for i in range(12)], "ex_id long, x_src array<int>, prefix array<int>")
    table = {r.ex_id: r.tokens for r in D.decode_beam(src, scores, 6, 3, 1.0, 0.1).collect()}
    got = {r.ex_id: r.tokens for r in S.decode_with_scorer(src, S.table_scorer(scores), "beam", max_len=6, beam_size=3, diversity=0.1).collect()}
    assert got == table


def test_sources_of_a_scorer_are_dealt_to_all_tasks(spark):
    src = spark.createDataFrame([(i, [4], [1]) for i in range(600)], "ex_id long, x_src array<int>, prefix array<int>").coalesce(1)
    scores = spark.createDataFrame([(1, 4, -1.0), (4, 2, -1.0)], "prev_id int, token_id int, logit double")
    r = S.decode_with_scorer(src, S.table_scorer(scores), "greedy", max_len=3).withColumn("part", F.spark_partition_id())
    rows = r.collect()
    assert [x.tokens for x in rows] == [[1, 4, 2]] * 600
    assert len({x.part for x in rows}) >= min(600, spark.sparkContext.defaultParallelism)
