"""Plans that must hold at scale: selection, ranks, blocks and beams without gathering rows."""

import contextlib
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from pairforge.operators import decoding as D
from pairforge.operators.ordering import hash_key, with_line_no, with_order_rank
from pairforge.operators.scan import running, with_blocks
from pairforge.operators.split import exact_split, split_size
from pairforge.sources.files import read_aligned_text


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("frac", [0.0, 0.3, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("digits", [1, 4])
def test_split_is_one_comparison_per_row(spark, frac, digits):
    df = spark.range(997).selectExpr("id AS k", "'x' AS v")
    got = exact_split(df, frac, 42, ["k"], digits=digits)
    order = [r.k for r in df.select("k", hash_key(42, "k").alias("h")).orderBy("h").collect()]
    assert {r.k for r in got.filter("is_train").collect()} == set(order[: split_size(997, frac)])
    text = plan(got)
    assert not any(x in text for x in ("Window", "Join", "Union", "Exchange"))


def test_split_needs_unique_keys(spark):
    with pytest.raises(ValueError, match="unique"):
        exact_split(spark.range(5).selectExpr("1 AS k"), 0.5, 1, ["k"])


def test_order_rank_with_nulls_and_skew(spark):
    rows = [(None if i == 3 else (i * 7) % 50, "p" * i) for i in range(50)]
    got = {r.k: r.line_no for r in with_order_rank(spark.createDataFrame(rows, "k int, v string"), ["k"]).collect()}
    keys = sorted((r[0] for r in rows if r[0] is not None))
    assert got[None] == 0 and [got[k] for k in keys] == list(range(1, 50))


def test_lines_follow_the_numbers_of_their_files(spark, tmp_path):
    for n, name in enumerate(["part-10000", "part-10001", "part-100000"]):
        (tmp_path / name).write_text("\n".join(f"{n}-{k}" for k in range(3)) + "\n")
    lines = with_line_no(spark.read.text(str(tmp_path)))
    got = [r.value for r in lines.orderBy("line_no").collect()]
    assert got == [f"{n}-{k}" for n in range(3) for k in range(3)]
    assert sorted(r.line_no for r in lines.collect()) == list(range(9))
    assert "Window" not in plan(lines) or "[] ASC" not in plan(lines)


def test_unequal_line_counts(spark, tmp_path):
    for name, n in (("a", 3), ("b", 5)):
        (tmp_path / name).write_text("\n".join(map(str, range(n))) + "\n")
    with pytest.raises(ValueError, match="3 vs 5"):
        read_aligned_text(spark, os.path.join(tmp_path, "a"), os.path.join(tmp_path, "b"))


def test_blocks_follow_the_rows_not_the_values(spark):
    draw = random.Random(2)
    # half of the steps lie close together, the others far apart
    steps = sorted({*range(1000), *(draw.randrange(10 ** 12) for _ in range(1000))})
    df = spark.createDataFrame([(0, s, draw.random()) for s in steps] + [(1, 5, 0.5)], "g int, step long, v double")
    sizes = [r["count"] for r in with_blocks(df.filter("g = 0"), ["g"], "step", 100).groupBy("_blk").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 200
    got = {(r.g, r.step): r.m for r in running(df, ["g"], "step", "v", "m", "max", depth=100).collect()}
    best = None
    for r in df.filter("g = 0").orderBy("step").collect():
        assert got[0, r.step] == best
        best = max(best or 0.0, r.v)
    assert got[1, 5] is None


def beam_brute(scores, prefix, max_len, size, diversity, k):
    """The search over all successors, beam by beam."""
    beams = [(list(prefix), 0.0)]
    for step in range(max_len - 1):
        lp = (6.0 + step) ** 0.6 / 6.0 ** 0.6
        cands = []
        for b, (tok, sc) in enumerate(beams):
            if step > 0 and tok[-1] == 2:
                cands.append((sc, b, 0, tok))
                continue
            others = [x for o, (t, _) in enumerate(beams) if o != b for x in t]
            nxt = sorted((-(z - diversity * others.count(t)), t) for p, t, z in scores if p == tok[-1]) or [(0.0 + diversity * others.count(2), 2)]
            rep = 0.5 if step > 0 and len(tok) >= 3 else 1.0
            cands += [((sc - nz) / lp * rep, b, c, tok + [t]) for c, (nz, t) in enumerate(nxt[:k], 1)]
        cands.sort(key=lambda x: (-x[0], x[1], x[2]))
        beams = [(tok, sc) for sc, _, _, tok in cands[:size]]
    return beams


@pytest.mark.parametrize("diversity,vocab", [(0.0, None), (0.7, None), (0.7, 5)])
def test_beams_over_cut_lists_equal_the_search_over_all_successors(spark, diversity, vocab):
    draw = random.Random(int(diversity * 10))
    scores = [(p, t, round(-4 * draw.random(), 3)) for p in range(1, 30) for t in draw.sample(range(2, 30), 25)]
    sc = spark.createDataFrame(scores, "prev_id int, token_id int, logit double")
    src = spark.createDataFrame([(i, [1, i + 3]) for i in range(6)], "ex_id long, prefix array<int>")
    got = D.decode_beam(src, sc, 6, 3, 1.0, diversity, all_beams=True, vocab_size=vocab).collect()
    k = D.candidates_per_beam(3, vocab)
    for i in range(6):
        want = beam_brute(scores, [1, i + 3], 6, 3, diversity, k)
        mine = sorted((r for r in got if r.ex_id == i), key=lambda r: r.beam_idx)
        assert [r.tokens for r in mine] == [t for t, _ in want]
        assert [r.score for r in mine] == pytest.approx([s for _, s in want])


def test_a_beam_step_emits_no_successor_rows(spark):
    sc = spark.createDataFrame([(1, t, -float(t)) for t in range(2, 500)], "prev_id int, token_id int, logit double")
    lists = D.successor_lists(sc, 1.0, 6)
    assert [len(r.succ) for r in lists.collect()] == [6] and "WindowGroupLimit" in plan(lists)
    state = spark.createDataFrame([(0, [([1], 0.0)], 0)], "ex_id long, beams array<struct<tokens: array<int>, score: double>>, step int")
    text = plan(D.expand_beams(state, lists, 3, 0.1))
    assert text.count("Generate") <= 2 and "WindowExec" not in text.split("succ")[0]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_draws_invert_the_cumulative_weights(spark, monkeypatch, block):
    monkeypatch.setattr(D, "DRAW_BLOCK", block)
    sc = spark.createDataFrame([(1, t, -0.1 * (t % 5)) for t in range(3, 20)], "prev_id int, token_id int, logit double")
    tops, blocks = D.draw_tables(sc, block=block)
    assert blocks.count() == -(-17 // block) and tops.first().total == pytest.approx(max(r.cum[-1] for r in blocks.collect()))
    src = spark.range(400).select(F.col("id").alias("ex_id"), F.array(F.lit(1)).alias("prefix"))
    got = {r.ex_id: r.tokens[1] for r in D.decode_random(src, sc, 1, seed=3).collect()}
    import hashlib
    import math
    order = sorted(range(3, 20), key=lambda t: (t % 5, t))
    for i, t in got.items():
        u = (int(hashlib.md5(f"3:{i}:0".encode()).hexdigest()[:13], 16) + 0.5) / 16.0 ** 13
        x, acc = u * sum(math.exp(-0.1 * (t % 5)) for t in order), 0.0
        for t2 in order:
            acc += math.exp(-0.1 * (t2 % 5))
            if acc > x:
                break
        assert t == t2
