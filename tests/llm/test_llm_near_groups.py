"""Groups of linked documents against brute force."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairforge.llm import jaccard as J, near_groups as G


def texts(seed, n_docs=120):
    draw = random.Random(seed)
    common = " ".join(f"c{k}" for k in range(25))
    out = []
    for i in range(n_docs):
        if out and draw.random() < 0.6:
            words = draw.choice(out).split()
            for _ in range(draw.randint(0, 3)):
                if words:
                    words[draw.randrange(len(words))] = f"e{draw.randint(0, 5)}"
            words += ["tail"] * draw.randint(0, 2)
        else:
            words = [f"w{draw.randint(0, 400)}" for _ in range(draw.choice([0, 1, 3, 8, 40, 90]))]
            if draw.random() < 0.5:
                words += common.split()
        out.append(" ".join(words))
    return out


def brute(docs, n, t):
    sets = [set(J.shingle_set(x, n).tolist()) for x in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and t.linked(len(sets[i]), len(sets[j]), len(sets[i] & sets[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(docs))]


@pytest.mark.parametrize("seed,n,num,block", [(1, 5, 80, 2048), (2, 5, 80, 3), (3, 3, 90, 2), (4, 2, 70, 5), (5, 5, 80, 2)])
def test_groups_equal_brute_force(spark, monkeypatch, seed, n, num, block):
    monkeypatch.setattr(G, "LIST_BLOCK", block)
    docs, t = texts(seed), J.Threshold(num, 100)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = G.linked_groups(J._prepared(df, "doc_id", "text"), "text", n, t).collect()
    assert len(found) == len(docs)
    by = {}
    for r in found:
        if r.n_shingles:
            by.setdefault(r.root, set()).add(r._id)
    want = {}
    for i, g in enumerate(brute(docs, n, t)):
        if len(J.shingle_set(docs[i], n)):
            want.setdefault(g, set()).add(i)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, want.values()))


def test_keys_and_sets_go_as_soon_as_they_are_read(spark, monkeypatch):
    made, write = [], G.stage

    def noted(df, name):
        # tables that still stand while the next one is written
        standing.append((name, [n for n, x in made if os.path.exists(x.staged_path.removeprefix("file:"))]))
        out = write(df, name)
        made.append((name, out))
        return out

    standing = []
    monkeypatch.setattr(G, "stage", noted)
    df = spark.createDataFrame(list(enumerate(texts(6))), "doc_id long, text string")
    assert G.linked_groups(J._prepared(df, "doc_id", "text"), "text", 5, J.Threshold(80, 100)).count() == 120
    columns = {n: x.columns for n, x in made}
    at = [n for n, _ in standing].index("ng-low")
    assert sum("keys" in columns[n] for n in standing[at][1]) == 1
    late = [n for name, there in standing[[n for n, _ in standing].index("ng-stars"):] for n in there if name != "ng-links"]
    assert late and not any("keys" in columns[n] or "set" in columns[n] for n in late)


@pytest.mark.parametrize("seed,block,pairs", [(7, 3, 0), (8, 1024, 0), (9, 4, 1)])
def test_groups_equal_brute_force_where_lists_are_dense(spark, monkeypatch, seed, block, pairs):
    monkeypatch.setattr(G, "PAIRS_OF_ENTRY", pairs)
    monkeypatch.setattr(G, "COUNTED", 1)
    test_groups_equal_brute_force(spark, monkeypatch, seed, 5, 80, block)


def test_a_list_writes_rows_by_its_entries_and_equal_lists_count_once(spark):
    t, sk = J.Threshold(80, 100), bytes([1] * G.CLASSES)
    rows = [(key, h, h, 256, sk) for key in (1, 2) for h in range(60)]
    lists = spark.createDataFrame(rows, "key long, h long, root long, n int, sketch binary")
    found = G._between(lists, t).collect()
    assert sorted((r.key, r.a) for r in found) == [(r[0], r[1]) for r in rows] and not any(r.b for r in found)
    few = G._between(lists.filter("h < 3"), t).collect()
    assert sorted((r.key, r.a, r.b) for r in few) == [(None, 0, 1), (None, 0, 2), (None, 1, 2)]
    more = lists.unionByName(lists.filter("key = 1 and h > 0").withColumn("key", F.lit(3).cast("long")))
    assert sorted(r.key for r in G._one_of_equal(more, F.lit(True)).collect()) == [1, 3]


def test_linked_sets_share_a_first_shingle_in_any_order():
    draw, t = np.random.default_rng(2), J.Threshold(80, 100)
    for _ in range(300):
        whole = np.unique(draw.integers(0, 1 << 62, draw.integers(1, 300)).astype(np.uint64))
        a, b = (whole[draw.random(len(whole)) < 0.92] for _ in range(2))
        name = whole[draw.random(len(whole)) < draw.random()]
        count = draw.integers(2, 9, len(name))
        if len(a) and len(b) and t.linked(len(a), len(b), len(np.intersect1d(a, b))):
            assert len(np.intersect1d(*(G.first_shingles(x, t, name, count) for x in (a, b))))
    # a common passage isn't what a set is filed under
    passage, own = np.arange(50, dtype=np.uint64), np.arange(100, 150, dtype=np.uint64)
    assert set(G.first_shingles(np.concatenate((passage, own)), t, passage, np.full(50, 9)).tolist()) <= set(own.tolist())


def test_a_sketch_never_hides_a_link():
    draw, t = np.random.default_rng(1), J.Threshold(80, 100)
    for _ in range(300):
        whole = draw.integers(0, 1 << 62, draw.integers(1, 600)).astype(np.uint64)
        a, b = (np.unique(whole[draw.random(len(whole)) < 0.93]) for _ in range(2))
        if len(a) and len(b) and t.linked(len(a), len(b), len(np.intersect1d(a, b))):
            sk = [np.frombuffer(G.sketch(x), np.uint8)[None] for x in (a, b)]
            assert G.may_link(*sk, np.array([len(a)]), np.array([len(b)]), t).all()


def test_one_of_each_group_stays_where_ids_tie(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(None, base), (None, base + " x"), (None, base + " y"), (7, "other " * 3 + base[::-1]), (7, "OTHER " * 3 + base[::-1]),
            (8, None), (8, ""), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = J.jaccard_stage(spark, df, "").collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 7, 8, 8, 8]
    assert J.jaccard_stage(spark, df.limit(0), "").count() == 0


def test_columns_of_the_caller_stay_in_decontamination(spark, sf):
    from pairforge.llm.decontaminate import decontaminate_stage
    df = spark.createDataFrame([(1, "some text", [5, 6], "t")], "doc_id long, text string, item_ids array<long>, _t string")
    assert [tuple(r) for r in decontaminate_stage(spark, df, sf).collect()] == [(1, "some text", [5, 6], "t")]


def test_number_signs_are_no_letters(spark):
    from pairforge.llm.common import LETTER
    assert not LETTER.search("² ½ 12 _") and LETTER.search("² é")
