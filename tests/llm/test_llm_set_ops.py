"""Sharding, quality rules, substring dedup, decontamination, Jaccard join and components against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from pairforge.llm import decontaminate as D, jaccard as J, quality, substring as S
from pairforge.llm.components import components
from pairforge.llm.sharding import Topology, place, shard_documents
from pyspark.sql import functions as F


def draw(key, name, weight):
    h = xxhash.xxh64_intdigest(name.encode(), xxhash.xxh64_intdigest(key.encode(), 42))
    return -math.log(((h >> 11) + 0.5) * 2.0 ** -53) / weight, name


def brute_place(key, topology):
    root, racks, shards = topology.levels()
    region = min(draw(key, *x) for x in root)[1]
    rack = min(draw(key, *x) for x in racks[region])[1]
    return min((*draw(key, n, w), leaf) for n, w, leaf in shards[rack])[2]


def test_shards_follow_the_tree_and_moves_stay_in_changed_subtrees(spark):
    keys = [str(i) for i in range(3000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    t = Topology.regular(16)
    heavier = Topology((((3.0, 1.0), *t.regions[0][1:]), *t.regions[1:]))
    rows = df.select("k", *[place(F.col("k"), x).alias(n) for n, x in (("a", t), ("b", t.grown()), ("c", heavier))]).collect()
    for r in rows:
        assert r.a == brute_place(r.k, t) and r.c == brute_place(r.k, heavier)
        assert r.b in (r.a, 16)
        if r.c != r.a:  # rows move into the region (rack, shard) that got heavier only
            assert r.c // 4 == 0 and (r.a // 4 != 0 or r.c // 2 == 0) and (r.a // 2 != 0 or r.c == 0)
    n = Counter(r.a for r in rows)
    assert len(n) == 16 and max(n.values()) < 1.5 * 3000 / 16


def test_slots_and_cases(spark):
    rows = [(i, "é" * (i % 5), 1, 2) for i in range(500)] + [(7, "same", 1, 2)] * 40 + [(None, None, 0, 0)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, slot int")
    out = shard_documents(df, Topology.regular(16), rows_per_bucket=3).collect()
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.size >= 1
    assert len(out) == len(rows) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((a, len((b or "").encode()) + 1, zlib.crc32((b or "").encode())) for a, b, *_ in rows)
    assert shard_documents(df.limit(0), Topology.regular(16)).count() == 0


def brute_rules(text):
    text = text or ""
    w = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    c = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    hit = {p for k in range(len(w) - 7) if c[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    return (len(w), sum(len(x.decode()) for x in w), sum(text.count(s) for s in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(hit))


def test_quality_counts_and_verdicts(spark):
    r = random.Random(3)
    texts = [None, "", " \n\t", "a b c d e f g h a b c d e f g h", "x " * 40, "l1 é\nl1 é\n\n \nl2", "\x0b#a\xa0b|", "a b c d e f g " * 3 + "z"]
    texts += [" ".join(r.choice("abc") for _ in range(r.randint(1, 60))) for _ in range(60)]
    rows = [(i, t, None if i % 7 == 0 else f"h{i % 3}", 9) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    for x in quality.document_rules(df).collect():
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_lines, x.n_dup_lines, x.n_repeat_words) == brute_rules(texts[x.doc_id]), texts[x.doc_id]
    good = " ".join(f"w{k}" for k in range(40))
    rows = [(i, good, "good") for i in range(50)] + [(100 + i, good if i < 5 else "junk", "bad") for i in range(50)] + [(200, good, "new"), (201, "junk", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {x.doc_id: (x.base_failed, x.kept) for x in quality.verdicts(quality.document_rules(df)).collect()}
    assert out[0] == (False, True) and out[100] == (False, False) and out[150 - 1] == (True, False) and out[200] == (False, True)
    assert quality.verdicts(quality.document_rules(df.limit(0))).count() == 0


def brute_substring(rows):
    first, out = {}, []
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - 49):
            g = tuple(w[k:k + 50])
            first[g] = min(first.get(g, S.NO_ID), S.NO_ID if i is None else i)
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k:k + 50])] < (S.NO_ID if i is None else i):
                gone.update(range(k, k + 50))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def text_rows(seed=5):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    base = [[r.choice(vocab) for _ in range(r.randint(60, 400))] for _ in range(8)]
    rows = []
    for i in range(60):
        a, b = r.choice(base), r.choice(base)
        x, y = r.randint(0, len(a)), r.randint(0, len(b))
        w = a[x:x + r.randint(30, 200)] + [r.choice(vocab) for _ in range(r.randint(0, 40))] + b[y:y + r.randint(30, 90)]
        rows.append((i, r.choice([" ", "\n", " \t"]).join(w)))
    rows += [(100, "a " * 200), (101, "a " * 49), (102, "b a " * 70), (103, "a " * 120 + "z"), (104, "a b " * 60), (105, "q " + "a " * 51)]
    rows += [(106, None), (107, ""), (108, " ".join(base[0])), (108, " ".join(base[0])), (108, " ".join(base[1])), (None, " ".join(base[0])), (None, " ".join(base[2]))]
    return rows


@pytest.mark.parametrize("segment", [100, 150_000])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(S, "SEGMENT", segment)
    rows = text_rows()
    df = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, sym int")
    got = sorted((tuple(r) for r in S.removed_words(df).collect()), key=str)
    assert got == sorted(brute_substring(rows), key=str)
    assert S.removed_words(df.limit(0)).count() == 0


def test_equal_windows_have_equal_keys():
    r = np.random.default_rng(4)
    window = r.integers(0, 5, 50).astype(np.uint64)
    keys = set()
    for _ in range(30):
        a, b = (r.integers(0, 5, r.integers(1, 60)).astype(np.uint64) for _ in range(2))
        names = np.concatenate(([np.uint64(0)], S.mix(np.concatenate((a, window, b)) + np.uint64(9)), [np.uint64(0)]))
        sep = np.zeros(len(names), bool)
        sep[[0, -1]] = True
        k, first, count, place = S.file_windows(names, sep, np.array([1 + len(a)]), S.Hashes(names))
        keys.add((int(k[0]), int(place[0] - first[0])))
    assert len(keys) == 1


def test_cut_text_keeps_the_rest_as_it_stood():
    words = [f"w{k}" for k in range(60)]
    text = "head  one\n" + " ".join(words) + "\t tail two"
    assert S.cut_text(text, [2], [11]) == "head  one\ntail two"


def test_decontamination_retrieves_all_and_verifies(spark):
    r = random.Random(6)
    vocab = [f"v{k}" for k in range(150)]
    sentence = lambda n: " ".join(r.choice(vocab) for _ in range(n)) + "."
    items = [(i, sentence(r.randint(4, 30)) + " " + sentence(r.randint(3, 9))) for i in range(40)] + [(40, None), (41, "?!"), (42, "v1 v2")]
    docs = []
    for i in range(80):
        t = [sentence(r.randint(5, 60)) for _ in range(r.randint(1, 6))]
        if i % 3 == 0:
            t.insert(r.randint(0, len(t)), items[i % 40][1].upper().replace(" ", "\n"))
        docs.append((i, " ".join(t)))
    docs += [(90, None), (91, ""), (92, "... !!"), (93, items[5][1]), (93, items[5][1])]
    words = [D.words_of(t) for _, t in items]
    full = [k for k, w in enumerate(words) if w]
    df = Counter(w for k in full for w in set(words[k]))
    index = D.Index([items[k] for k in full], df, len(full), sum(len(words[k]) for k in full) / len(full))
    for _, t in docs:  # block by block, exactly the items above the threshold
        ts = np.array(sorted({index.term[w] for w in D.words_of(t) if w in index.term}), np.int64)
        score = index.impact[:, ts].sum(axis=1).ravel()[: len(index.ids)]
        got = sorted(h for b in range(index.impact.shape[0]) for h in index.score_block(b, ts, 0.5))
        assert got == [k for k, x in enumerate(score) if x >= 0.5 - 1e-6]
    out = D.find_leaks(spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_ids int"),
                       spark.createDataFrame(items, "item_id long, text string"))
    for row in out.collect():
        if row.doc_id < 80 and row.doc_id % 3 == 0:
            assert row.doc_id % 40 in row.item_ids
        text = " ".join(x.decode() for x in D.words_of(dict(docs)[row.doc_id]))
        for i in row.item_ids:
            own = D.shingles(words[i])
            have = D.shingles(text.encode().split()) if len(words[i]) >= 5 else set()
            assert len(words[i]) < 5 or len(own & have) >= 0.6 * len(own)
    many = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(str, many.collect())) == sorted(map(str, out.collect()))
    none = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string").limit(0))
    assert {len(x.item_ids) for x in none.collect()} == {0}


def test_index_in_parts_gives_the_same(spark, monkeypatch):
    items = [(i, " ".join(f"t{(i * 7 + k) % 97}" for k in range(12))) for i in range(30)]
    docs = spark.createDataFrame([(i, "x y " + items[i][1] + " z") for i in range(30)], "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted((r.doc_id, list(r.item_ids)) for r in D.find_leaks(docs, table).collect())
    parts = list(D.index_parts(table, 8))
    got = Counter()
    for index in parts:
        for d, f in zip(docs.collect(), index.search([r.text for r in docs.collect()], {})):
            got.update((d.doc_id, i) for i in f)
    assert len(parts) > 2 and sorted(got) == sorted((d, i) for d, ids in whole for i in ids)


def brute_links(rows, n, t):
    sets = []
    for _, x in rows:
        w = (x or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            o = len(sets[a] & sets[b])
            if o and t.den * o >= t.num * (len(sets[a]) + len(sets[b]) - o):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    ids = [J.NO_ID if i is None else i for i, _ in rows]
    low = {}
    for k in range(len(rows)):
        low[find(k)] = min(low.get(find(k), J.NO_ID), ids[k])
    return sorted((ids[k], len(sets[k]), low[find(k)], links[k]) for k in range(len(rows)))


def near_rows(seed=8):
    r = random.Random(seed)
    rows, i = [], 0
    for size in [1, 2, 3, 5, 8, 11, 14, 16, 18, 20, 25, 40, 80, 200]:
        for _ in range(3):
            base = [f"w{r.randint(0, 40 + 3 * size)}" for _ in range(size)]
            for _ in range(6):
                w = list(base)
                for _ in range(r.randint(0, 1 + size // 40)):
                    w[r.randrange(len(w))] = f"x{r.randint(0, 9)}"
                if r.random() < 0.4:
                    w = w + ["tail"] * r.randint(1, 2)
                rows.append((i, (" " if r.random() < 0.5 else "\n").join(w).upper() if r.random() < 0.2 else " ".join(w)))
                i += 1
    return rows + [(900, None), (901, ""), (902, " \t"), (902, "a b c d e f g"), (902, "a b c d e f g"), (902, "other words stand here now"),
                   (None, "a b c d e f g"), (None, "A b"), (903, "a b")]


@pytest.mark.parametrize("n, t, blocks", [(3, J.Threshold(90, 100), 512), (5, J.Threshold(80, 100), 512), (1, J.Threshold(80, 100), 3), (2, J.Threshold(70, 100), 512)])
def test_jaccard_equals_brute_force(spark, monkeypatch, n, t, blocks):
    monkeypatch.setattr(J, "BLOCK_SETS", blocks)
    rows = near_rows()
    df = spark.createDataFrame([(*x, 1, 1) for x in rows], "doc_id long, text string, h int, n_shingles int")
    got = sorted((r._id, r.n_shingles, r.component_id, r.n_links) for r in J.link_documents(df, n, t).collect())
    assert got == brute_links(rows, n, t)


def test_jaccard_of_empty_table_and_plan_by_size(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.link_documents(df, 3, J.Threshold(90, 100)).count() == 0
    for t in (J.Threshold(90, 100), J.Threshold(80, 100)):
        firsts, b = t.classes(3000), t.boundary()
        for a in range(b + 1, 2000):
            c = np.searchsorted(firsts, a, "right") - 1
            for big in (a, t.partner(a)):
                assert np.searchsorted(firsts, big, "right") - 1 in (c, c + 1)
                least = -(-t.num * (a + big) // (t.num + t.den))
                assert a + big - 2 * least <= t.differences(firsts[c + 1] - 1)


def test_components(spark):
    r = random.Random(9)
    edges = [(k, k + 1) for k in range(50)] + [(200, 100 + k) for k in range(40)] + [(300, 300)] + [(r.randint(400, 460), r.randint(400, 460)) for _ in range(40)]
    root = {}

    def find(a):
        root.setdefault(a, a)
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for a, b in edges if a != b for k in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
