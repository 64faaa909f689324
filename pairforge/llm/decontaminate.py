"""Operator 8: benchmark decontamination with a BM25 index and block-max pruning.

The test items form an inverted index; every training passage is a query.
Impacts are BM25 weights divided by the item's score against itself, so one
threshold holds for items of any length.  Items are grouped in blocks of similar
wording; a term's block maximum bounds what it can add to any item of the block.
A block whose summed maxima stay below the threshold is skipped; in the others
terms are added from the largest maximum down, and scoring ends as soon as no
item can still reach the threshold.  Nothing above the threshold is lost.  Hits
are verified against the words of the passage: shared five-word shingles of the
item, and the words of its question and of its answer (its last sentence).

A passage is two neighbouring strides of a text, a stride as long as the longest
item of the index part, so any occurrence lies inside one passage.

Cases: null and empty texts are clean; null, empty and punctuation-only items
are ignored; an item of fewer than five words is one shingle; repeated items
share their text and are all reported; repeated rows give repeated results;
empty tables give an empty or all-clean result; other columns are ignored.

Bounds: items are read ``PART_ITEMS`` at a time; each part scans all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from .common import CACHE_WORDS, encode_text, small_batches, spread_rows

K1, B = 1.2, 0.75
#: share of an item's own score from which a passage is retrieved
THRESHOLD = 0.5
#: shares from which a retrieved passage counts as a leak
SHINGLE, MIN_SHINGLES, MIN_WORDS = 5, 0.6, 0.8
BLOCK = 8
#: items of one part of the index (a broadcast of a few MB)
PART_ITEMS = 5_000
MIN_STRIDE = 32
STRIP = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SENTENCE = re.compile(rb"(?<=[.!?])\s+")


def core(word: bytes) -> bytes:
    return word.strip(STRIP).decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass")


def words_of(text) -> list[bytes]:
    return [c for w in encode_text(text).split() if (c := core(w))]


def shingles(words: list[bytes]) -> set[tuple]:
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return {tuple(words[k: k + SHINGLE]) for k in range(len(words) - SHINGLE + 1)}


def question_and_answer(text) -> tuple[set, set]:
    """Words of all but the last sentence, and of the last one (halves of the words if there is one sentence)."""
    parts = [p for p in _SENTENCE.split(encode_text(text)) if words_of(p.decode("utf-8", "surrogatepass"))]
    words = words_of(text)
    if len(parts) > 1:
        n = len(words_of(parts[-1].decode("utf-8", "surrogatepass")))
    else:
        n = len(words) // 2
    return set(words[: len(words) - n]), set(words[len(words) - n:])


class Index:
    """One part of the inverted index with block maxima."""

    def __init__(self, items: list[tuple[int, str]], df: dict[bytes, int], n_items: int, mean_len: float):
        words = [words_of(t) for _, t in items]
        terms = sorted({w for ws in words for w in ws})
        self.term = {t: k for k, t in enumerate(terms)}
        idf = {t: math.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5)) for t in terms}
        # items of like wording share a block: order by their two most frequent terms
        def order(k):
            c = sorted(set(words[k]), key=lambda t: (-df[t], t))
            return (*c[:2], len(words[k]))
        by = sorted(range(len(items)), key=order)
        self.ids = [items[k][0] for k in by]
        self.shingles = [shingles(words[k]) for k in by]
        self.qa = [question_and_answer(items[k][1]) for k in by]
        self.stride = max([MIN_STRIDE, *map(len, words)])
        n_blocks = max(1, -(-len(by) // BLOCK))
        v = len(terms)
        self.impact = np.zeros((n_blocks, v + 1, BLOCK), np.float32)
        for at, k in enumerate(by):
            tf = Counter(words[k])
            w = {t: idf[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words[k]) / mean_len)) for t, n in tf.items()}
            own = sum(w.values())
            for t, x in w.items():
                self.impact[at // BLOCK, self.term[t], at % BLOCK] = x / own
        self.block_max = np.ascontiguousarray(self.impact.max(axis=2).T)  # terms x blocks

    def score_block(self, block: int, terms: np.ndarray, threshold: float) -> list[int]:
        """Places of items of the block that score at least ``threshold`` against the distinct ``terms``."""
        top = self.block_max[terms, block]
        keep = top > 0
        terms, top = terms[keep], top[keep]
        order = np.argsort(-top, kind="stable")
        terms, rest = terms[order], np.append(np.cumsum(top[order][::-1])[::-1], 0)
        score = np.zeros(BLOCK, np.float64)
        for a in range(0, len(terms), 8):
            if score.max() + rest[a] < threshold - 1e-6:
                return []
            score += self.impact[block, terms[a: a + 8]].sum(axis=0)
        return [block * BLOCK + int(k) for k in np.flatnonzero(score >= threshold - 1e-6)]

    def _candidates(self, pair, starts, terms, last, threshold):
        """(passage, block) pairs whose block bound, and whose best item bound, reach the threshold.

        The item bound adds an item's impacts over both strides (a term that both hold counts twice)."""
        sizes = np.diff(starts)
        for block in np.flatnonzero((pair >= threshold).any(axis=0)):
            passages = np.flatnonzero(pair[:, block] >= threshold)
            strides = np.unique(np.concatenate((passages, passages[~last[passages]] + 1)))
            n = sizes[strides]
            strides, n = strides[n > 0], n[n > 0]
            first = np.cumsum(n) - n
            at = np.arange(n.sum()) + np.repeat(starts[strides] - first, n)
            own = np.zeros((len(pair) + 1, BLOCK), np.float32)
            own[strides] = np.add.reduceat(self.impact[block][terms[at]], first, axis=0)
            best = own[passages] + np.where(last[passages][:, None], 0, own[passages + 1])
            for p in passages[best.max(axis=1) >= threshold]:
                yield p, block

    def verify(self, place: int, passage: list[bytes]) -> bool:
        """Shared shingles of the item, words of its question and of its answer, in the passage's words."""
        own = self.shingles[place]
        if len(own & self._shingles_like(place, passage)) < MIN_SHINGLES * len(own):
            return False
        have = set(passage)
        return all(len(part & have) >= MIN_WORDS * len(part) for part in self.qa[place])

    def _shingles_like(self, place: int, passage: list[bytes]) -> set[tuple]:
        n = len(next(iter(self.shingles[place])))
        return {tuple(passage[k: k + n]) for k in range(len(passage) - n + 1)}

    def search(self, texts: list[str | None], cache: dict[bytes, int], threshold: float = THRESHOLD) -> list[list[int]]:
        """Item ids that leak into each text."""
        s, v, term = self.stride, len(self.term), self.term
        ids, firsts, docs, tokens, base = [], [], [], [], 0
        for t in texts:
            ws = encode_text(t).split()
            try:
                got = np.fromiter(map(cache.__getitem__, ws), np.int64, len(ws))
            except KeyError:
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                for w in set(ws):
                    if w not in cache:
                        c = core(w)
                        cache[w] = term.get(c, -1) if c else -2
                got = np.fromiter(map(cache.__getitem__, ws), np.int64, len(ws))
            if (got == -2).any():  # words of punctuation only don't count
                got, ws = got[got != -2], [w for w in ws if cache[w] != -2]
            n = -(-len(got) // s)
            ids.append((base + np.arange(len(got)) // s) * (v + 1) + np.where(got < 0, v, got))
            firsts.append(base)
            docs.append(n)
            tokens.append(ws)
            base += n
        if not base:
            return [[] for _ in texts]
        key = np.unique(np.concatenate(ids))
        key = key[key % (v + 1) != v]
        stride, terms = key // (v + 1), key % (v + 1)
        starts = np.searchsorted(stride, np.arange(base + 1))
        bound = np.zeros((base, self.block_max.shape[1]), np.float32)
        full = np.flatnonzero(np.diff(starts))
        if len(full):
            bound[full] = np.add.reduceat(self.block_max[terms], starts[full], axis=0)
        last = np.zeros(base, bool)
        last[[f + n - 1 for f, n in zip(firsts, docs) if n]] = True
        pair = bound.copy()
        pair[:-1][~last[:-1]] += bound[1:][~last[:-1]]
        owner = np.repeat(np.arange(len(texts)), docs)
        found: list[set[int]] = [set() for _ in texts]
        for p, block in self._candidates(pair, starts, terms, last, threshold - 1e-5):
            d = owner[p]
            ts = terms[starts[p]: starts[p + 1 + (not last[p])]]
            hits = [h for h in self.score_block(block, np.unique(ts), threshold) if self.ids[h] not in found[d]]
            if hits:
                a = (p - firsts[d]) * s
                passage = [core(w) for w in tokens[d][a: a + 2 * s]]
                found[d].update(self.ids[h] for h in hits if self.verify(h, passage))
        return [sorted(f) for f in found]


def index_parts(items: DataFrame, part_items: int = PART_ITEMS):
    """The index, part by part (weights use counts over all items)."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).filter(
        F.col("item_id").isNotNull())

    def terms(batches):
        for b in batches:
            c, n, total = Counter(), 0, 0
            for t in b["text"]:
                ws = words_of(t)
                n, total = n + bool(ws), total + len(ws)
                c.update(set(ws))
            yield pd.DataFrame([(None, n, total), *((w, k, 0) for w, k in c.items())], columns=["w", "n", "total"])

    counts = rows.mapInPandas(terms, "w binary, n long, total long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).cache()
    whole = counts.filter("w IS NULL").first()
    n_items, total = (whole["n"], whole["total"]) if whole else (0, 0)
    if n_items:
        n_parts = -(-rows.count() // part_items)
        for p in range(n_parts):
            own = [(r["item_id"], r["text"]) for r in rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)) == p).collect() if words_of(r["text"])]
            if own:
                need = items.sparkSession.createDataFrame([(bytearray(w),) for w in {w for _, t in own for w in words_of(t)}], "w binary")
                df = {bytes(r["w"]): r["n"] for r in counts.join(need, "w").collect()}
                yield Index(own, df, n_items, total / n_items)
    counts.unpersist()


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: the id as doc_id) and ``item_ids`` array<long> (sorted) of every row."""
    rows = docs.select(*keep, F.col(text_col).alias("_t")) if keep else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    rows = spread_rows(rows).withColumn("item_ids", F.array().cast("array<long>"))
    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    for index in index_parts(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            cache: dict[bytes, int] = {}
            for b in batches:
                found = shared.value.search(b["_t"].tolist(), cache)
                yield b.assign(item_ids=[sorted({*old, *new}) for old, new in zip(b["item_ids"], found)])

        rows = rows.mapInPandas(run, fields)
    return rows.drop("_t")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), F.size("item_ids").cast("long").alias("n_items"), "item_ids")


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a test item go; the columns stay."""
    small_batches(spark)
    cols = docs.columns
    # names of the search's own columns may be names of the caller's: those are put aside
    private = [f"_keep{k}" for k in range(len(cols))]
    out = find_leaks(docs.toDF(*private), table(spark, sf_dir, "benchmark"), text_col=private[cols.index("text")], keep=private)
    return out.filter(F.size("item_ids") == 0).select(*private).toDF(*cols)
