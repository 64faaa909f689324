"""Operator 6: removal of repeated word sequences by recompression.

Words get 64-bit names.  In every round maximal runs of one symbol and then
pairs (left class, right class) get a name that is a hash of what they hold; the
class of a symbol is a bit of its name.  Names depend on content alone, so all
tasks give equal substrings the same symbols in their interior, with no exchange
of name tables.  Each symbol carries the span of words that decided it
(``ce``/``cs``: its context); inside any two equal windows the symbols whose
context lies in the window are the same.

* A window of 50 words is filed under one such symbol of the highest round that
  has one, with the words around it: the one with the least hash.  Consecutive windows filed under one
  occurrence of a symbol form a group with a hash of all its words.
* Symbols that occur in one text only are dropped (shared symbols reveal repeats).
* Groups with equal words are equal windows: the least id has them first.
* Where groups under one symbol differ, the least-id occurrence of each is
  compared window by window (a hash of all 50 words, together with the symbol).

Equality is that of a 64-bit symbol and a 64-bit hash of the words together.

Cases: null and empty texts have no words; texts below 50 words lose nothing; a
null id counts as larger than any other and rows of one id don't remove from
one another; repeated rows are judged alike; texts of any length are read whole
(in overlapping segments); an empty table gives an empty result; other columns
are ignored (the pipeline stage keeps them).
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from .common import combine, encode_text, mix, small_batches, spread_rows, stage, temporary, word_hashes, as_signed

#: fixed value of the contract
WINDOW = 50
ROUNDS = 4
#: words before and behind the start of a symbol that its key covers too
BEFORE, BEHIND = 8, 16
#: words that are parsed together
SEGMENT = 150_000
#: id of rows without one
NO_ID = (1 << 63) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Hashes:
    """Hashes of word ranges by prefix sums (modulo 2^64, over well mixed names)."""

    def __init__(self, names: np.ndarray):
        n = len(names)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _BASE))), dtype=np.uint64)
            self.inv = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _BASE_INV))), dtype=np.uint64)
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(names ^ _BASE) * power[:n], dtype=np.uint64)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.inv[start] + (end - start).astype(np.uint64))


class Symbols:
    """A sequence of symbols: name, span [b, e) and context [cs, ce) in words, separators."""

    def __init__(self, name, b, e, cs, ce, sep):
        self.name, self.b, self.e, self.cs, self.ce, self.sep = name, b, e, cs, ce, sep

    @staticmethod
    def words(names: np.ndarray, sep: np.ndarray) -> Symbols:
        at = np.arange(len(names))
        return Symbols(names, at, at + 1, at, at + 1, sep)

    def _around(self):
        """Context start of the symbol before, context end of the symbol after."""
        return np.append(-1, self.cs[:-1]), np.append(self.ce[1:], self.ce[-1] + 1)

    def runs(self, salt: int) -> Symbols:
        """Maximal runs of one symbol become one symbol; that a run ends is decided by both neighbours."""
        first = np.flatnonzero(np.append(True, (self.name[1:] != self.name[:-1]) | self.sep[1:] | self.sep[:-1]))
        last = np.append(first[1:], len(self.name)) - 1
        k = last - first + 1
        before, after = self._around()
        name = self.name[first]
        many = k > 1
        name[many] = combine(name[many], k[many].astype(np.uint64), 101 + salt)
        return Symbols(name, self.b[first], self.e[last], before[first], after[last], self.sep[first])

    def pairs(self, salt: int) -> Symbols:
        """Left-class symbols merge with a right-class symbol behind them; pairs never overlap."""
        with np.errstate(over="ignore"):
            left = (mix(self.name + np.uint64(salt * 7919 + 1)) >> np.uint64(63)).astype(bool)
        joined = np.append(left[:-1] & ~left[1:] & ~self.sep[1:] & ~self.sep[:-1], False)
        tail = np.append(False, joined[:-1])
        before, after = self._around()
        # a symbol that stays alone depends on the neighbour that it could have merged with
        cs = np.where(left | joined | tail, self.cs, before)
        ce = np.where(left & ~joined, after, self.ce)
        keep = np.flatnonzero(~tail)
        end = keep + joined[keep]
        name = self.name[keep]
        m = joined[keep]
        name[m] = combine(self.name[keep[m]], self.name[end[m]], 11 + salt)
        return Symbols(name, self.b[keep], self.e[end], cs[keep], ce[end], self.sep[keep])


def parse(names: np.ndarray, sep: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    levels = [Symbols.words(names, sep)]
    for r in range(rounds):
        levels.append(levels[-1].runs(r).pairs(r))
    return levels


def _range_min(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of x[lo:hi] for non-empty ranges."""
    out = np.empty(len(lo), np.uint64)
    size = np.frexp(hi - lo)[1] - 1  # floor of log2
    level = x
    for k in range(int(size.max()) + 1 if len(size) else 0):
        at = np.flatnonzero(size == k)
        out[at] = np.minimum(level[lo[at]], level[hi[at] - (1 << k)])
        if len(level) > 1 << k:
            level = np.minimum(level[: -(1 << k)], level[1 << k:])
    return out


def file_windows(names: np.ndarray, sep: np.ndarray, starts: np.ndarray, sums: Hashes):
    """Groups of the windows at ``starts`` (ascending): key, first window, windows, place of the symbol.

    The key is the symbol and the words around it; they count as its context, so
    that unrelated texts seldom share a key."""
    key = np.zeros(len(starts), np.uint64)
    place = np.full(len(starts), -1)
    todo = np.arange(len(starts))
    levels = parse(names, sep)
    n = len(names)
    for r in range(len(levels) - 1, -1, -1):
        s = levels[r]
        cs, ce = np.minimum(s.cs, s.b - BEFORE), np.maximum(s.ce, s.b + BEHIND)
        lo = np.searchsorted(cs, starts[todo], "left")
        hi = np.searchsorted(ce, starts[todo] + WINDOW, "right")
        has = hi > lo
        ids = todo[has]
        if len(ids):
            # least 40-bit hash, then the first place
            with np.errstate(over="ignore"):
                rank = (mix(s.name * np.uint64(3) + np.uint64(r)) >> np.uint64(24) << np.uint64(24)) | np.arange(len(s.name), dtype=np.uint64)
            best = (_range_min(rank, lo[has], hi[has]) & np.uint64((1 << 24) - 1)).astype(np.int64)
            around = sums.of(np.maximum(s.b[best] - BEFORE, 0), np.minimum(s.b[best] + BEHIND, n))
            key[ids] = combine(combine(s.name[best], around, 977), np.full(len(best), r, np.uint64), 3)
            place[ids] = s.b[best] * 8 + r
        todo = todo[~has]
        if not len(todo):
            break
    cut = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)))
    count = np.diff(np.append(cut, len(starts)))
    return key[cut], starts[cut], count, place[cut] // 8


def segments(texts: list[bytes]):
    """Words of texts as segments: (names, separators, text, offset in the text, windows' starts)."""
    held, n = [], 0

    def build(parts):
        names, sep, owner, offset, starts, at = [], [], [], [], [], 1
        gap = np.zeros(1, np.uint64)
        names.append(gap)
        for t, first, h in parts:
            names += [h, gap]
            starts.append(at + np.arange(max(0, len(h) - WINDOW + 1)))
            owner.append(np.full(len(starts[-1]), t))
            offset.append(np.full(len(starts[-1]), first - at))
            at += len(h) + 1
        names = np.concatenate(names)
        sep = np.zeros(len(names), bool)
        sep[np.concatenate(([0], np.cumsum([len(h) + 1 for _, _, h in parts])))] = True
        return names, sep, np.concatenate(owner), np.concatenate(offset), np.concatenate(starts)

    for t, text in enumerate(texts):
        h = word_hashes(text.split())
        if len(h) < WINDOW:
            continue
        for a in range(0, max(1, len(h) - WINDOW + 1), SEGMENT):
            part = h[a: a + SEGMENT + WINDOW - 1]
            held.append((t, a, part))
            n += len(part)
            if n >= SEGMENT:
                yield build(held)
                held, n = [], 0
    if held:
        yield build(held)


GROUP = "sym long, sig long, id long, th long, pos int, cnt int"


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select("*", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_th"))


def window_groups(keyed: DataFrame, text_col: str) -> DataFrame:
    """The groups of windows of every text."""
    def run(batches):
        for b in batches:
            ids, th = b.column(0).to_numpy(), b.column(1).to_numpy()
            for names, sep, owner, offset, starts in segments([encode_text(t) for t in b.column(2).to_pylist()]):
                sums = Hashes(names)
                sym, first, count, place = file_windows(names, sep, starts, sums)
                sig = combine(sums.of(first, first + count + WINDOW - 1), (place - first).astype(np.uint64), 5)
                # one word over and over files each window under its own occurrence: equal neighbours are one row
                follows = (sym[1:] == sym[:-1]) & (sig[1:] == sig[:-1]) & (first[1:] == first[:-1] + count[:-1])
                head = np.flatnonzero(np.append(True, ~follows))[: len(first)]
                count = np.add.reduceat(count, head) if len(head) else count
                sym, sig, first = sym[head], sig[head], first[head]
                k = np.searchsorted(starts, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_signed(sym)), pa.array(as_signed(sig)), pa.array(ids[owner[k]]), pa.array(th[owner[k]]),
                     pa.array((first + offset[k]).astype(np.int32)), pa.array(count.astype(np.int32))],
                    names=["sym", "sig", "id", "th", "pos", "cnt"])

    return spread_rows(keyed.select("_id", "_th", F.col(text_col).alias("t"))).mapInArrow(run, GROUP)


def single_windows(keyed: DataFrame, needs: DataFrame, text_col: str) -> DataFrame:
    """(sym, win, id, th, pos) of the windows in ``needs`` (id, th, list of (sym, pos, cnt))."""
    rows = keyed.select("_id", "_th", F.col(text_col).alias("t"))
    rows = rows.join(needs.withColumnsRenamed({"id": "_id", "th": "_th"}), ["_id", "_th"])

    def run(batches):
        for b in batches:
            ids, th = b.column(0).to_numpy(), b.column(1).to_numpy()
            out = [[], [], [], [], []]
            for k, t in enumerate(b.column(2).to_pylist()):
                h = word_hashes(encode_text(t).split())
                sums = Hashes(h)
                sym, pos, cnt = (np.array(b.column(c)[k].values.to_numpy(), np.int64) for c in (3, 4, 5))
                at = np.repeat(pos - (np.cumsum(cnt) - cnt), cnt) + np.arange(cnt.sum())
                out[0].append(np.repeat(sym, cnt))
                out[1].append(as_signed(sums.of(at, at + WINDOW)))
                out[2].append(np.full(len(at), ids[k]))
                out[3].append(np.full(len(at), th[k]))
                out[4].append(at.astype(np.int32))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["sym", "win", "id", "th", "pos"])

    return rows.select("_id", "_th", "t", "need.sym", "need.pos", "need.cnt").mapInArrow(run, "sym long, win long, id long, th long, pos int")


def repeated_ranges(keyed: DataFrame, text_col: str) -> DataFrame:
    """(id, th, ranges array<struct<pos, cnt>>): windows whose words start in a text with a smaller id."""
    with temporary(keyed.sparkSession) as keep:
        return keep(_repeated_ranges(keyed, text_col))


def _repeated_ranges(keyed: DataFrame, text_col: str) -> DataFrame:
    # what a join reads beside the rows is written first: Spark can then split a skewed key
    groups = stage(window_groups(keyed, text_col), "sub-groups")
    shared = stage(groups.groupBy("sym").agg(F.min("id").alias("a"), F.max("id").alias("b"))
                         .filter("a < b").select("sym"), "sub-keys")
    groups = stage(groups.join(shared, "sym"), "sub-shared")
    first = stage(groups.groupBy("sym", "sig").agg(F.min("id").alias("first")), "sub-first")
    several = stage(first.groupBy("sym").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("sym", F.lit(True).alias("several")), "sub-several")
    marked = stage(groups.join(first, ["sym", "sig"]).join(several, "sym", "left"), "sub-marked")
    whole = marked.filter("first < id").select("id", "th", "pos", "cnt")
    needs = (marked.filter("first = id and several").groupBy("id", "th")
                   .agg(F.collect_list(F.struct("sym", "pos", "cnt")).alias("need")))
    windows = stage(single_windows(keyed, needs, text_col), "sub-windows")
    least = stage(windows.groupBy("sym", "win").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                         .filter("first < last").select("sym", "win", "first"), "sub-least")
    single = (windows.join(least, ["sym", "win"]).filter("first < id")
                     .select("id", "th", "pos", F.lit(1).alias("cnt")))
    return stage(whole.unionByName(single).groupBy("id", "th").agg(F.collect_set(F.struct("pos", "cnt")).alias("ranges")), "sub-ranges")


def covered(n: int, pos: np.ndarray, cnt: np.ndarray) -> np.ndarray:
    """Words of a text that windows at pos .. pos + cnt - 1 cover."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, pos, 1)
    np.add.at(d, pos + cnt + WINDOW - 1, -1)
    return np.cumsum(d[:n]) > 0


def _with_ranges(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    keyed = _keyed(df, id_col, text_col)
    ranges = repeated_ranges(keyed, text_col).withColumnsRenamed({"id": "_id", "th": "_th"})
    return keyed.join(ranges, ["_id", "_th"], "left")


def removed_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every text."""
    id_type = dict(df.dtypes)[id_col]
    rows = _with_ranges(df.select(id_col, text_col), id_col, text_col)

    def run(batches):
        for b in batches:
            n, gone, sha = [], [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                words = encode_text(t).split()
                n.append(len(words))
                mask = None
                if b.column(2)[k].is_valid:
                    mask = covered(len(words), np.array(b.column(2)[k].values.to_numpy(), np.int64), np.array(b.column(3)[k].values.to_numpy(), np.int64))
                    words = [words[i] for i in np.flatnonzero(~mask)]
                gone.append(n[-1] - len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return rows.select(F.col(id_col).alias("doc_id"), text_col, F.col("ranges.pos").alias("p"), F.col("ranges.cnt").alias("c")).mapInArrow(
        run, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return removed_words(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP6_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
f AS (SELECT g, min(doc_id) AS low FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT win.doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN f ON f.g = win.g WHERE low < win.doc_id)),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS t FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p
         WHERE gone.p IS NULL GROUP BY word.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id
"""


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cut_text(text: str, pos, cnt) -> str:
    """The text without the covered words: the stretches that stay, as they stood, one line each."""
    data = encode_text(text)
    spans = [m.span() for m in _WORD.finditer(data)]
    keep = np.concatenate(([False], ~covered(len(spans), np.asarray(pos), np.asarray(cnt)), [False]))
    edge = np.flatnonzero(keep[1:] != keep[:-1])
    return b"\n".join(data[spans[a][0]: spans[b - 1][1]] for a, b in zip(edge[::2], edge[1::2])).decode("utf-8", "surrogatepass")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated words leave the text (``n_chars`` follows); texts that lose all words go."""
    small_batches(spark)
    cols = docs.columns
    rows = _with_ranges(docs, "doc_id", "text")

    @F.pandas_udf("string")
    def cut(t: pd.Series, p: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([cut_text(x, a, b) for x, a, b in zip(t, p, c)], dtype=object)

    hit = rows.filter("ranges is not null").withColumn("text", cut("text", "ranges.pos", "ranges.cnt")).filter("text != ''")
    if "n_chars" in cols:
        hit = hit.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return rows.filter("ranges is null").select(*cols).unionByName(hit.select(*cols))
