"""Operator 12: runs (maximal periodic stretches of words) by Baier grouping.

The first phase of Baier's suffix sorter handles groups of suffixes from the highest
down.  All suffixes of a group begin with the same Lyndon word; when the highest group
is handled, its word is final for each of them, and whatever stands before a stretch of
k of them moves to a new group: its own word followed by k times theirs, just above
its old group and in order of k.  Every position is handled once, and the length of its
group's word is its entry in the Lyndon array.  This is done under an order of the
words and under the reverse order.

The longest Lyndon word at a root of a run is the root itself, under one of the two
orders.  A stretch of four periods or more holds three roots in a row, so positions
whose entry is the same one and two periods further on are candidates.  Each is
extended to both sides by longest common extensions (prefix hashes and bisection), and
every run found is compared word by word.

A word of such a run occurs four times in it.  Words that occur less often in their
stretch can't be in a run and cut the text into shorter stretches before grouping; this
leaves out no run.

Cases: a null or empty text has no words and no runs; texts of any length are handled
whole, one text in one task; repeated rows and repeated or null ids are handled each on
its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from .common import encode_text, small_batches, spread_rows
from .substring import Hashes

#: fixed values of the contract: least length, least number of periods
LENGTH, PERIODS = 6, 4
#: words that are handled together (a longer text is handled alone)
TOGETHER = 200_000
#: at most so many rounds of leaving out rare words; more would only save time
ROUNDS = 4


def lyndon_array(letters: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at every place; negative letters are walls."""
    n, top = len(letters), int(letters.max(initial=-1))
    wall, done = -1, -2
    # a wall at both ends; place i of the input is place i + 1 here
    group = [wall, *np.maximum(letters, wall).tolist(), wall]
    before, after = list(range(-1, n + 1)), list(range(1, n + 3))
    found = [0] * (n + 2)
    size, below, above = [1] * (top + 1), list(range(-1, top)), [*range(1, top + 1), -1][: top + 1]
    members: list[list[int]] = [[] for _ in range(top + 1)]
    for i, g in enumerate(group):
        if g >= 0:
            members[g].append(i)
    cur = top
    while cur >= 0:
        length = size[cur]
        grown: dict[tuple[int, int], list[int]] = {}
        for i in members[cur]:
            if group[i] != cur:
                continue
            p = before[i]
            if group[p] == cur:
                continue  # not the first of its stretch
            k = 0
            while group[i] == cur:
                group[i] = done
                found[i] = length
                k += 1
                i = after[i]
            after[p], before[i] = i, p
            if group[p] >= 0:
                grown.setdefault((group[p], k), []).append(p)
        members[cur] = []
        # in falling order of k: each new group goes right above the old one
        for old, k in sorted(grown, key=lambda x: -x[1]):
            new, up = len(size), above[old]
            moved = grown[old, k]
            size.append(size[old] + k * length)
            members.append(moved)
            for p in moved:
                group[p] = new
            below.append(old)
            above.append(up)
            above[old] = new
            below[up] = new
        cur = below[cur]
    return np.array(found[1: n + 1], np.int64)


def frequent_stretches(words: np.ndarray) -> np.ndarray:
    """Places that may be in a run, ascending; neighbours of one stretch are consecutive numbers."""
    at, stretch = np.arange(len(words)), np.zeros(len(words), np.int64)
    width = int(words.max(initial=0)) + 1
    for _ in range(ROUNDS):
        if not len(at):
            break
        _, which, times = np.unique(stretch * width + words[at], return_inverse=True, return_counts=True)
        keep = at[times[which] >= PERIODS]
        number = np.cumsum(np.append(True, keep[1:] != keep[:-1] + 1)[: len(keep)]) - 1
        long = np.bincount(number)[number] >= LENGTH if len(keep) else np.zeros(0, bool)
        keep, number = keep[long], number[long]
        if len(keep) == len(at):
            break
        # stretches keep apart numbers, so equal words of two stretches count apart
        at, stretch = keep, number
    return at


def _common(hashes: Hashes, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """Longest common extension of places a and b to the right (or to the left of them), by bisection."""
    lo, hi = np.zeros(len(a), np.int64), most.copy()
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        same = hashes.of(a - mid, a) == hashes.of(b - mid, b) if back else hashes.of(a, a + mid) == hashes.of(b, b + mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    return lo


def _extend(letters: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """The same word by word."""
    start, end = i, i + p
    while start > 0 and letters[start - 1] == letters[start - 1 + p]:
        start -= 1
    while end < len(letters) and letters[end] == letters[end - p]:
        end += 1
    return start, end


def runs_of(letters: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period; letters are numbers, walls are negative and distinct."""
    n = len(letters)
    plain = letters >= 0
    _, dense = np.unique(letters[plain], return_inverse=True)
    place, period = [], []
    for ranks in (dense, dense.max(initial=0) - dense):
        order = np.full(n, -1, np.int64)
        order[plain] = ranks
        root = lyndon_array(order)
        i = np.flatnonzero(plain)
        i = i[i + 2 * root[i] < n]
        p = root[i]
        good = (root[i + p] == p) & (root[i + 2 * p] == p) & (letters[i] == letters[i + p]) & (letters[i] == letters[i + 2 * p])
        place.append(i[good])
        period.append(p[good])
    i, p = np.concatenate(place), np.concatenate(period)
    hashes = Hashes(letters.view(np.uint64))
    start = i - _common(hashes, i, i + p, i, True)
    end = i + p + _common(hashes, i, i + p, n - i - p, False)
    long = end - start >= np.maximum(LENGTH, PERIODS * p)
    found = set()
    for s, e, q, at in set(zip(start[long].tolist(), end[long].tolist(), p[long].tolist(), i[long].tolist())):
        if (s, e - s, q) in found:
            continue
        if not np.array_equal(letters[s: e - q], letters[s + q: e]):  # two hashes were equal by chance
            s, e = _extend(letters, at, q)
            if e - s < max(LENGTH, PERIODS * q):
                continue
        found.add((s, e - s, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of several texts, each a list of words."""
    parts, first, n = [], [], 0
    number = count()
    for words in texts:
        known: dict[bytes, int] = {}
        # equal words of a text get one number; a number of its own stands behind every text
        parts.append(np.fromiter(map(known.setdefault, words, number), np.int64, len(words)))
        parts.append(np.array([next(number)]))
        first.append(n)
        n += len(words) + 1
    every = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    at = frequent_stretches(every)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(at):
        # stretches one behind the other, with a wall between
        gap = np.flatnonzero(at[1:] != at[:-1] + 1) + 1
        letters = np.insert(every[at], gap, -1 - np.arange(len(gap)))
        origin = np.insert(at, gap, -1)
        for s, length, q in runs_of(letters):
            t = int(np.searchsorted(first, origin[s], "right")) - 1
            out[t].append((int(origin[s]) - first[t], length, q))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds behind its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for s, length, q in runs:
        edge[s + q] += 1
        edge[s + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def _split(_, text: str | None) -> list[bytes]:
    return encode_text(text).split()


def _chunks(texts: Iterator[list[bytes]]) -> Iterator[list[list[bytes]]]:
    held, n = [], 0
    for words in texts:
        held.append(words)
        n += len(words)
        if n >= TOGETHER:
            yield held
            held, n = [], 0
    if held:
        yield held


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  words_of: Callable[[object, str | None], list[bytes]] = _split) -> DataFrame:
    """doc_id, n_words, runs array<struct<start, length, period>> (by start and period), collapsed text of every row.

    ``words_of(id, text)`` gives the words of a row."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for b in batches:
            texts = (words_of(i, t) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            at = 0
            for chunk in _chunks(texts):
                found = runs_of_texts(chunk)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(chunk)), pa.array([len(w) for w in chunk], pa.int64()),
                     pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found], pa.list_(run_type)),
                     pa.array([b" ".join(collapse(w, r)).decode("utf-8", "replace") for w, r in zip(chunk, found)], pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
                at += len(chunk)

    return spread_rows(rows).mapInArrow(
        run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the run of the greatest exponent, and digests of all runs and of the collapsed text."""
    # exact comparison of fractions; the list is in order of start and period, so the first of equals stays
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.try_element_at("runs", F.lit(1)),
                       lambda a, r: F.when(r.length.cast("decimal(19,0)") * a.period > a.length.cast("decimal(19,0)") * r.period, r).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return (found.withColumn("_b", best)
                 .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_b.start").alias("start"),
                         F.col("_b.length").alias("length"), F.col("_b.period").alias("period"),
                         F.expr("_b.length * 1000 div _b.period").alias("exponent_milli"),
                         F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def repeated_words(doc_id, text: str | None) -> list[bytes]:
    """The words of a contract row: one id in ten (by checksum) has a tail that repeats its own words."""
    words = _split(doc_id, text)
    n = len(words)
    if doc_id is None or not n:
        return words
    g, tenth = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if tenth:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return digests(periodic_runs(table(spark, sf_dir, "documents"), words_of=repeated_words))


#: every maximal stretch of equal words at each distance; the least distance of a stretch is its period
OP12_SQL = r"""
WITH c AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
       xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                       lambda x, b: list_reduce(range(8), lambda y, k: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END, xor(x, b)),
                       4294967295::BIGINT), 4294967295) AS h FROM documents),
p AS (SELECT doc_id, ws, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN h // 10 END AS g FROM c),
q AS (SELECT doc_id, ws, n, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM p),
w AS (SELECT doc_id, n, i, CASE WHEN a IS NULL OR i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END AS x
      FROM (SELECT *, unnest(range(n)) AS i FROM q)),
f AS (SELECT * FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, x) >= 4),
m AS (SELECT a.doc_id, b.i - a.i AS q, a.i - row_number() OVER (PARTITION BY a.doc_id, b.i - a.i ORDER BY a.i) AS z, a.i
      FROM f AS a JOIN f AS b ON b.doc_id = a.doc_id AND b.x = a.x AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
l AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM m GROUP BY doc_id, q, z HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, s, len, min(q) AS q FROM l GROUP BY doc_id, s, len),
best AS (SELECT doc_id, s, len, q FROM r AS a WHERE NOT EXISTS (FROM r AS b WHERE b.doc_id = a.doc_id AND (b.len * a.q > a.len * b.q
           OR (b.len * a.q = a.len * b.q AND (b.s < a.s OR (b.s = a.s AND b.q < a.q)))))),
digest AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM r),
kept AS (SELECT w.doc_id, string_agg(x, ' ' ORDER BY w.i) AS t FROM w ANTI JOIN gone ON gone.doc_id = w.doc_id AND gone.i = w.i GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, len::BIGINT AS length, q::BIGINT AS period,
       (1000 * len // q)::BIGINT AS exponent_milli, sha256(coalesce(digest.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM documents AS d LEFT JOIN digest ON digest.doc_id = d.doc_id LEFT JOIN best ON best.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
