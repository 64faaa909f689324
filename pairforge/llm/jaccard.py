"""Operator 9: size-aware heavy-light Jaccard join over word n-grams.

Texts with equal sets are one node from the start (its hash).  Two nodes with
sets of sizes a and b link when ``den * overlap >= num * union``.

* Light sets (at most ``boundary`` shingles): every subset that could be the
  overlap with a partner is enumerated (all subsets of the few sizes that the
  threshold allows); linked sets share one.
* Heavy sets: inverted lists are scanned.  A linked pair differs in at most D
  shingles, so of D + 1 hash classes of shingles at least one holds the same
  shingles in both; a few classes more make up for empty ones.  The lists are
  keyed by the content of a class, with D from the size class of the smaller
  set; a set files under its own size class and under the one below that may
  hold smaller partners.  A set with no more than D classes that aren't empty
  files under another hashing too, where the same holds.
* The boundary is where enumerating costs more than filing and scanning.  Heavy
  sets small enough to have light partners enumerate too.

Nodes of one list form a cluster with its least node (no pairs are emitted).
Clusters are verified exactly in blocks: all pairs of two blocks of sets are
counted at once inside a task, which returns each node's links and its least
linked node.  A cluster of any size is split into block pairs, and a block is
bounded in sets and in shingles unless one set alone is larger.

Cases: null, empty and white-space texts have the empty set and link with
nothing; fewer words than n are one shingle; repeated rows are documents of
their own that link; a null id counts as the largest id; rows of one id but
different texts are different documents; texts of any length are read whole; an
empty table gives an empty result; other columns are ignored (the pipeline
stage keeps them).

Equality of shingles, class contents and sets is that of 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from .common import as_signed, combine, encode_text, lower_ascii, mix, ngram_hashes, shuffle_parts, small_batches, spread_rows, stage, temporary, word_hashes
from .components import components

#: cost of filing and scanning one list entry against one enumerated subset
LIST_COST = 4
#: sets and shingles of a block of a cluster
BLOCK_SETS, BLOCK_SHINGLES = 512, 400_000
#: list entries that one reducing group sorts at a time, about (8 bytes each when shuffled)
GROUP_ROWS = 500_000
NO_ID = (1 << 63) - 1
MAX_SALTS = 6


def shingle_set(text, n: int) -> np.ndarray:
    """Sorted names of the distinct n-word shingles (A-Z lowered)."""
    h = word_hashes(lower_ascii(encode_text(text)).split())
    if not len(h):
        return h
    if len(h) < n:
        return ngram_hashes(h, len(h))[:1] ^ np.uint64(len(h))
    return np.unique(ngram_hashes(h, n))


def set_name(s: np.ndarray) -> np.uint64:
    with np.errstate(over="ignore"):
        return combine(np.array([mix(s).sum(dtype=np.uint64)]), np.array([len(s)], np.uint64), 77)[0]


@dataclass(frozen=True)
class Threshold:
    """Jaccard >= num / den, and the plan by size that follows from it."""

    num: int
    den: int

    def partner(self, a: int) -> int:
        """Largest size that can link with size a."""
        return a * self.den // self.num

    def least(self, a: int) -> int:
        """Smallest size that can link with size a; also the least overlap."""
        return -(-a * self.num // self.den)

    def linked(self, a, b, overlap):
        return self.den * overlap >= self.num * (a + b - overlap)

    def differences(self, smaller: int) -> int:
        """Most shingles that two linked sets don't share, the smaller one of at most this size."""
        return (smaller + self.partner(smaller)) * (self.den - self.num) // (self.den + self.num)

    def n_parts(self, first: int, last: int) -> tuple[int, int]:
        """Hash classes of shingles for smaller sets of sizes first to last, and how many must hold some shingle."""
        need = self.differences(last) + 1
        return need + int(2 * need * exp(-first / need)) + 1, need

    def boundary(self) -> int:
        """Largest size up to which enumerating costs no more than filing in lists."""
        n = 1
        while sum(comb(n + 1, o) for o in range(self.least(n + 1), n + 2)) <= LIST_COST * 2 * (self.differences(n + 1) + 1):
            n += 1
        return n

    def classes(self, top: int) -> list[int]:
        """First sizes of the heavy size classes up to size ``top``; linked sets are in one class or in neighbours."""
        firsts = [self.boundary() + 1]
        while firsts[-1] <= top:
            firsts.append(self.partner(firsts[-1]) + 1)
        return firsts


def _light_keys(s: np.ndarray, t: Threshold, boundary: int) -> np.ndarray:
    m, n = mix(s), len(s)
    with np.errstate(over="ignore"):
        total, keys = m.sum(dtype=np.uint64), []
        for o in range(t.least(n), min(n, boundary) + 1):
            gone = np.array([m[list(c)].sum(dtype=np.uint64) for c in combinations(range(n), n - o)], np.uint64)
            keys.append(combine(total - gone, np.full(len(gone), o, np.uint64), 31))
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def _heavy_keys(s: np.ndarray, size_class: int, n_parts: int, need: int) -> np.ndarray:
    m, keys = mix(s), []
    for salt in range(MAX_SALTS):
        with np.errstate(over="ignore"):
            part = ((mix(s + np.uint64(size_class * 64 + salt + 1)) >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int64)
            sums = np.zeros(n_parts, np.uint64)
            np.add.at(sums, part, m)
        full = np.bincount(part, minlength=n_parts) > 0
        last = salt == MAX_SALTS - 1
        at = np.arange(n_parts) if last else np.flatnonzero(full)
        keys.append(combine(sums[at], np.uint64(size_class * 64 + salt) * np.uint64(1 << 32) + at.astype(np.uint64), 53))
        if full.sum() >= need:
            break
    return np.concatenate(keys)


def keys_of(s: np.ndarray, t: Threshold, boundary: int, firsts: list[int]) -> np.ndarray:
    n, out = len(s), []
    if n and t.least(n) <= boundary:
        out.append(_light_keys(s, t, boundary))
    if n > boundary:
        c = int(np.searchsorted(firsts, n, "right")) - 1
        out.append(_heavy_keys(s, c, *t.n_parts(firsts[c], firsts[c + 1] - 1)))
        if c and t.least(n) < firsts[c]:
            out.append(_heavy_keys(s, c - 1, *t.n_parts(firsts[c - 1], firsts[c] - 1)))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _prepared(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select("*", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_th"))


def pack(key: np.ndarray, own: np.ndarray) -> bytes:
    """List entries sorted by owner: owners, keys of each, 40 bits of each key.

    Forty bits of a key inside one group: a chance collision only adds a pair to verify."""
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    count = np.diff(np.append(first, len(own))).astype(np.uint32)
    return b"".join((np.uint32(len(first)).tobytes(), own[first].tobytes(), count.tobytes(),
                     key.astype(np.uint32).tobytes(), (key >> np.uint64(32)).astype(np.uint8).tobytes()))


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    m = int(np.frombuffer(blob, np.uint32, 1)[0])
    own, count = np.frombuffer(blob, np.uint64, m, 4), np.frombuffer(blob, np.uint32, m, 4 + 8 * m)
    n, at = int(count.sum()), 4 + 12 * m
    low, high = np.frombuffer(blob, np.uint32, n, at), np.frombuffer(blob, np.uint8, n, at + 4 * n)
    return low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)), np.repeat(own, count)


def file_sets(rows: DataFrame, text_col: str, n: int, t: Threshold, n_groups: int) -> DataFrame:
    """Documents (id, th, n, h) and edges (h, low) between nodes that share a key, as rows of two kinds."""
    def file(batches):
        boundary = t.boundary()
        for b in batches:
            sizes, names, keys, owner = [], [], [], []
            for text in b.column(2).to_pylist():
                s = shingle_set(text, n)
                sizes.append(len(s))
                names.append(set_name(s) if len(s) else np.uint64(0))
                if len(s):
                    k = keys_of(s, t, boundary, t.classes(len(s)))
                    keys.append(k)
                    owner.append(np.full(len(k), names[-1], np.uint64))
            k = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.abs(b.column(1).to_numpy()) % n_groups, pa.int32()), b.column(0), b.column(1), pa.array(sizes, pa.int32()),
                 pa.array(as_signed(np.array(names, np.uint64))), pa.nulls(k, pa.binary())], names=names_)
            if keys:
                key, own = np.concatenate(keys), np.concatenate(owner)
                group = (key >> np.uint64(40)).astype(np.int64) % n_groups
                order = np.lexsort((key, own, group))
                key, own, group = key[order], own[order], group[order]
                new = np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]))
                key, own, group = key[new], own[new], group[new]
                cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
                ends = np.append(cuts[1:], len(group))
                blobs = [pack(key[x:y], own[x:y]) for x, y in zip(cuts, ends)]
                m = len(blobs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[cuts], pa.int32()), *(pa.nulls(m, x) for x in (pa.int64(), pa.int64(), pa.int32(), pa.int64())),
                     pa.array(blobs, pa.binary())], names=names_)

    def scan(batches):
        def edges(blobs):
            key, own = (np.concatenate(x) for x in zip(*map(unpack, blobs)))
            order = np.lexsort((own, key))
            key, own = key[order], own[order]
            new = np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]))
            key, own = key[new], own[new]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            low = np.repeat(own[first], np.diff(np.append(first, len(key))))
            e = np.unique(np.stack((own, low), axis=1)[own != low], axis=0)
            m = len(e)
            return pa.RecordBatch.from_arrays([*(pa.nulls(m, x) for x in (pa.int64(), pa.int64(), pa.int32())),
                                               pa.array(as_signed(np.ascontiguousarray(e[:, 0]))), pa.array(as_signed(np.ascontiguousarray(e[:, 1])))],
                                              names=["id", "th", "n", "h", "low"])

        held, group = [], None  # rows come sorted by group
        for b in batches:
            docs = b.filter(b.column(5).is_null())
            if docs.num_rows:
                yield pa.RecordBatch.from_arrays([*(docs.column(k) for k in range(1, 5)), pa.nulls(docs.num_rows, pa.int64())],
                                                 names=["id", "th", "n", "h", "low"])
            for g, x in zip(b.column(0).to_pylist(), b.column(5)):
                if not x.is_valid:
                    continue
                if g != group and held:
                    yield edges(held)
                    held = []
                group = g
                held.append(x.as_py())
        if held:
            yield edges(held)

    names_ = ["grp", "id", "th", "n", "h", "blob"]
    filed = spread_rows(rows.select("_id", "_th", text_col)).mapInArrow(file, "grp int, id long, th long, n int, h long, blob binary")
    parts = shuffle_parts(rows.sparkSession)
    return (filed.repartition(parts, "grp").sortWithinPartitions("grp")
                 .mapInArrow(scan, "id long, th long, n int, h long, low long"))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by columns of shingles that two sets or more hold."""
    m = len(sets)
    if m == 2:
        o = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), o], [o, len(sets[1])]])
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[col]
    rows, col = rows[keep], number[col[keep]]
    order = np.argsort(col, kind="stable")
    rows, col = rows[order], col[order]
    out = np.zeros((m, m), np.float64)
    width, n_cols = max(64, 2_000_000 // m), int(shared.sum())
    for a in range(0, n_cols, width):
        lo, hi = np.searchsorted(col, (a, a + width))
        x = np.zeros((m, min(width, n_cols - a)), np.float32)
        x[rows[lo:hi], col[lo:hi] - a] = 1
        out += x @ x.T
    out = out.astype(np.int64)
    out[np.arange(m), np.arange(m)] = [len(s) for s in sets]
    return out


def least_linked(names: np.ndarray, link: np.ndarray) -> np.ndarray:
    """Least name that is reachable over the links of a block."""
    low = names.copy()
    while True:
        new = low.copy()
        a, b = np.nonzero(link)
        np.minimum.at(new, a, low[b])
        if (new == low).all():
            return low
        low = new


def verify(cluster_sets: DataFrame, t: Threshold) -> DataFrame:
    """(root, h, w, n, set) of clusters -> (h, low, links): least linked node and links by documents, per block pair."""
    size = cluster_sets.groupBy("root").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("k") / BLOCK_SETS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    large = size.withColumn("nb", blocks).filter("nb > 1").select("root", "nb")
    d = cluster_sets.join(large, "root", "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    d = d.withColumn("blk", F.pmod(F.xxhash64("h"), F.col("nb")).cast("int"))
    other = F.when(F.col("nb") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("nb") - 1))
    d = d.withColumn("o", F.explode(other)).withColumns({"i": F.least("blk", "o"), "j": F.greatest("blk", "o")})
    # small clusters are dealt to groups of many clusters, block pairs of large ones are groups of their own
    n_groups = 8 * shuffle_parts(cluster_sets.sparkSession)
    d = d.withColumn("g", F.when(F.col("nb") == 1, F.pmod(F.xxhash64("root"), F.lit(n_groups))).otherwise(F.xxhash64("root", "i", "j")))
    d = d.select("g", "root", "i", "j", "blk", "h", "w", "set").repartition(shuffle_parts(cluster_sets.sparkSession), "g").sortWithinPartitions("g", "root", "i", "j")

    def one(part, across):
        names = np.array([r[1] for r in part], np.int64)
        weights = np.array([r[2] for r in part], np.int64)
        sets = [np.frombuffer(r[3], np.uint64) for r in part]
        blk = np.array([r[0] for r in part])
        o = overlaps(sets)
        sizes = np.diag(o)
        link = t.linked(sizes[:, None], sizes[None, :], o)
        np.fill_diagonal(link, False)
        count = link
        if across:  # pairs inside a block belong to the block's own task
            count = link & (blk[:, None] != blk[None, :])
        return names, least_linked(names, link), count @ weights

    def run(batches):
        held, now = [], None
        for b in batches:
            out = []
            cols = [b.column(k).to_pylist() for k in range(1, 8)]
            for root, i, j, blk, h, w, s in zip(*cols):
                if (root, i, j) != now:
                    if len(held) > 1:
                        out.append(one(held, now[1] != now[2]))
                    held, now = [], (root, i, j)
                held.append((blk, h, w, s))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out)], names=["h", "low", "links"])
        if len(held) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in one(held, now[1] != now[2])], names=["h", "low", "links"])

    return d.mapInArrow(run, "h long, low long, links long")


def link_documents(df: DataFrame, n: int, t: Threshold, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _th, n_shingles, component_id, n_links) of every row."""
    rows = _prepared(df, id_col, text_col)
    n_groups = max(8 * shuffle_parts(df.sparkSession), df.count() * 128 // GROUP_ROWS)
    filed = stage(file_sets(rows, text_col, n, t, n_groups), "nj-filed")
    docs = filed.filter("n is not null").select("id", "th", "n", "h")
    classes = stage(docs.filter("n > 0").groupBy("h").agg(F.min("id").alias("least"), F.min(F.struct("id", "th")).alias("one"),
                                                          F.count(F.lit(1)).alias("w")), "nj-classes")
    clusters = components(filed.filter("low is not null").select(F.col("h").alias("a"), F.col("low").alias("b")))
    wanted = clusters.join(classes, clusters["node"] == classes["h"]).select("root", "h", "w", F.col("one.id").alias("_id"), F.col("one.th").alias("_th"))
    # repeated rows give one set (no shuffle: the join has dealt them by the same keys)
    texts = rows.select("_id", "_th", F.col(text_col).alias("t")).join(wanted, ["_id", "_th"]).dropDuplicates(["_id", "_th"])

    def to_set(batches):
        for b in batches:
            sets = [shingle_set(x, n) for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(3)), pa.array([len(s) for s in sets], pa.int32()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["root", "h", "w", "n", "set"])

    sets = texts.select("root", "h", "w", "t").mapInArrow(to_set, "root long, h long, w long, n int, set binary")
    sets = stage(sets, "nj-sets")
    links = stage(verify(sets, t), "nj-links")
    joined = components(links.filter("h <> low").select(F.col("h").alias("a"), F.col("low").alias("b")))
    counts = links.groupBy("h").agg(F.sum("links").alias("links"))
    found = (classes.join(joined, classes["h"] == joined["node"], "left").join(counts, "h", "left")
                    .select("h", "least", "w", F.coalesce("root", "h").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
                    .filter("w > 1 or links > 0"))
    found = stage(found, "nj-found")
    low = found.groupBy("root").agg(F.min("least").alias("low"))
    found = found.join(low, "root").select("h", "low", (F.col("links") + F.col("w") - 1).alias("links"))
    return docs.join(found, "h", "left").select(
        F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("low", "id").alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


#: fixed values of the contract
OP9_WORDS, OP9_THRESHOLD = 3, Threshold(90, 100)
#: the pipeline stage: five words, 0.8
STAGE_WORDS, STAGE_THRESHOLD = 5, Threshold(80, 100)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), OP9_WORDS, OP9_THRESHOLD)
    some = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(some("_id").alias("doc_id"), "n_shingles", some("component_id").alias("component_id"), "n_links")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of linked documents one stays, the least by id (null: last) and then by a hash
    of the text; texts without words all stay.  Links aren't counted here, so only groups are looked for."""
    from .near_groups import linked_groups
    small_batches(spark, 100)
    cols = docs.columns
    rows = _prepared(docs, "doc_id", "text")
    with temporary(spark) as keep:
        keep(best := _kept_rows(linked_groups(rows, "text", STAGE_WORDS, STAGE_THRESHOLD)))
    rows = rows.join(best, ["_id", "_th"])
    # repeated rows of one id and text: one stays
    full = rows.filter("_some").dropDuplicates(["_id", "_th"])
    return full.unionByName(rows.filter("not _some")).select(*cols)


def _kept_rows(found: DataFrame) -> DataFrame:
    """(_id, _th, whether the text has words) of the rows that stay."""
    best = found.filter("n_shingles > 0").groupBy("root").agg(F.min(F.struct("_id", "_th")).alias("k")).select("k._id", "k._th", F.lit(True).alias("_some"))
    none = found.filter("n_shingles = 0").select("_id", "_th", F.lit(False).alias("_some")).distinct()
    return stage(best.unionByName(none), "nj-keep")


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 90 * (a.n + b.n - o)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id),
l AS (SELECT x, count(*) AS k FROM e GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.root AS component_id, coalesce(l.k, 0) AS n_links
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN l ON l.x = w.doc_id
JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c ON c.doc_id = w.doc_id
"""
