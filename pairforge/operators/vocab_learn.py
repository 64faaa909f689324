"""Unigram vocabulary learning (T2 / A9) as a loop of Spark jobs.

1. Texts are normalized (T0) and cut into words; ``groupBy(word).count()``
   shrinks the corpus to its word list, checkpointed once.
2. Seed pieces, mined by length: what starts at a character is kept as a window of
   at most ``max_piece_len`` characters, equal windows together.  A round counts the
   prefixes of the windows of 2, then 3 to 4, 5 to 8, 9 to 16 characters; windows whose
   longest prefix of a round occurs once leave, so longer pieces come only from pieces
   that occur twice.  Pieces are ranked by count × length; the top ``seed_factor × vocab_size`` are kept, plus
   every character needed for ``char_coverage``.
3. EM: a prefix table of the pieces is broadcast; each partition of the word table runs
   forward-backward over the lattices of many words at once and emits per-piece
   expected counts, which a ``groupBy(piece).sum`` combines.  The M-step (digamma
   normalization) runs on the piece table.
4. Pruning: Viterbi piece frequencies come from the same kind of job, the
   likelihood loss of removing each piece from a distributed job over the
   piece table; the best ``shrink`` share survives.
5. The final ``vocab_size - 4`` pieces follow the four control pieces.

Only the piece table (bounded by ``seed_factor × vocab_size``) reaches the
driver; the corpus never does.
"""

from __future__ import annotations

import itertools
import logging
import math
import re
import time
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..constants import SPECIAL_PIECES, VOCAB_SIZE, WORD_BOUNDARY
from ..functions.lattice import Lattice, Trie, best_path, expected_counts, in_portions
from ..functions.normalize import nmt_nfkc, text_portions, tokens
from .ordering import hash_key, with_order_rank
from ..session import count_and_fit, ensure_checkpoint_dir, materialize, spread, stored

# --- Fixed values: trainer settings (public unigram trainer defaults) -------
MAX_PIECE_LEN = 16
CHAR_COVERAGE = 0.9995
SHRINK = 0.75
SUB_ITERS = 2
MIN_EXPECTED = 0.5
UNK_PENALTY = 10.0
FINAL_SLACK = 1.1

log = logging.getLogger(__name__)

#: distinct words that a task counts before it hands them on
COUNTED_WORDS = 200_000
#: characters of a word that are cut out together when windows are made
CHUNK = 256


def word_pattern(split_digits: bool = True) -> str:
    """Words of normalized text; with ``split_digits`` every digit is a word of its own."""
    if split_digits:
        return f"{WORD_BOUNDARY}[^{WORD_BOUNDARY}0-9]*|[0-9]|[^{WORD_BOUNDARY}0-9]+"
    return f"{WORD_BOUNDARY}[^{WORD_BOUNDARY}]*|[^{WORD_BOUNDARY}]+"


def digamma(x: float) -> float:
    r = 0.0
    while x < 6.0:
        r -= 1.0 / x
        x += 1.0
    f = 1.0 / (x * x)
    return r + math.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))


def _normalized_words(t: DataFrame, split_digits: bool) -> DataFrame:
    """(word, freq) of the normalized texts, counted task by task: a portion's tokens are counted
    first, and only distinct ones are normalized and cut."""
    pattern = re.compile(word_pattern(split_digits))

    def run(batches):
        cut: dict[str, list[str]] = {}
        freq: dict[str, int] = {}
        for b in batches:
            for texts in text_portions(b.column(0)):
                counts = pc.value_counts(tokens(texts).flatten())
                for token, n in zip(counts.field(0).to_pylist(), counts.field(1).to_pylist()):
                    words = cut.get(token)
                    if words is None:
                        # ASCII letters alone are one word as they are
                        words = cut[token] = [WORD_BOUNDARY + token] if token.isascii() and token.isalpha() else pattern.findall(nmt_nfkc(token))
                    for w in words:
                        freq[w] = freq.get(w, 0) + n
                if len(freq) > COUNTED_WORDS or len(cut) > COUNTED_WORDS:
                    yield _word_batch(freq)
                    cut, freq = {}, {}
        yield _word_batch(freq)

    return t.mapInArrow(run, "word string, freq long")


def _word_batch(freq: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(freq), pa.string()), pa.array(list(freq.values()), pa.int64())], ["word", "freq"])


def word_counts(df: DataFrame, col: str, normalize: bool = True, split_digits: bool = True) -> DataFrame:
    """(word, freq) of a text column; checkpointed, it is read every EM round."""
    ensure_checkpoint_dir(df.sparkSession)
    # no filter on the text: Spark would work the text out once for it and once more for the rows
    t = spread(df).select(F.col(col).alias("_t"))
    w = _normalized_words(t, split_digits) if normalize else t.select(
        F.explode(F.regexp_extract_all("_t", F.lit(word_pattern(split_digits)), 0)).alias("word"), F.lit(1).cast("long").alias("freq"))
    wc = materialize(w.groupBy("word").agg(F.sum("freq").alias("freq")))
    # the E-step is CPU-heavy: one partition per core at least
    cores = df.sparkSession.sparkContext.defaultParallelism
    return wc if wc.rdd.getNumPartitions() >= cores else materialize(wc.repartition(cores))


def _required_chars(wc: DataFrame, coverage: float) -> dict[str, float]:
    chars = (wc.select(F.explode(F.split("word", "")).alias("ch"), "freq")
               .filter(F.col("ch") != "").groupBy("ch").agg(F.sum("freq").alias("n"))
               .orderBy(F.col("n").desc(), "ch").collect())
    total = sum(r["n"] for r in chars)
    out, acc = {}, 0
    for r in chars:
        if total and acc / total >= coverage:
            break
        out[r["ch"]] = float(r["n"])
        acc += r["n"]
    return out


def windows(wc: DataFrame, max_len: int) -> DataFrame:
    """(window, freq): what starts at every character of every word, ``max_len`` characters at most.

    A word is cut into chunks first, each with the start of the next one behind it, so
    that a place in a long word is found without counting from its start."""
    chunks = F.regexp_extract_all("word", F.lit(f"(?s).{{1,{max(CHUNK, max_len)}}}"), 0)
    c = wc.select(chunks.alias("_c"), "freq")
    c = c.select(F.posexplode("_c").alias("_k", "_t"), "_c", "freq").select(
        "_t", F.substring(F.coalesce(F.get("_c", F.col("_k") + 1), F.lit("")), 1, max_len - 1).alias("_next"), "freq")
    c = c.select(F.concat("_t", "_next").alias("_w"), F.explode(F.sequence(F.lit(1), F.length("_t"))).alias("_i"), "freq")
    return c.select(F.substring("_w", F.col("_i"), F.lit(max_len)).alias("window"), "freq").groupBy("window").agg(F.sum("freq").alias("freq"))


def _kth_score(level: DataFrame, k: int) -> int:
    """A number that at least ``k`` scores (count × length) of a table reach, 0 if it has fewer rows: a lower limit
    of the k-th greatest score, from a count per band of scores."""
    band = F.floor(F.log2(F.col("n") * F.length("piece")) * 16).cast("int")
    rows = level.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("k"), F.min(F.col("n") * F.length("piece")).alias("low")).collect()
    for r in sorted(rows, key=lambda r: -r["band"]):
        k -= r["k"]
        if k <= 0:
            return r["low"]
    return 0


def repeated_pieces(wc: DataFrame, max_len: int, best: int | None = None) -> DataFrame:
    """(piece, n): every stretch of 2 to ``max_len`` characters of a word that occurs twice or more, with its count.

    With ``best``, pieces that are surely not among the ``best`` greatest by count × length may be missing:
    a piece occurs no more often than its beginning, so windows whose beginning is too rare for the
    score that ``best`` shorter pieces reach leave (equal scores stay)."""
    left, found, low = stored(windows(wc, max_len), "windows"), [], 2
    while low <= max_len:
        high = min(max_len, 2 * (low - 1))
        prefixes = F.transform(F.sequence(F.lit(low), F.least(F.lit(high), F.length("window"))), lambda n: F.substring("window", F.lit(1), n))
        left = left.filter(F.length("window") >= low)
        level = stored(left.select(F.explode(prefixes).alias("piece"), "freq")
                           .groupBy("piece").agg(F.sum("freq").alias("n")).filter("n >= 2"), "pieces")
        found.append(level)
        least = 2 if best is None else max(2, -(-_kth_score(level, best) // max_len))
        keys = level.filter((F.length("piece") == high) & (F.col("n") >= least)).select(F.col("piece").alias("_p"))
        n, small = count_and_fit(keys)
        if not n:
            break
        left = left.join(F.broadcast(keys) if small else keys, F.substring("window", 1, high) == F.col("_p"), "left_semi")
        low = high + 1
    return reduce(DataFrame.unionByName, found)


def _seed_pieces(wc: DataFrame, n_seeds: int, max_len: int) -> dict[str, float]:
    s = repeated_pieces(wc, max_len, n_seeds)
    # a histogram of scores finds the range that holds the cut; only that range is ranked
    s = s.withColumns({"score": F.col("n") * F.length("piece"),
                       "band": F.floor(F.log2(F.col("n") * F.length("piece")) * 16).cast("int")})
    bands = sorted(((r["band"], r["k"]) for r in s.groupBy("band").agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)
    above, cut = 0, None
    for band, k in bands:
        if above + k > n_seeds:
            cut = band
            break
        above += k
    top = s if cut is None else s.filter(F.col("band") > cut)
    rows = top.select("piece", "n").collect()
    if cut is not None:
        edge = with_order_rank(s.filter(F.col("band") == cut).select((-F.col("score")).alias("neg"), "piece", "n"), ["neg", "piece"], "rank")
        rows += edge.filter(F.col("rank") < n_seeds - above).select("piece", "n").collect()
    return {r["piece"]: float(r["n"]) for r in rows}  # at most n_seeds rows


def _normalize_logp(freqs: dict[str, float]) -> dict[str, float]:
    total = sum(freqs.values())
    dt = digamma(total)
    return {p: digamma(f) - dt for p, f in freqs.items()}


class _Model:
    """Pieces in order with their prefix table and scores, as one broadcast value."""

    def __init__(self, logp: dict[str, float]):
        self.pieces = sorted(logp)
        self.trie = Trie(self.pieces)
        self.score = np.array([logp[p] for p in self.pieces])
        self.unknown = min(logp.values()) - UNK_PENALTY


def _per_piece(wc: DataFrame, model: _Model, count_words) -> dict[str, float]:
    """Sums per piece of what ``count_words(model, words, freqs)`` gives for the words of a batch."""
    bc = wc.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = bc.value
        total = np.zeros(len(m.pieces))
        for b in batches:
            total += count_words(m, b["word"].tolist(), b["freq"].to_numpy(np.float64))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"k": at, "n": total[at]})

    rows = wc.mapInPandas(run, "k int, n double").groupBy("k").agg(F.sum("n").alias("n")).collect()
    bc.destroy()
    return {model.pieces[r["k"]]: r["n"] for r in rows}


def _expected(m: _Model, words: list[str], freq: np.ndarray) -> np.ndarray:
    total = np.zeros(len(m.pieces))
    for some, long in in_portions(words):
        if long:
            acc: dict[str, float] = {}
            expected_counts(words[some[0]], dict(zip(m.pieces, m.score.tolist())), m.trie.max_len, m.unknown, float(freq[some[0]]), acc)
            at = dict(zip(m.pieces, range(len(m.pieces))))
            for p, n in acc.items():
                total[at[p]] += n
        else:
            total += Lattice([words[k] for k in some], m.trie, len(m.pieces)).expected(m.score, m.unknown, freq[some])
    return total


def _on_best_paths(m: _Model, words: list[str], freq: np.ndarray) -> np.ndarray:
    total = np.zeros(len(m.pieces) + 1)
    for some, long in in_portions(words):
        if long:
            table = {p: (k, x) for k, (p, x) in enumerate(zip(m.pieces, m.score.tolist()))}
            for p in best_path(words[some[0]], table, m.trie.max_len, m.unknown):
                if p is not None:
                    total[table[p][0]] += freq[some[0]]
        else:
            word, piece = Lattice([words[k] for k in some], m.trie, len(m.pieces)).best(m.score, m.unknown)
            total += np.bincount(piece, weights=freq[some][word], minlength=len(total))
    return total[:-1]


def _prune_loss(spark, logp: dict[str, float], vfreq: dict[str, float], required: set) -> dict[str, float]:
    """Likelihood loss of removing each piece: its Viterbi frequency times the
    gap to its best split into the remaining pieces (computed in parallel over
    the piece table)."""
    total = sum(vfreq.values()) or 1.0
    model = _Model(logp)
    cand = [p for p in model.pieces if p not in required and len(p) > 1]
    freq = np.array([vfreq.get(p, 0.0) for p in model.pieces])
    bc = spark.sparkContext.broadcast((model, freq, total))
    at = dict(zip(model.pieces, range(len(model.pieces))))
    pdf = spark.createDataFrame(pd.DataFrame({"piece": cand, "k": [at[p] for p in cand]}), "piece string, k int")

    def run(batches):
        m, vf, tot = bc.value
        for b in batches:
            words, f = b["piece"].tolist(), vf[b["k"].to_numpy(np.int64)]
            loss = np.zeros(len(words))
            for a in range(0, len(words), 20_000):
                some = slice(a, a + 20_000)
                word, piece = Lattice(words[some], m.trie, len(m.pieces)).best(m.score, m.unknown, whole=False)
                g = f[some]
                parts = np.bincount(word, minlength=len(g))
                with np.errstate(divide="ignore", invalid="ignore"):
                    alone = np.log(g) - np.log(tot)
                    split = np.log(np.append(vf, 0.0)[piece] + g[word]) - np.log(tot + g * (parts - 1))[word]
                    loss[some] = np.where(g > 0, g * (alone - np.bincount(word, weights=split, minlength=len(g))), 0.0)
            yield pd.DataFrame({"piece": b["piece"], "loss": loss})

    res = pdf.repartition(max(1, spark.sparkContext.defaultParallelism)).mapInPandas(
        run, "piece string, loss double").collect()
    bc.destroy()
    return {r["piece"]: r["loss"] for r in res}


def _vocab_frame(spark, scores: dict[str, float]) -> DataFrame:
    """The four control pieces, then the pieces by falling score (ties by piece)."""
    rows = [(i, p, 0.0) for i, p in enumerate(SPECIAL_PIECES)]
    rows += [(i + len(SPECIAL_PIECES), p, float(x)) for i, (p, x) in enumerate(sorted(scores.items(), key=lambda kv: (-kv[1], kv[0])))]
    return spark.createDataFrame(rows, "id int, piece string, score double")


def seed_vocab(df: DataFrame, col: str, n_seeds: int, normalize: bool = True, coverage: float = CHAR_COVERAGE,
               max_piece_len: int = MAX_PIECE_LEN, split_digits: bool = True) -> DataFrame:
    """The vocabulary that learning starts from, with scores ln(count / total count): the ``n_seeds`` pieces of
    the greatest count × length (ties by piece) and the characters needed for ``coverage``."""
    wc = word_counts(df, col, normalize, split_digits)
    freqs = _seed_pieces(wc, n_seeds, max_piece_len) | _required_chars(wc, coverage)
    total = sum(freqs.values())
    return _vocab_frame(df.sparkSession, {p: math.log(n / total) for p, n in freqs.items()})


def learn_vocab(df: DataFrame, col: str, vocab_size: int = VOCAB_SIZE, normalize: bool = True,
                seed_factor: int = 10, hard_limit: bool = False, coverage: float = CHAR_COVERAGE,
                max_piece_len: int = MAX_PIECE_LEN, shrink: float = SHRINK, split_digits: bool = True,
                sample_rows: int | None = None, seed: int = 0) -> DataFrame:
    """A unigram vocabulary ``(id INT, piece STRING, score DOUBLE)`` for ``col``.

    ``seed_factor``, ``coverage``, ``max_piece_len``, ``shrink``, ``split_digits`` (T1:
    every digit is a piece of its own) and ``sample_rows`` are the trainer's options.
    With ``sample_rows`` only about so many rows, drawn by a seeded hash of their text,
    are learned from; without it all are, and then their order has no effect (words
    are counted).  Rounds go on until the target size is met: each one drops at least
    one piece, or there is nothing left that may be dropped.

    With ``hard_limit`` an error is raised when the corpus cannot fill
    ``vocab_size`` pieces; otherwise the vocabulary is smaller."""
    spark = df.sparkSession
    desired = vocab_size - len(SPECIAL_PIECES)
    t0 = time.time()
    if sample_rows is not None:
        share = min(1.0, sample_rows / max(1, df.count()))
        df = df.filter(F.conv(F.substring(hash_key(seed, F.coalesce(F.col(col), F.lit(""))), 1, 13), 16, 10).cast("double") < share * 16.0 ** 13)
    wc = word_counts(df, col, normalize, split_digits)
    required = _required_chars(wc, coverage)
    freqs = _seed_pieces(wc, seed_factor * vocab_size, max_piece_len)
    freqs.update({c: max(n, freqs.get(c, 0.0)) for c, n in required.items()})
    logp = _normalize_logp(freqs)
    log.info("seeds: %d pieces, %d required chars, %.1fs", len(logp), len(required), time.time() - t0)
    for rnd in itertools.count():
        t1 = time.time()
        for _ in range(SUB_ITERS):
            exp = _per_piece(wc, _Model(logp), _expected)
            kept = {p: n for p, n in exp.items() if n >= MIN_EXPECTED or p in required}
            for c in required:
                kept.setdefault(c, MIN_EXPECTED)
            logp = _normalize_logp(kept)
        log.info("round %d: EM → %d pieces, %.1fs", rnd, len(logp), time.time() - t1)
        if len(logp) <= desired * FINAL_SLACK:
            break
        vfreq = _per_piece(wc, _Model(logp), _on_best_paths)
        loss = _prune_loss(spark, logp, vfreq, set(required))
        target = max(desired, int(shrink * len(logp)))
        n_keep = max(0, target - len([p for p in logp if p in required or len(p) == 1]))
        ranked = sorted(loss.items(), key=lambda kv: (-kv[1], kv[0]))[:n_keep]
        keep = {p for p, _ in ranked} | {p for p in logp if p in required or len(p) == 1}
        if len(keep) == len(logp):
            break
        logp = {p: s for p, s in logp.items() if p in keep}
        log.info("round %d: pruned → %d pieces, %.1fs", rnd, len(logp), time.time() - t1)
    if hard_limit and len(logp) < desired:
        raise ValueError(f"corpus gives {len(logp)} pieces, fewer than {desired}")
    chars = {p for p in logp if p in required}
    others = sorted(((p, s) for p, s in logp.items() if p not in chars), key=lambda kv: (-kv[1], kv[0]))
    final = dict(others[:max(0, desired - len(chars))])
    final.update({p: logp[p] for p in chars})
    return _vocab_frame(spark, final)
