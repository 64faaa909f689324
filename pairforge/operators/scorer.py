"""Decoding with a user batch scorer.

``make_scorer()`` returns ``score(src_ids, prefixes)``, the next-token logits of
every prefix: an ``ndarray[B, V]`` (``-inf`` = impossible), or ``Sparse`` rows that
list the possible tokens only, so that memory doesn't grow with the vocabulary.
Sources are decoded per partition by ``mapInPandas``: the scorer is built once per
Python worker and called once per step for the still-running rows of an Arrow
batch, so a neural model scores whole batches, never single rows.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..constants import EOS_ID, LENGTH_ALPHA, NGRAM_SIZE, REPETITION_PENALTY
from .decoding import candidates_per_beam

_SCORERS: dict = {}
#: sources are dealt to so many tasks per core
TASKS_PER_CORE = 3


def worker_scorer(key: str, make_scorer):
    """The scorer of one decoding run, built once per Python worker process.

    A module-level function: the cache is the worker's own and outlives a task."""
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = make_scorer()
    return _SCORERS[key]


class Sparse(NamedTuple):
    """Logits of a batch: row r has ``tokens[offsets[r]:offsets[r + 1]]`` (ascending) and their logits."""
    offsets: np.ndarray
    tokens: np.ndarray
    logits: np.ndarray

    @staticmethod
    def of(rows: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        offsets = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(t) for t, _ in rows], out=offsets[1:])
        if not rows:
            return Sparse(offsets, np.empty(0, np.int64), np.empty(0))
        return Sparse(offsets, np.concatenate([t for t, _ in rows]), np.concatenate([z for _, z in rows]))


def rows_of(logits) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(token ids ascending, logits) of the possible tokens of every row, dense or sparse."""
    if isinstance(logits, Sparse):
        for a, b in zip(logits.offsets[:-1], logits.offsets[1:]):
            yield logits.tokens[a:b], logits.logits[a:b]
    else:
        for z in np.asarray(logits):
            at = np.flatnonzero(np.isfinite(z))
            yield at, z[at]


def table_scorer(scores: DataFrame, max_rows: int = 5_000_000):
    """A sparse scorer factory over a ``scores(prev_id, token_id, logit)`` table of at most ``max_rows`` rows
    (it is held by every worker)."""
    n = scores.count()
    if n > max_rows:
        raise ValueError(f"score table of {n} rows is above max_rows={max_rows}; use the table-form decoders")
    pdf = scores.select("prev_id", "token_id", "logit").toPandas().sort_values(["prev_id", "token_id"])
    by_prev = {int(p): (g["token_id"].to_numpy(np.int64), g["logit"].to_numpy(np.float64))
               for p, g in pdf.groupby("prev_id")}
    none = (np.empty(0, np.int64), np.empty(0))

    def make():
        return lambda src, prefixes: Sparse.of([by_prev.get(int(pre[-1]), none) for pre in prefixes])
    return make


def _uniform(seed, ex_id, step) -> float:
    """Same hashed uniform as the table form (md5 of ``seed:ex:step``)."""
    h = hashlib.md5(f"{seed}:{ex_id}:{step}".encode()).hexdigest()
    return (int(h[:13], 16) + 0.5) / float(16 ** 13)


def _greedy_batch(score, srcs, seqs, ex_ids, max_len, **_):
    live = list(range(len(seqs)))
    for _ in range(max_len):
        if not live:
            break
        still = []
        for i, (tokens, z) in zip(live, rows_of(score([srcs[i] for i in live], [seqs[i] for i in live]))):
            t = int(tokens[np.argmax(z)]) if len(z) else EOS_ID
            seqs[i].append(t)
            if t != EOS_ID:
                still.append(i)
        live = still
    return seqs


def _random_batch(score, srcs, seqs, ex_ids, max_len, top_n=None, temperature=1.0, seed=0, **_):
    t = max(float(temperature), 1e-5)
    live = list(range(len(seqs)))
    for step in range(max_len):
        if not live:
            break
        still = []
        for i, (tokens, z) in zip(live, rows_of(score([srcs[i] for i in live], [seqs[i] for i in live]))):
            nxt = EOS_ID
            if len(z):
                z = z / t
                if top_n is not None and len(z) > top_n:
                    keep = z >= np.sort(z)[::-1][top_n - 1]
                    tokens, z = tokens[keep], z[keep]
                best = np.lexsort((tokens, -z))
                cum = np.cumsum(np.exp(z[best] - z.max()))
                at = np.searchsorted(cum, _uniform(seed, ex_ids[i], step) * cum[-1], side="right")
                nxt = int(tokens[best[min(at, len(best) - 1)]])
            seqs[i].append(nxt)
            if nxt != EOS_ID:
                still.append(i)
        live = still
    return seqs


def _best(tokens: np.ndarray, z: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest logits in falling order, ties by token; only what reaches the k-th is sorted."""
    some = np.arange(len(z))
    if 0 < k < len(z):
        near = np.flatnonzero(z >= np.partition(z, len(z) - k)[len(z) - k])
        some = near if len(near) >= k else some  # logits that are no numbers
    return some[np.lexsort((tokens[some], -z[some]))[:k]]


def _beam_batch(score, srcs, seqs, ex_ids, max_len, beam_size=5, temperature=1.0, diversity=0.0, vocab_size=None, **_):
    """Beam search with the reference scoring (see decoding.beam_step)."""
    t = max(float(temperature), 1e-5)
    k = candidates_per_beam(beam_size, vocab_size)
    beams = [[(list(p), 0.0)] for p in seqs]
    for step in range(max_len - 1):
        lp = ((6.0 + step) ** LENGTH_ALPHA) / (6.0 ** LENGTH_ALPHA)
        jobs = [(e, b) for e, bl in enumerate(beams) for b, (tok, _) in enumerate(bl)
                if not (tok[-1] == EOS_ID and step > 0)]
        found = dict(zip(jobs, rows_of(score([srcs[e] for e, _ in jobs], [beams[e][b][0] for e, b in jobs])))) if jobs else {}
        new_beams = []
        for e, bl in enumerate(beams):
            cands = []
            if diversity > 0:
                held, n_held = np.unique(np.array([x for tok, _ in bl for x in tok], np.int64), return_counts=True)
            for b, (tok, sc) in enumerate(bl):
                if (e, b) not in found:
                    cands.append((-sc, b, 0, None))
                    continue
                tokens, z = found[e, b]
                if not len(z):
                    tokens, z = np.array([EOS_ID]), np.zeros(1)  # no successor: the beam ends
                z = z / t
                if diversity > 0:
                    others = n_held - np.bincount(np.searchsorted(held, tok), minlength=len(held))
                    at = np.searchsorted(tokens, held)
                    hit = (others > 0) & (at < len(tokens)) & (tokens[np.minimum(at, len(tokens) - 1)] == held)
                    z[at[hit]] -= diversity * others[hit]
                order = _best(tokens, z, k)
                rep = REPETITION_PENALTY if (step > 0 and len(tok) >= NGRAM_SIZE) else 1.0
                cands += zip((-((sc + z[order]) / lp * rep)).tolist(), itertools.repeat(b), range(1, len(order) + 1), tokens[order].tolist())
            # the token lists of winners only are copied
            new_beams.append([(bl[b][0] if t is None else bl[b][0] + [t], -neg)
                              for neg, b, _, t in heapq.nsmallest(beam_size, cands, key=lambda x: x[:3])])
        beams = new_beams
        if all(tok[-1] == EOS_ID for bl in beams for tok, _ in bl):
            break
    return [bl[0][0] for bl in beams]


_STRATEGIES = {"greedy": _greedy_batch, "random": _random_batch, "beam": _beam_batch}


def decode_with_scorer(sources: DataFrame, make_scorer, strategy: str = "greedy",
                       max_len: int = 30, src: str = "x_src", prefix: str = "prefix",
                       out: str = "tokens", rows_per_call: int = 256, **options) -> DataFrame:
    """Decode ``sources(ex_id, src, prefix)`` with a batch scorer.

    At most ``rows_per_call`` sources (times the beam) are scored at once, which
    bounds the logits of a call; no result depends on it.

    ``greedy`` and ``random`` stop each row at its own eos (a row without any
    possible token emits eos); ``beam`` returns the best beam.  Options are
    those of the table-form decoders (``top_n``, ``temperature``, ``seed``,
    ``beam_size``, ``diversity``, ``vocab_size``)."""
    if strategy not in _STRATEGIES:
        raise ValueError(f"unknown decoding strategy {strategy!r}; known: {', '.join(_STRATEGIES)}")
    run_batch = _STRATEGIES[strategy]
    key = uuid.uuid4().hex

    def run(batches):
        score = worker_scorer(key, make_scorer)
        for whole in batches:
            for a in range(0, len(whole), rows_per_call):
                b = whole.iloc[a: a + rows_per_call]
                srcs = [list(x) for x in b[src]]
                seqs = [list(x) for x in b[prefix]]
                res = run_batch(score, srcs, seqs, b["ex_id"].tolist(), max_len, **options)
                yield pd.DataFrame({"ex_id": b["ex_id"], out: res})

    # sources are small and scoring them is not: joins of small tables leave them in few partitions
    tasks = TASKS_PER_CORE * sources.sparkSession.sparkContext.defaultParallelism
    return sources.select("ex_id", src, prefix).repartition(tasks).mapInPandas(run, f"ex_id long, {out} array<int>")
