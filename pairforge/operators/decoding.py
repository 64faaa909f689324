"""Sequence decoding over a next-token score table.

The scorer is a DataFrame ``scores(prev_id, token_id, logit)``: the logits
of every token that may follow ``prev_id`` (tokens not listed cannot
follow).  Sources are rows ``(ex_id, prefix ARRAY<INT>)``.

* Greedy decoding depends only on the last token, so it is solved on the
  bounded ``prev_id → best next`` table by path doubling (log2(max_len)
  joins) and applied to all sources with one join.
* Random decoding keeps cumulative weights per ``prev_id``; a step draws one
  uniform number per source and finds its token by bisection, so the state stays
  one row per source.
* Beam decoding keeps one sorted list of successors per ``prev_id``, cut to the
  length that any step can need; a step looks the list up, picks the candidates
  inside the row and emits at most ``2 × beam`` rows per beam.
* The state is checkpointed to the shared checkpoint folder every
  ``checkpoint_every`` steps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..constants import (BEAM_SIZE, BOS_ID, EOS_ID, LENGTH_ALPHA, NGRAM_SIZE, PAD_ID, REPETITION_PENALTY,
                         SAMPLE_MAX_LEN)
from ..functions.arrays import first_above, length_penalty, ngrams
from ..functions.normalize import text_portions
from ..session import drop_stored, fits_broadcast, materialize, stored

#: ids whose pairs are counted at once
PAIR_PORTION = 1_000_000
#: successors whose cumulative weights lie in one array
DRAW_BLOCK = 256


def bigram_scores(df: DataFrame, ids: str) -> DataFrame:
    """Score table of an add-one bigram model over ``[bos] + ids + [eos]``:
    ``logit = ln((c + 1) / (C_prev + V))``."""
    return _pair_scores(df.select(F.col(ids).cast("array<int>").alias("_s")).mapInArrow(_pair_counts, "prev_id int, token_id int, count long"))


def char_bigram_scores(df: DataFrame, text: str, to_id=lambda code: code) -> DataFrame:
    """:func:`bigram_scores` over the code points of texts, each as the id that ``to_id`` makes of it (a column
    expression, which bos and eos go through too).  Texts are counted as they are, without a list of ids for each."""
    pairs = df.select(F.col(text).alias("_t")).mapInArrow(_char_pair_counts, "prev_id int, token_id int, count long")
    return _pair_scores(pairs.select(to_id(F.col("prev_id")).alias("prev_id"), to_id(F.col("token_id")).alias("token_id"), "count"))


def _pair_scores(pairs: DataFrame) -> DataFrame:
    c = materialize(pairs.groupBy("prev_id", "token_id").agg(F.sum("count").alias("count")))
    v = c.select("token_id").distinct().count()
    tot = c.groupBy("prev_id").agg(F.sum("count").alias("_C"))
    return (c.join(tot, "prev_id")
             .select(F.col("prev_id").cast("int"), F.col("token_id").cast("int"),
                     F.log((F.col("count") + 1) / (F.col("_C") + F.lit(v))).alias("logit")))


def _pair_counts(batches):
    """Neighbouring ids of ``[bos] + ids + [eos]`` with their number, a portion of rows at a time; null rows have none."""
    for b in batches:
        rows = b.column(0).drop_null()
        a = 0
        while a < len(rows):
            offsets = rows.offsets.to_numpy()
            stop = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PAIR_PORTION, side="right")) - 1)
            some = rows.slice(a, stop - a)
            values, at = some.flatten(), offsets[a: stop + 1] - offsets[a]
            # bos and eos stand behind the ids; the rest are places of ids
            ids = pa.concat_arrays([values.cast(pa.int32()), pa.array([BOS_ID, EOS_ID], pa.int32())])
            place = np.arange(len(values))
            table = pa.table({"prev_id": ids.take(pa.array(np.insert(place, at[:-1], len(values)))),
                              "token_id": ids.take(pa.array(np.insert(place, at[1:], len(values) + 1)))})
            found = table.group_by(["prev_id", "token_id"], use_threads=False).aggregate([([], "count_all")])
            for part in found.select(["prev_id", "token_id", "count_all"]).rename_columns(["prev_id", "token_id", "count"]).to_batches():
                yield part
            a = stop


def _char_pair_counts(batches):
    """What :func:`_pair_counts` gives for the code points of texts."""
    for b in batches:
        for texts in text_portions(b.column(0).drop_null()):
            code = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
            ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
            starts = np.append(0, ends[:-1])
            used = np.zeros(0x110000, bool)
            used[code] = used[[BOS_ID, EOS_ID]] = True
            ids = np.flatnonzero(used)
            number = np.cumsum(used) - 1
            code = number[code]
            pair = np.insert(code, starts, number[BOS_ID]) * len(ids) + np.insert(code, ends, number[EOS_ID])
            if len(ids) ** 2 <= max(PAIR_PORTION, len(pair)):
                count = np.bincount(pair, minlength=1)
                pair = np.flatnonzero(count)
                count = count[pair]
            else:
                pair, count = np.unique(pair, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids[pair // len(ids)], pa.int32()), pa.array(ids[pair % len(ids)], pa.int32()),
                                              pa.array(count, pa.int64())], names=["prev_id", "token_id", "count"])


def init_prefix(df: DataFrame, src: str = "src_ids", prefix: str | None = None) -> DataFrame:
    """Default prefix ``[bos]``; an empty source is an error."""
    bad = df.filter((F.col(src).isNull()) | (F.size(src) == 0)).limit(1).count()
    if bad:
        raise ValueError(f"column {src} has null or empty sources")
    p = F.col(prefix) if prefix else F.array(F.lit(BOS_ID))
    return df.withColumn("prefix", p)


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def best_next(scores: DataFrame, temperature: float = 1.0) -> DataFrame:
    """(prev_id, next_id): argmax logit; ties → lowest token id."""
    return scores.groupBy("prev_id").agg(
        F.max_by("token_id", F.struct(F.col("logit"), -F.col("token_id"))).alias("next_id"))


def greedy_paths(scores: DataFrame, max_len: int, cut: bool = True) -> DataFrame:
    """(prev_id, path): the greedy continuation of ``max_len`` tokens from each
    token, with ``cut`` up to the first eos.  A token without successors emits eos."""
    nxt = best_next(scores)
    tokens = (scores.select(F.col("prev_id").alias("t"))
                    .union(scores.select(F.col("token_id").alias("t")))
                    .union(F.broadcast(nxt.sparkSession.range(1).select(F.lit(EOS_ID).cast("int").alias("t"))))
                    .distinct())
    step = (tokens.join(nxt, tokens.t == nxt.prev_id, "left")
                  .select(F.col("t").alias("prev_id"),
                          F.array(F.coalesce("next_id", F.lit(EOS_ID)).cast("int")).alias("path")))
    step = materialize(step)
    length, paths = 1, step
    while length < max_len:
        # double: path(t) ++ path(last(path(t)))
        ext = paths.select(F.col("prev_id").alias("_t"), F.col("path").alias("_ext"))
        ext = _maybe_broadcast(ext)
        paths = (paths.withColumn("_last", F.element_at("path", -1))
                      .join(ext, F.col("_last") == F.col("_t"))
                      .select("prev_id", F.concat("path", "_ext").alias("path")))
        length *= 2
        paths = materialize(paths)
    path = F.slice("path", 1, max_len)
    return paths.select("prev_id", (_cut_at_eos(path) if cut else path).alias("path"))


def _cut_at_eos(arr):
    pos = F.array_position(arr, EOS_ID)
    return F.when(pos > 0, F.slice(arr, F.lit(1), pos.cast("int"))).otherwise(arr)


def decode_greedy(sources: DataFrame, scores: DataFrame, max_len: int = SAMPLE_MAX_LEN,
                  mode: str = "per_row", prefix: str = "prefix", out: str = "tokens") -> DataFrame:
    """Append the argmax token up to ``max_len`` times.

    ``per_row``: each row stops at its own first eos.  ``reference``: every row
    keeps appending its argmax (an ended row too, by the successors of eos) until
    all rows emit eos in the same step, or ``max_len`` tokens."""
    if mode not in ("per_row", "reference"):
        raise ValueError(f"unknown mode {mode}")
    paths = greedy_paths(scores, max_len, cut=mode == "per_row").withColumnRenamed("prev_id", "_t")
    paths = _maybe_broadcast(paths)
    if mode == "reference":
        sources = stored(sources, "sources")  # read twice
    d = (sources.withColumn("_t", F.element_at(prefix, -1))
                .join(paths, "_t", "left")
                .withColumn("path", F.coalesce("path", F.array_repeat(F.lit(EOS_ID), 1 if mode == "per_row" else max_len))))
    if mode == "reference":
        # steps in which some row emits another token: at most max_len numbers
        last = sources.select(F.element_at(prefix, -1).alias("_t")).distinct()
        running = {r[0] for r in paths.join(last, "_t", "left_semi").select(F.posexplode("path").alias("step", "t"))
                   .filter(F.col("t") != EOS_ID).select("step").distinct().collect()}
        steps = next((s + 1 for s in range(max_len) if s not in running), max_len)
        d = d.withColumn("path", F.slice("path", 1, steps))
    return d.withColumn(out, F.concat(prefix, "path")).drop("_t", "path")


def uniform_hash(seed, *cols):
    """A uniform (0, 1) number from md5(seed:cols) — reproducible on retry."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(16 ** 13))


def _by_example(df: DataFrame) -> DataFrame:
    """Hash-partition the decoding state by ``ex_id``; windows and aggregates
    keyed by ``ex_id`` (or a superset) then need no further shuffle within a
    step."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "ex_id")


def _last_token(tokens, ended):
    """The join key of a state row: its last token.  Ended rows match no token and
    are dealt out evenly by negative keys, so they never meet in one task."""
    return F.when(ended, (-1 - F.pmod(F.xxhash64("ex_id"), F.lit(1 << 30))).cast("int")).otherwise(F.element_at(tokens, -1))


def successor_lists(scores: DataFrame, temperature: float = 1.0, keep: int | None = None) -> DataFrame:
    """(prev_id, succ): the successors of every token as one list of (minus logit / t, token id),
    best first, ties by token id; with ``keep`` only its first entries."""
    t = max(float(temperature), 1e-5)
    z = scores.select("prev_id", (-(F.col("logit") / F.lit(t))).alias("nz"), F.col("token_id").cast("int"))
    if keep is not None:
        w = Window.partitionBy("prev_id").orderBy("nz", "token_id")
        z = z.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= keep)
    return z.groupBy("prev_id").agg(F.sort_array(F.collect_list(F.struct("nz", "token_id"))).alias("succ"))


def draw_tables(scores: DataFrame, top_n: int | None = None, temperature: float = 1.0,
                block: int = DRAW_BLOCK) -> tuple[DataFrame, DataFrame]:
    """Cumulative softmax weights of the successors of every token, best first (ties by token id).

    Returns ``tops(prev_id, total, ends)``, with the cumulative weight at the end of every
    block of ``block`` successors, and ``blocks(prev_id, block, cum, drawn)``.  ``top_n``
    keeps the n best and what ties with the last of them."""
    t = max(float(temperature), 1e-5)
    z = scores.select("prev_id", "token_id", (F.col("logit") / F.lit(t)).alias("z"))
    w = Window.partitionBy("prev_id").orderBy(F.col("z").desc(), "token_id")
    if top_n is not None:
        best = Window.partitionBy("prev_id").orderBy(F.col("z").desc())
        z = z.withColumn("_r", F.rank().over(best)).filter(F.col("_r") <= top_n)
    z = z.withColumn("_w", F.exp(F.col("z") - F.max("z").over(Window.partitionBy("prev_id"))))
    z = z.select("prev_id", "token_id", F.sum("_w").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                 F.row_number().over(w).alias("_n"))
    blocks = materialize(
        z.groupBy("prev_id", F.floor((F.col("_n") - 1) / F.lit(block)).cast("int").alias("block"))
         .agg(F.sort_array(F.collect_list(F.struct("_n", "cum", "token_id"))).alias("_l"))
         .select("prev_id", "block", F.col("_l.cum").alias("cum"), F.col("_l.token_id").cast("array<int>").alias("drawn")))
    tops = (blocks.groupBy("prev_id")
                  .agg(F.sort_array(F.collect_list(F.struct("block", F.element_at("cum", -1).alias("end")))).alias("_e"))
                  .select("prev_id", F.col("_e.end").alias("ends"), F.element_at("_e.end", -1).alias("total")))
    return tops, blocks


class _StateLoop:
    """Per-step state of an iterative decoder.

    Steps are chained into one job of ``every`` steps, whose result is written to the
    shared checkpoint folder and read back: a lost executor replays at most so many steps.
    The step number is a column of the state, so every job has the same plan and the same
    generated code.  A state goes when the next one is written."""

    def __init__(self, state: DataFrame, every: int = 4):
        self.every, self.n = max(1, every or 1), 0
        self.written = stored(state, "decoding")
        self.state = _by_example(self.written)

    def _write(self, state: DataFrame) -> None:
        # a written state reads nothing of the one before, which may go
        before, self.written = self.written, stored(state, "decoding")
        drop_stored(before)
        self.state = _by_example(self.written)

    def advance(self, nxt: DataFrame, live) -> int | None:
        """Make ``nxt`` the state; where a job ends, the number of rows that are still ``live``."""
        self.n += 1
        self.state = nxt
        if self.n % self.every:
            return None
        self._write(nxt)
        return self.written.filter(live).count()

    def finish(self) -> DataFrame:
        if self.n % self.every:
            self._write(self.state)
        return self.written


def decode_random(sources: DataFrame, scores: DataFrame, max_len: int = SAMPLE_MAX_LEN,
                  top_n: int | None = None, temperature: float = 1.0, seed: int = 0, mode: str = "per_row",
                  prefix: str = "prefix", out: str = "tokens", checkpoint_every: int = 4) -> DataFrame:
    """Per step, logits / t → top-n mask → one draw from the softmax.

    The draw inverts the cumulative weights (``draw_tables``) at a uniform number hashed
    from (seed, example, step): the block is found by bisection, then the token in it.
    ``per_row``: each row stops at its own first eos.  ``reference``: every row keeps
    drawing until all rows draw eos in the same step, or ``max_len`` tokens."""
    if mode not in ("per_row", "reference"):
        raise ValueError(f"unknown mode {mode}")
    tops, blocks = draw_tables(scores, top_n, temperature, DRAW_BLOCK)
    tops, blocks = (_maybe_broadcast(d.withColumnRenamed("prev_id", "_p")) for d in (tops, blocks))
    st = sources.select("ex_id", F.col(prefix).cast("array<int>").alias(out), F.lit(False).alias("_done"), F.lit(0).alias("_step"))
    # the common stop of the reference has to be looked for after every step
    loop = _StateLoop(st, checkpoint_every if mode == "per_row" else 1)
    for _ in range(max_len):
        c = loop.state.withColumn("_p", _last_token(out, F.col("_done"))).join(tops, "_p", "left")
        c = c.withColumn("_x", uniform_hash(seed, F.col("ex_id"), F.col("_step")) * F.col("total"))
        # rounding may put the number at the total itself: the last block, the last token
        c = c.withColumn("block", F.least(first_above("ends", "_x"), F.size("ends") - 1)).join(blocks, ["_p", "block"], "left")
        nxt = F.coalesce(F.get("drawn", F.least(first_above("cum", "_x", DRAW_BLOCK), F.size("cum") - 1)), F.lit(EOS_ID))
        n_live = loop.advance(
            c.withColumn("_t", nxt)
             .select("ex_id", F.when(F.col("_done"), F.col(out)).otherwise(F.concat(out, F.array("_t"))).alias(out),
                     (F.col("_done") | ((F.col("_t") == EOS_ID) & F.lit(mode == "per_row"))).alias("_done"),
                     (F.col("_step") + 1).alias("_step")),
            live=(~F.col("_done")) if mode == "per_row" else F.element_at(out, -1) != EOS_ID)
        if n_live == 0:
            break
    return loop.finish().drop("_done", "_step")


def expand_beams(state: DataFrame, succ: DataFrame, beam_size: int, diversity: float = 0.0,
                 mode: str = "reference", vocab_size: int | None = None) -> DataFrame:
    """One D4 round (D3 + D5 + D6 + R4) on ``state(ex_id, beams array<struct<tokens, score>>, step)``,
    one row per example: expand live beams, carry ended ones, keep the best ``beam_size``.

    ``succ`` holds the ``successor_lists``.  A beam reads the first k entries of its list;
    with a diversity penalty as many more as the example's beams hold distinct tokens,
    because only those can fall behind.  Candidates of a beam are ordered by adjusted
    logit (ties → lower token id); the final order is (score desc, parent, candidate), the
    stable order of the reference's sort.  Only winners get their token lists copied."""
    if mode not in ("reference", "standard"):
        raise ValueError(f"unknown mode {mode}")
    k = candidates_per_beam(beam_size, vocab_size)
    keep = ["ex_id", "step"]
    if diversity > 0:
        # how often the example's beams hold each of their tokens
        state = state.withColumn("_all", F.flatten(F.transform("beams", lambda b: b.tokens)))
        state = state.withColumn("_held", F.array_distinct("_all"))
        state = state.withColumn("_counts", F.map_from_arrays("_held", F.transform(
            "_held", lambda t: F.size("_all") - F.size(F.array_remove("_all", t)))))
        keep.append("_counts")
    c = state.select(*keep, F.posexplode("beams").alias("_i", "_b")).select(*keep, "_i", "_b.tokens", "_b.score")
    c = c.withColumn("_ended", (F.element_at("tokens", -1) == EOS_ID) & (F.col("step") > 0))
    c = c.withColumn("_p", _last_token("tokens", F.col("_ended"))).join(succ.withColumnRenamed("prev_id", "_p"), "_p", "left")
    # a beam without successors emits eos with logit 0, as the other decoders do: no source is lost
    end = F.array(F.struct(F.lit(0.0).alias("nz"), F.lit(EOS_ID).alias("token_id")))
    best = F.coalesce("succ", end)
    if diversity > 0:
        def behind(s):
            own = F.size("tokens") - F.size(F.array_remove("tokens", s.token_id))
            others = F.coalesce(F.try_element_at("_counts", s.token_id), F.lit(0)) - own
            return F.struct((s.nz + F.lit(diversity) * others).alias("nz"), s.token_id.alias("token_id"))
        head = F.slice(best, F.lit(1), F.lit(k) + F.size("_counts"))
        best = F.sort_array(F.transform(head, behind))
    c = c.withColumn("_best", F.when(~F.col("_ended"), F.slice(best, 1, k)))
    c = c.withColumn("_lp", length_penalty(F.col("step"), LENGTH_ALPHA))
    if mode == "reference":
        # The candidate's n-grams contain all of its parent's, and the parent's
        # own set is tested, so the penalty fires exactly when the parent holds
        # an n-gram (from step 1 on; the sets start empty).
        c = c.withColumn("_rep", F.when((F.col("step") > 0) & (F.size("tokens") >= NGRAM_SIZE), F.lit(REPETITION_PENALTY))
                         .otherwise(F.lit(1.0)))

        def score(s):
            return (F.col("score") - s.nz) / F.col("_lp") * F.col("_rep")
    else:
        # penalty only for a new repeat: the candidate's last n-gram already in the parent
        c = c.withColumns({"_pg": ngrams("tokens", NGRAM_SIZE), "_tail": F.slice("tokens", -F.least(F.size("tokens"), F.lit(NGRAM_SIZE - 1)), NGRAM_SIZE - 1)})

        def score(s):
            again = (F.size("tokens") >= NGRAM_SIZE - 1) & F.array_contains("_pg", F.concat("_tail", F.array(s.token_id)))
            return F.col("score") - s.nz + F.when(again, F.log(F.lit(REPETITION_PENALTY))).otherwise(F.lit(0.0))

    # minus score, candidate, token; an ended beam is its own candidate, without a token
    found = F.transform("_best", lambda s, i: F.struct((-score(s)).alias("neg"), F.col("_i").alias("parent"),
                                                       (i + 1).alias("cand"), s.token_id.alias("token")))
    itself = F.array(F.struct((-F.col("score")).alias("neg"), F.col("_i").alias("parent"), F.lit(0).alias("cand"),
                              F.lit(None).cast("int").alias("token")))
    g = (c.select("ex_id", "step", F.struct("_i", "tokens", F.coalesce(found, itself).alias("cands")).alias("_r"))
          .groupBy("ex_id").agg(F.min("step").alias("step"), F.sort_array(F.collect_list("_r")).alias("_rows")))
    g = g.withColumn("_top", F.slice(F.sort_array(F.flatten(F.transform("_rows", lambda r: r.cands))), 1, beam_size))

    def winner(w):
        parent = F.element_at("_rows", w.parent + 1).tokens
        return F.struct(F.when(w.token.isNull(), parent).otherwise(F.concat(parent, F.array(w.token))).alias("tokens"),
                        (-w.neg).alias("score"))

    return g.select("ex_id", F.transform("_top", winner).alias("beams"), (F.col("step") + 1).alias("step"))


def beam_step(beams: DataFrame, scores: DataFrame, step: int, beam_size: int, temperature: float = 1.0,
              diversity: float = 0.0, mode: str = "reference", vocab_size: int | None = None) -> DataFrame:
    """``expand_beams`` on one row per beam: ``(ex_id, beam_idx, tokens, score)`` in and out, with a score table."""
    succ = _maybe_broadcast(stored(successor_lists(scores, temperature), "successors"))
    state = (beams.groupBy("ex_id").agg(F.sort_array(F.collect_list(F.struct("beam_idx", "tokens", F.col("score").cast("double").alias("score")))).alias("_b"))
                  .select("ex_id", F.transform("_b", lambda b: F.struct(b.tokens.cast("array<int>").alias("tokens"), b.score.alias("score"))).alias("beams"),
                          F.lit(step).alias("step")))
    return _beam_rows(expand_beams(state, succ, beam_size, diversity, mode, vocab_size))


def _beam_rows(state: DataFrame) -> DataFrame:
    return state.select("ex_id", F.posexplode("beams").alias("beam_idx", "_b")).select("ex_id", "beam_idx", "_b.tokens", "_b.score")


def candidates_per_beam(beam_size: int, vocab_size: int | None = None) -> int:
    """Successors that a beam may be followed by: twice the beam, below the vocabulary size."""
    return 2 * beam_size if vocab_size is None else min(2 * beam_size, vocab_size - 1)


def decode_beam(sources: DataFrame, scores: DataFrame, max_len: int = SAMPLE_MAX_LEN,
                beam_size: int = BEAM_SIZE, temperature: float = 1.0, diversity: float = 0.0,
                mode: str = "reference", prefix: str = "prefix", checkpoint_every: int = 4,
                all_beams: bool = False, vocab_size: int | None = None) -> DataFrame:
    """Beam search for every source; returns the best beam per ``ex_id``
    (or every final beam with ``all_beams``).  Stops early when every beam of
    every example has ended."""
    sources = stored(sources.select("ex_id", F.col(prefix).cast("array<int>").alias("tokens")), "sources")
    keep = candidates_per_beam(beam_size, vocab_size)
    if diversity > 0:
        # no step can read further: tokens that the other beams hold
        longest = sources.agg(F.max(F.size("tokens"))).first()[0] or 0
        keep += beam_size * (longest + max_len)
    succ = _maybe_broadcast(stored(successor_lists(scores, temperature, keep), "successors"))
    start = F.array(F.struct("tokens", F.lit(0.0).alias("score")))
    loop = _StateLoop(sources.select("ex_id", start.alias("beams"), F.lit(0).alias("step")), checkpoint_every)
    for _ in range(max_len - 1):
        n_live = loop.advance(expand_beams(loop.state, succ, beam_size, diversity, mode, vocab_size),
                              live=F.exists("beams", lambda b: F.element_at(b.tokens, -1) != EOS_ID))
        if n_live == 0:
            break
    beams = _beam_rows(loop.finish()).withColumn("done", F.element_at("tokens", -1) == EOS_ID)
    return beams if all_beams else beams.filter(F.col("beam_idx") == 0).drop("beam_idx")


def decode(sources: DataFrame, scores: DataFrame, strategy: str = "greedy", **kw) -> DataFrame:
    """Dispatch by strategy name."""
    fns = {"greedy": decode_greedy, "random": decode_random, "beam": decode_beam}
    if strategy not in fns:
        raise ValueError(f"unknown decoding strategy {strategy!r}; known: {', '.join(fns)}")
    return fns[strategy](sources, scores, **kw)


def pad_outputs(df: DataFrame, col: str = "tokens", pad_id: int = PAD_ID) -> DataFrame:
    """Pad the id lists of a result to its longest row."""
    df = materialize(df)
    width = df.agg(F.max(F.size(col))).first()[0] or 0
    return df.withColumn(col, F.concat(col, F.array_repeat(F.lit(pad_id), F.lit(width) - F.size(col))))
