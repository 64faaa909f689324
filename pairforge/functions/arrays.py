"""Array expressions over id sequences (P5-P9, P12-P15, F3, T5 helpers)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import BOS_ID, EOS_ID, MASK_VALUE, PAD_ID


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _int_array(*vals) -> Column:
    return F.array(*[F.lit(v).cast("int") for v in vals])


def char_ids(col) -> Column:
    """Unicode code points of a string as ARRAY<INT> (empty string → [])."""
    c = _c(col)
    return F.when(F.length(c) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.split(c, ""), lambda ch: F.ascii(ch)))


def strip_pad(ids, pad: int = PAD_ID) -> Column:
    """drop pad ids."""
    return F.filter(_c(ids), lambda x: x != F.lit(pad))


def truncate_with_eos(ids, max_len: int) -> Column:
    """P5: first ``max_len-1`` ids, then eos."""
    return F.concat(F.slice(_c(ids), 1, max_len - 1), _int_array(EOS_ID))


def _head(ids: Column, n: Column) -> Column:
    """First ``n`` elements; ``n`` ≤ 0 gives []."""
    return F.when(n <= 0, F.array().cast("array<int>")).otherwise(F.slice(ids, F.lit(1), n))


def teacher_forcing(ids, max_len: int, shift: str = "skip") -> tuple[Column, Column]:
    """Decoder input and labels from target ids.

    ``shift="skip"`` keeps the training setup's layout: with ``t`` the first
    ``max_len-2`` ids, ``x = [bos] + t[:-1]`` and ``y = t[1:] + [eos]``.
    ``shift="standard"`` gives ``x = [bos] + t`` and ``y = t + [eos]``.
    """
    c = _c(ids)
    t = _head(c, F.lit(max_len - 2))
    n = F.size(t)
    if shift == "skip":
        x = F.concat(_int_array(BOS_ID), _head(t, n - 1))
        tail = F.when(n <= 1, F.array().cast("array<int>")).otherwise(F.slice(t, F.lit(2), n))
        y = F.concat(tail, _int_array(EOS_ID))
    elif shift == "standard":
        x = F.concat(_int_array(BOS_ID), t)
        y = F.concat(t, _int_array(EOS_ID))
    else:
        raise ValueError(f"unknown shift mode: {shift}")
    return x, y


def ngrams(ids, n: int = 3, distinct: bool = True) -> Column:
    """All length-``n`` windows; a set when ``distinct``."""
    c = _c(ids)
    empty = F.filter(F.array(F.slice(c, 1, n)), lambda x: F.lit(False))
    allg = F.when(F.size(c) >= n, F.transform(
        F.sequence(F.lit(1), F.size(c) - n + 1), lambda i: F.slice(c, i, n))).otherwise(empty)
    return F.array_distinct(allg) if distinct else allg


def has_repeated_ngram(ids, n: int = 3) -> Column:
    """True when some ``n``-gram occurs twice."""
    allg = ngrams(ids, n, distinct=False)
    return F.size(allg) > F.size(F.array_distinct(allg))


def pad_mask(ids, pad: int = PAD_ID) -> Column:
    """Per position ``id != pad``."""
    return F.transform(_c(ids), lambda x: x != F.lit(pad))


def right_pad(ids, length, pad: int = PAD_ID) -> Column:
    """Right-pad to ``length`` with ``pad``."""
    c = _c(ids)
    ln = length if isinstance(length, Column) else F.lit(length)
    return F.concat(c, F.array_repeat(F.lit(pad).cast("int"), F.greatest(ln - F.size(c), F.lit(0))))


def apply_temperature(logits, t: float) -> Column:
    """``logits / max(t, 1e-5)``."""
    d = max(float(t), 1e-5)
    return F.transform(_c(logits), lambda x: x / F.lit(d))


def _with_scalar(arr: Column, scalar: Column, fn) -> Column:
    """``transform(arr, x -> fn(x, scalar))`` with ``scalar`` evaluated once per
    row (an outer expression inside a lambda would be re-evaluated per element)."""
    return F.zip_with(arr, F.array_repeat(scalar, F.size(arr)), fn)


def _lse_state(c: Column) -> Column:
    """One pass over ``c``: struct(m = running max, s = Σ exp(x - m))."""
    init = F.struct(F.lit(float("-inf")).alias("m"), F.lit(0.0).alias("s"))

    def step(acc, x):
        m2 = F.greatest(acc["m"], x.cast("double"))
        return F.struct(m2.alias("m"), (acc["s"] * F.exp(acc["m"] - m2) + F.exp(x - m2)).alias("s"))
    return F.aggregate(c, init, step)


def logsumexp(logits) -> Column:
    st = _lse_state(_c(logits))
    return st["m"] + F.log(st["s"])


def log_softmax(logits) -> Column:
    """P10: max-shifted log-softmax of ARRAY<DOUBLE>, linear per row."""
    c = _c(logits)
    return _with_scalar(c, logsumexp(c), lambda x, lse: x - lse)


def softmax(logits) -> Column:
    """P10: max-shifted softmax of ARRAY<DOUBLE>, linear per row."""
    c = _c(logits)
    return _with_scalar(c, _lse_state(c), lambda x, st: F.exp(x - st["m"]) / st["s"])


def argmax(logits) -> Column:
    """0-based index of the largest value; ties → lowest index."""
    c = _c(logits)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def mask_top_n(logits, n: int, fill: float = MASK_VALUE) -> Column:
    """Values below the n-th largest become ``fill``; ties at the threshold stay."""
    c = _c(logits)
    thr = F.element_at(F.reverse(F.array_sort(c)), n)
    return _with_scalar(c, thr, lambda x, t: F.when(x < t, F.lit(fill)).otherwise(x))


def length_penalty(step, alpha: float = 0.6) -> Column:
    """``((6 + step) ** alpha) / (6 ** alpha)``."""
    s = _c(step) if not isinstance(step, (int, float)) else F.lit(step)
    return F.pow(F.lit(6.0) + s, F.lit(alpha)) / F.lit(6.0 ** alpha)


def first_above(arr, x, most: int = 1 << 30) -> Column:
    """Index (from 0) of the first entry of a sorted array above ``x``, by bisection; the array's size if none is."""
    arr, x = _c(arr), _c(x)
    start = F.struct(F.lit(0).alias("lo"), F.size(arr).alias("hi"))

    def halve(s, _):
        mid = F.floor((s.lo + s.hi) / 2).cast("int")
        up = F.get(arr, mid) <= x
        return F.when(s.lo >= s.hi, s).otherwise(
            F.struct(F.when(up, mid + 1).otherwise(s.lo).alias("lo"), F.when(up, s.hi).otherwise(mid).alias("hi")))

    rounds = F.array(*[F.lit(k) for k in range(most.bit_length())])
    return F.aggregate(rounds, start, halve, lambda s: s.lo)
