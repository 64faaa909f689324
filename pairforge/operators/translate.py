"""Translation of a text column (D8): text → ids → decoding → text.

Every source starts from ``[bos]``; the scorer gets the whole source at every
step, so any word of it can change the result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..constants import BOS_ID, EOS_ID, MAX_LEN, SAMPLE_MAX_LEN
from ..functions.arrays import right_pad
from ..functions.text import clean_text
from ..session import stored
from . import tokenizer as TK
from .decoding import init_prefix
from .scorer import decode_with_scorer, table_scorer
from .split import sample_one


def source_scorer(scores: DataFrame, bonus: float = 1.0, max_rows: int = 5_000_000):
    """A sparse scorer that reads the source: bigram logits, plus ``bonus`` for each
    possible token that the source holds and the prefix doesn't hold yet."""
    base = table_scorer(scores, max_rows)

    def make():
        inner = base()

        def score(srcs, prefixes):
            z = inner(srcs, prefixes)
            for r, (src, pre) in enumerate(zip(srcs, prefixes)):
                todo = np.array(sorted(set(src) - set(pre) - {EOS_ID}), np.int64)
                a, b = z.offsets[r], z.offsets[r + 1]
                z.logits[a:b] += bonus * np.isin(z.tokens[a:b], todo)
            return z
        return score
    return make


def translate(df: DataFrame, src_vocab: DataFrame, tgt_vocab: DataFrame, make_scorer, strategy: str = "beam",
              src: str = "src", key: str = "line_no", clean: bool = True, add_eos: bool = False,
              max_len: int = SAMPLE_MAX_LEN, out: str = "translation", pad_to: int | None = None, **options) -> DataFrame:
    """``key`` and the translation of ``src``, one row per input row.

    ``clean`` applies the corpus cleanup first; ``add_eos`` ends the source ids
    with eos, as training does.  ``pad_to`` pads the token column ``tokens`` to a
    rectangle of that width (P15)."""
    d = df.select(F.col(key).alias("ex_id"), (clean_text(src) if clean else F.col(src)).alias("_t"))
    ids = F.concat("_s", F.array(F.lit(EOS_ID))) if add_eos else F.col("_s")
    d = TK.encode(d, "_t", src_vocab, "_s").select("ex_id", ids.alias("x_src"), F.array(F.lit(BOS_ID)).alias("prefix"))
    r = decode_with_scorer(d, make_scorer, strategy, max_len=max_len, **options)
    r = TK.decode(r, "tokens", tgt_vocab, out)
    if pad_to:
        r = r.withColumn("tokens", right_pad("tokens", pad_to))
    return r.withColumnRenamed("ex_id", key)


def sample_report(df: DataFrame, src_vocab: DataFrame, tgt_vocab: DataFrame, make_scorer, seed, strategy: str = "beam",
                  src: str = "src", tgt: str = "tgt", key: str = "line_no", context: int = 3, max_ids: int = MAX_LEN,
                  max_len: int = SAMPLE_MAX_LEN, **options) -> DataFrame:
    """One reproducibly drawn row of ``df`` as text: ``key``, source, context, target and translation.

    The row is drawn before anything is encoded.  The decoder gets the row's whole
    source and starts from bos and the first ``context`` ids of the target input; an
    empty source is an error (D0)."""
    one = sample_one(df.select(key, src, tgt), seed, [key])
    one = TK.encode_pairs(stored(one, "sample"), src_vocab, tgt_vocab, max_ids, src=src, tgt=tgt).withColumnRenamed(key, "ex_id")
    one = one.withColumn("_start", F.concat(F.array(F.lit(BOS_ID)), F.slice("x_tgt", 1, context)))
    one = stored(init_prefix(one, "x_src", "_start"), "sample")
    r = decode_with_scorer(one, make_scorer, strategy, max_len=max_len, **options).join(one, "ex_id")
    for ids, vocab, out in (("x_src", src_vocab, "source"), ("x_tgt", tgt_vocab, "context"), ("y", tgt_vocab, "target"),
                            ("tokens", tgt_vocab, "translation")):
        r = TK.decode(r, ids, vocab, out)
    return r.select(F.col("ex_id").alias(key), "source", "context", "target", "translation")
