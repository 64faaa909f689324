"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (or data Spark derives from them) in
full.  Doubles are rounded to 6 places so results compare exactly with the
SQL oracle in :mod:`pairforge.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import BATCH_SIZE, MAX_LEN, MAX_ROWS, TRAIN_FRAC
from ..functions import arrays as A
from ..functions.text import clean_pairs, clean_text as clean_text_col, drop_missing, stringify_nulls, strip_text, words
from ..operators import batching as B
from ..operators import metrics as M
from ..operators import split as S
from ..operators import training_log as TL
from ..operators.bleu import sentence_bleu
from ..session import spread
from ..sources.files import rename_pairs, tokenizer_corpus
from ..sources.tables import conversation_pairs, table

R = 6


def _round(c, name):
    return F.round(F.col(c) if isinstance(c, str) else c, R).alias(name)


def cleaned_pairs(spark, sf_dir) -> DataFrame:
    p = conversation_pairs(spark, sf_dir)
    return clean_pairs(drop_missing(p, ["src", "tgt"]))


def q_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional pairing of user and assistant turns."""
    return conversation_pairs(spark, sf_dir)


def q_clean_pairs(spark, sf_dir):
    """F1 + P3 on both sides."""
    return cleaned_pairs(spark, sf_dir)


def q_pair_bleu(spark, sf_dir):
    """A5: sentence BLEU of the cleaned target words against the source words."""
    p = cleaned_pairs(spark, sf_dir).select("line_no", words("src").alias("sw"), words("tgt").alias("tw"))
    b = sentence_bleu(p, "sw", "tw", ["line_no"])
    return b.select("line_no", _round("bleu", "bleu"), "hyp_len", "ref_len")


def q_pair_stats(spark, sf_dir):
    """Flagship: pairs → F1 → P3 → T5 → A5 → per length bucket count, lengths, mean BLEU."""
    p = cleaned_pairs(spark, sf_dir).select("line_no", words("src").alias("sw"), words("tgt").alias("tw"))
    b = sentence_bleu(p, "sw", "tw", ["line_no"])
    return (b.withColumn("len_bucket", F.floor(F.col("ref_len") / 10).cast("long"))
             .groupBy("len_bucket")
             .agg(F.count(F.lit(1)).alias("n_pairs"),
                  _round(F.avg("ref_len"), "mean_src_words"),
                  _round(F.avg("hyp_len"), "mean_tgt_words"),
                  _round(F.coalesce(F.avg("bleu"), F.lit(0.0)), "mean_bleu")))


_PAIR_QUERIES = {
    "pairs": q_pairs,
    "clean_pairs": q_clean_pairs,
    "pair_bleu": q_pair_bleu,
    "pair_stats": q_pair_stats,
}


SEED = 42
LI_KEYS = ["l_orderkey", "l_linenumber"]


def _lineitem_keys(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*LI_KEYS)


def q_exact_split(spark, sf_dir):
    """R1 on lineitem: exactly round(0.9·N) rows flagged train."""
    return S.exact_split(_lineitem_keys(spark, sf_dir), TRAIN_FRAC, SEED, LI_KEYS)


def q_validation_rows(spark, sf_dir):
    """Rows left after removing the train rows (anti join)."""
    li = _lineitem_keys(spark, sf_dir)
    train = S.train_rows(S.exact_split(li, TRAIN_FRAC, SEED, LI_KEYS))
    return S.remove_rows(li, train, LI_KEYS)


def q_sample_one(spark, sf_dir):
    """R2: one reproducible random validation pair."""
    p = cleaned_pairs(spark, sf_dir)
    val = S.exact_split(p, TRAIN_FRAC, SEED, ["line_no"]).filter(~F.col("is_train")).drop("is_train")
    return S.sample_one(val, 7, ["line_no"])


def q_shuffle_batches(spark, sf_dir):
    """B1 + B2 on lineitem: epoch-0 order and batch numbers of 16."""
    r = B.shuffle_rank(_lineitem_keys(spark, sf_dir).withColumn("_k", F.concat_ws(":", *LI_KEYS)),
                       SEED, 0, "_k")
    return B.assign_batches(r, BATCH_SIZE).drop("_k")


def encoded_pairs(spark, sf_dir, shift="skip"):
    """Integer fixture: code points of the cleaned text as ids → P5 / P6."""
    p = cleaned_pairs(spark, sf_dir)
    x_tgt, y = A.teacher_forcing(A.char_ids("tgt"), MAX_LEN, shift)
    return p.select("line_no", A.truncate_with_eos(A.char_ids("src"), MAX_LEN).alias("x_src"),
                    x_tgt.alias("x_tgt"), y.alias("y"))


def q_teacher_forcing(spark, sf_dir):
    """P5 + P6 (reference shift) with max_len 1024."""
    return encoded_pairs(spark, sf_dir)


def q_teacher_forcing_standard(spark, sf_dir):
    """P6 with the standard one-token shift (Q1)."""
    return encoded_pairs(spark, sf_dir, "standard")


def _batched(spark, sf_dir):
    e = B.shuffle_rank(encoded_pairs(spark, sf_dir), SEED, 0, "line_no")
    return B.assign_batches(e, BATCH_SIZE)


def q_padded_batches(spark, sf_dir):
    """B1 → B2 → B3: shuffled batches padded per column to the batch maximum."""
    return B.pad_batches(_batched(spark, sf_dir), ["x_src", "x_tgt", "y"])


def q_collate(spark, sf_dir):
    """One row per batch with rectangular matrices."""
    return B.collate(_batched(spark, sf_dir), ["x_src", "x_tgt", "y"])


def q_batch_max_len(spark, sf_dir):
    """Longest row per column and batch."""
    return B.batch_max_len(_batched(spark, sf_dir), ["x_src", "x_tgt", "y"])


def q_pad_mask(spark, sf_dir):
    """P9 on padded source rows."""
    p = q_padded_batches(spark, sf_dir)
    return p.select("line_no", A.pad_mask("x_src").alias("mask"))


def q_validation_batches(spark, sf_dir):
    """B2 on validation rows in file order."""
    p = cleaned_pairs(spark, sf_dir).select("line_no")
    val = S.exact_split(p, TRAIN_FRAC, SEED, ["line_no"]).filter(~F.col("is_train")).drop("is_train")
    return B.assign_batches(B.file_order_rank(val, "line_no"), BATCH_SIZE)


def q_ngram_stats(spark, sf_dir):
    """P7 + P8: distinct trigram count and repeated-trigram flag of target ids."""
    e = cleaned_pairs(spark, sf_dir).select("line_no", A.char_ids("tgt").alias("ids"))
    return e.select("line_no", F.size(A.ngrams("ids", 3)).cast("long").alias("n_trigrams"),
                    A.has_repeated_ngram("ids", 3).alias("has_repeat"))


def _logits(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("logits"), F.col("label").alias("y"))


def q_logit_ops(spark, sf_dir):
    """P10-P13 on embedding rows read as logits."""
    d = _logits(spark, sf_dir)
    return d.select(
        "vec_id",
        A.argmax("logits").alias("arg"),
        _round(F.array_max(A.softmax("logits")), "p_max"),
        _round(F.element_at(A.log_softmax(A.apply_temperature("logits", 1.2)), F.col("y") + 1), "lsm_label"),
        F.size(F.filter(A.mask_top_n("logits", 5), lambda x: x == F.lit(-1e9))).cast("long").alias("n_masked"),
        _round(F.array_max(A.apply_temperature("logits", 1.2)), "max_scaled"))


def q_token_accuracy(spark, sf_dir):
    """A3: argmax predictions against labels; label 0 (pad) not counted."""
    d = _logits(spark, sf_dir).withColumn("pred", A.argmax("logits"))
    r = M.token_accuracy(d, "pred", "y")
    return r.select("correct", "counted", _round("accuracy", "accuracy"))


def q_label_smoothed_loss(spark, sf_dir):
    """A4: label-smoothed (0.15) cross entropy at temperature 1.2."""
    r = M.label_smoothed_ce(_logits(spark, sf_dir), "logits", "y")
    return r.select("n_tokens", _round("loss", "loss"))


def _mlog(spark, sf_dir):
    return TL.metric_log_from_events(table(spark, sf_dir, "events"))


def q_epoch_metrics(spark, sf_dir):
    """Weight-averaged metric per run, epoch and name."""
    r = TL.epoch_metrics(_mlog(spark, sf_dir))
    return r.select("run_id", "epoch", "name", _round("value", "value"), "weight", "n_steps")


MONITOR = "view"


def q_top_checkpoints(spark, sf_dir):
    """Three best checks per run plus the last one."""
    r = TL.top_checkpoints(_mlog(spark, sf_dir), MONITOR)
    return r.select("run_id", "step", "value", F.col("rank").cast("long").alias("rank"), "is_last")


def q_early_stop(spark, sf_dir):
    """First check after two checks in a row without improvement."""
    return TL.early_stop(_mlog(spark, sf_dir), MONITOR)


def q_sample_cadence(spark, sf_dir):
    """Steps where a sample translation is drawn."""
    return TL.sample_cadence(_mlog(spark, sf_dir)).select("run_id", "step", "name")


def q_corpus_lines(spark, sf_dir):
    """Three consecutive raw source texts per line, TAB-joined, null → nan."""
    p = B.file_order_rank(_holed_pairs(spark, sf_dir), "line_no", "pos")
    return tokenizer_corpus(p, "src", 3, "pos")


def _holed_pairs(spark, sf_dir):
    """The whole pair table, and behind it rows with missing values: every seventh pair once more without
    ``src``, every eleventh once more with "NA" as ``tgt``."""
    p = conversation_pairs(spark, sf_dir)
    n = p.count()
    return (p.unionByName(p.filter("line_no % 7 = 0").withColumns({"src": F.lit(None).cast("string"), "line_no": F.col("line_no") + n}))
             .unionByName(p.filter("line_no % 11 = 0").withColumns({"tgt": F.lit("NA"), "line_no": F.col("line_no") + 2 * n})))


def q_missing_pairs(spark, sf_dir):
    """F1 + P1: rows with a missing side (null or a pandas NA string) go; renamed by position."""
    p = rename_pairs(_holed_pairs(spark, sf_dir).select(F.col("src").alias("en"), F.col("tgt").alias("fr")), "position")
    return drop_missing(p, ["src", "tgt"], na_values=True)


def q_stringified_pairs(spark, sf_dir):
    """P4 + P1 by name: null becomes the text nan."""
    p = _holed_pairs(spark, sf_dir).select("line_no", F.col("src").alias("en"), F.col("tgt").alias("fr"))
    return rename_pairs(p, "name").select("line_no", stringify_nulls("src").alias("src"))


def q_head_pairs_cut(spark, sf_dir):
    """F2 with a limit that cuts: the first 50 rows in file order."""
    return S.head_rows(conversation_pairs(spark, sf_dir), 50)


def q_head_pairs(spark, sf_dir):
    """the first max_data rows (2,007,723) in file order."""
    return S.head_rows(conversation_pairs(spark, sf_dir), MAX_ROWS)


def q_length_penalty(spark, sf_dir):
    """P14 at the step given by each target's word count."""
    p = cleaned_pairs(spark, sf_dir).select("line_no", F.size(words("tgt")).alias("step"))
    return p.select("line_no", "step", _round(A.length_penalty(F.col("step")), "lp"))


def q_top_tokens(spark, sf_dir):
    """Three best token ids per row by logit; ties to the lower id."""
    d = _logits(spark, sf_dir).select("vec_id", F.posexplode("logits").alias("token", "logit"))
    r = TL.top_k_per_group(d, ["vec_id"], [F.col("logit").desc(), F.col("token")], 3)
    return r.select("vec_id", F.col("token").cast("int").alias("token"), _round("logit", "logit"),
                    F.col("rank").cast("long").alias("rank"))


def q_row_counts(spark, sf_dir):
    """Rows and columns of the pair table."""
    p = conversation_pairs(spark, sf_dir)
    return p.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(p.columns)).cast("long"))


def q_strip_documents(spark, sf_dir):
    """P2 on whole documents: length before and after a Unicode strip."""
    d = spread(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                    F.length(strip_text("text")).cast("long").alias("n_stripped"))


def q_document_words(spark, sf_dir):
    """T5 on whole cleaned documents: word count and longest word."""
    d = spread(table(spark, sf_dir, "documents")).select("doc_id", words(clean_text_col("text")).alias("w"))
    return d.select("doc_id", F.size("w").cast("long").alias("n_words"),
                    F.coalesce(F.array_max(F.transform("w", lambda x: F.length(x))), F.lit(0))
                    .cast("long").alias("max_word_len"))


def q_token_stats(spark, sf_dir):
    """A2: per side, rows, ids, mean/max length, truncated and unk shares."""
    p = cleaned_pairs(spark, sf_dir)
    long = (p.select(F.lit("src").alias("side"), A.char_ids("src").alias("ids"))
             .unionByName(p.select(F.lit("tgt").alias("side"), A.char_ids("tgt").alias("ids"))))
    r = M.token_stats(long, "ids", ["side"], MAX_LEN)
    return r.select("side", "n_rows", "n_tokens", _round("mean_tokens", "mean_tokens"),
                    F.col("max_tokens").cast("long").alias("max_tokens"),
                    _round("truncated_share", "truncated_share"), _round("unk_share", "unk_share"))


def q_split_strata(spark, sf_dir):
    """R1 checked per stratum: exact 90 % split of documents, counted by label strata."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    sp = S.exact_split(d, TRAIN_FRAC, SEED, ["doc_id"])
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return (sp.join(lab, "doc_id")
              .groupBy("quality", "toxic")
              .agg(F.sum(F.col("is_train").cast("long")).alias("n_train"),
                   F.sum((~F.col("is_train")).cast("long")).alias("n_val")))


_CORPUS_QUERIES = {
    "split_strata": q_split_strata,
    "exact_split": q_exact_split,
    "validation_rows": q_validation_rows,
    "sample_one": q_sample_one,
    "shuffle_batches": q_shuffle_batches,
    "teacher_forcing": q_teacher_forcing,
    "teacher_forcing_standard": q_teacher_forcing_standard,
    "padded_batches": q_padded_batches,
    "collate": q_collate,
    "batch_max_len": q_batch_max_len,
    "pad_mask": q_pad_mask,
    "validation_batches": q_validation_batches,
    "ngram_stats": q_ngram_stats,
    "logit_ops": q_logit_ops,
    "token_accuracy": q_token_accuracy,
    "label_smoothed_loss": q_label_smoothed_loss,
    "epoch_metrics": q_epoch_metrics,
    "top_checkpoints": q_top_checkpoints,
    "early_stop": q_early_stop,
    "sample_cadence": q_sample_cadence,
    "corpus_lines": q_corpus_lines,
    "head_pairs": q_head_pairs,
    "head_pairs_cut": q_head_pairs_cut,
    "missing_pairs": q_missing_pairs,
    "stringified_pairs": q_stringified_pairs,
    "length_penalty": q_length_penalty,
    "top_tokens": q_top_tokens,
    "row_counts": q_row_counts,
    "strip_documents": q_strip_documents,
    "document_words": q_document_words,
    "token_stats": q_token_stats,
}


def registry():
    """All registered queries by name."""
    from .io_queries import REGISTRY as _IO
    from .model_queries import REGISTRY as _MODEL
    r = dict(_PAIR_QUERIES)
    r.update(_CORPUS_QUERIES)
    r.update(_MODEL)
    r.update(_IO)
    return r
