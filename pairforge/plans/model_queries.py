"""Registered queries for tokenization and decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import BOS_ID, MAX_LEN, SAMPLE_BEAM, SAMPLE_DIVERSITY, SAMPLE_MAX_LEN, VOCAB_SIZE
from ..functions.normalize import normalize_nmt_nfkc
from ..functions.text import clean_text
from ..operators import decoding as D
from ..operators import tokenizer as TK
from ..operators.scorer import decode_with_scorer, table_scorer
from ..operators.translate import sample_report, source_scorer, translate
from ..operators.vocab_learn import learn_vocab, seed_vocab
from ..session import scratch_path, spread_table
from ..sources.tables import table
from .tokenizer_sql import DOC_SEEDS, PAIR_SEEDS
from .queries import SEED, TRAIN_FRAC, _round, cleaned_pairs, encoded_pairs

_CACHE: dict = {}


def _cached(spark, key, build):
    """Learned tables are written once per session to the shared checkpoint folder."""
    key = (spark.sparkContext.applicationId, *key)
    path = _CACHE.get(key)
    if path is None:
        path = scratch_path(spark, "_".join(str(k).strip("/").replace("/", "_") for k in key))
        build().write.parquet(path)
        _CACHE[key] = path
    return spark.read.parquet(path)


def document_vocab(spark, sf_dir):
    """T2 over all cleaned documents (vocabulary size 16,384)."""
    def build():
        d = spread_table(table(spark, sf_dir, "documents").select("text")).select(clean_text("text").alias("text"))
        return learn_vocab(d, "text", VOCAB_SIZE)
    return _cached(spark, (sf_dir, "doc_vocab"), build)


def document_seeds(spark, sf_dir):
    """T2's first vocabulary (counted pieces, no EM) over all cleaned documents; SQL can state it."""
    def build():
        d = spread_table(table(spark, sf_dir, "documents").select("text")).select(clean_text("text").alias("text"))
        return seed_vocab(d, "text", DOC_SEEDS)
    return _cached(spark, (sf_dir, "doc_seeds"), build)


def pair_seeds(spark, sf_dir, side):
    """The same on one side of the cleaned pair table, as the training setup has it."""
    def build():
        return seed_vocab(cleaned_pairs(spark, sf_dir), side, PAIR_SEEDS)
    return _cached(spark, (sf_dir, "pair_seeds", side), build)


def q_seed_vocab(spark, sf_dir):
    """T2 seeds: pieces by count × length, characters by coverage, scores ln(share)."""
    return document_seeds(spark, sf_dir).select("id", "piece", _round("score", "score"))


def q_nmt_nfkc(spark, sf_dir):
    """T0 on whole documents: normalized length and word count."""
    d = spread_table(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", normalize_nmt_nfkc("text").alias("n"))
    return d.select("doc_id", F.length("n").cast("long").alias("n_chars"),
                    F.size(F.split("n", "▁")).cast("long").alias("n_parts"))


def q_learn_vocab(spark, sf_dir):
    """Unigram vocabulary of the cleaned documents."""
    return document_vocab(spark, sf_dir)


def _encoded_documents(spark, sf_dir):
    d = spread_table(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", clean_text("text").alias("text"))
    return TK.encode(d, "text", document_seeds(spark, sf_dir), "ids")


def q_encode_documents(spark, sf_dir):
    """Ids per whole document: their number, the unknown ones, a digest of all."""
    e = _encoded_documents(spark, sf_dir)
    return e.select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                    F.size(F.filter("ids", lambda x: x == 3)).cast("long").alias("n_unk"),
                    F.md5(F.array_join("ids", ",")).alias("ids_md5"))


def q_decode_documents(spark, sf_dir):
    """T4: the text of every document's ids (without unknown characters it is the normalized text)."""
    e = TK.decode(_encoded_documents(spark, sf_dir), "ids", document_seeds(spark, sf_dir), "back")
    return e.select("doc_id", F.length("back").cast("long").alias("n_chars"), F.md5(F.col("back").cast("binary")).alias("text_md5"),
                    (F.size(F.filter("ids", lambda x: x == 3)) > 0).alias("has_unk"))


def q_vocab_token_stats(spark, sf_dir):
    """A2 with a vocabulary: per language, rows, percentiles of the ids per document, truncated
    and unknown shares, and the share of the vocabulary in use."""
    from ..operators.metrics import token_stats
    d = spread_table(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")).select("doc_id", "lang", clean_text("text").alias("text"))
    v = document_seeds(spark, sf_dir)
    r = token_stats(TK.encode(d, "text", v, "ids"), "ids", ["lang"], MAX_LEN, v.count(), percentiles=(0.5, 0.9, 0.99))
    return r.select("lang", "n_rows", "n_tokens", _round("mean_tokens", "mean_tokens"), F.col("max_tokens").cast("long").alias("max_tokens"),
                    "p50_tokens", "p90_tokens", "p99_tokens", _round("truncated_share", "truncated_share"),
                    _round("unk_share", "unk_share"), _round("coverage", "coverage"))


def q_encode_pairs(spark, sf_dir):
    """Both sides encoded with their own vocabulary, then P5 / P6."""
    p = cleaned_pairs(spark, sf_dir)
    return TK.encode_pairs(p, pair_seeds(spark, sf_dir, "src"), pair_seeds(spark, sf_dir, "tgt"), MAX_LEN)


def char_scores(spark, sf_dir):
    """Bigram score table over code points of the cleaned documents."""
    d = spread_table(table(spark, sf_dir, "documents").select("text")).select(clean_text("text").alias("text"))
    return D.char_bigram_scores(d, "text")


def q_bigram_scores(spark, sf_dir):
    """J5 data: add-one bigram logits."""
    return char_scores(spark, sf_dir).select("prev_id", "token_id", _round("logit", "logit"))


def decode_sources(spark, sf_dir):
    """Sources with the sampling context: ``[bos] + x_tgt[:3]``."""
    e = encoded_pairs(spark, sf_dir)
    return e.select(F.col("line_no").alias("ex_id"), "x_src",
                    F.concat(F.array(F.lit(BOS_ID)), F.slice("x_tgt", 1, 3)).alias("prefix"))


def q_decode_greedy(spark, sf_dir):
    """Greedy continuation (≤ 30 tokens), each row stops at its eos."""
    r = D.decode_greedy(decode_sources(spark, sf_dir), char_scores(spark, sf_dir), SAMPLE_MAX_LEN)
    return r.select("ex_id", "tokens")


def _with_eos_successors(scores, rows):
    """Logits of what may follow eos, so that an ended row can go on (the corpus has no such pairs)."""
    spark = scores.sparkSession
    return scores.unionByName(spark.createDataFrame(rows, "prev_id int, token_id int, logit double"))


def q_decode_greedy_reference(spark, sf_dir):
    """D1, reference mode: rows go on, ended ones by what follows eos, until all emit eos in one step."""
    sc = _with_eos_successors(char_scores(spark, sf_dir), [(2, 101, -1.0), (2, 2, -2.0)])
    r = D.decode_greedy(decode_sources(spark, sf_dir), sc, SAMPLE_MAX_LEN, mode="reference")
    return r.select("ex_id", "tokens")


def q_decode_random_reference(spark, sf_dir):
    """D2, reference mode: rows go on drawing until all draw eos in one step (≤ 12 tokens)."""
    sc = _with_eos_successors(char_scores(spark, sf_dir), [(2, 2, 0.0), (2, 101, -1.0)])
    r = D.decode_random(decode_sources(spark, sf_dir), sc, 12, seed=SEED, mode="reference")
    return r.select("ex_id", "tokens")


def q_decode_strategies(spark, sf_dir):
    """D0 + D7: prefixes checked, then every strategy by its name."""
    s = D.init_prefix(decode_sources(spark, sf_dir), "x_src", "prefix")
    sc = char_scores(spark, sf_dir)
    options = {"greedy": {}, "random": {"top_n": 5, "seed": SEED}, "beam": {"beam_size": SAMPLE_BEAM, "diversity": SAMPLE_DIVERSITY}}
    parts = [D.decode(s, sc, k, max_len=SAMPLE_MAX_LEN, **o).select(F.lit(k).alias("strategy"), "ex_id", "tokens") for k, o in options.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_decode_padded(spark, sf_dir):
    """Greedy results padded to the longest of them."""
    r = D.decode(decode_sources(spark, sf_dir), char_scores(spark, sf_dir), "greedy", max_len=SAMPLE_MAX_LEN)
    return D.pad_outputs(r.select("ex_id", "tokens"))


def q_decode_beam_coarse(spark, sf_dir):
    """D4 over few kinds of token (code point modulo 7): the vocabulary bounds the candidates of a beam."""
    def coarse(x):
        return F.when(x > 2, (3 + x % 7).cast("int")).otherwise(x)
    d = spread_table(table(spark, sf_dir, "documents").select("text")).select(clean_text("text").alias("text"))
    sc = D.char_bigram_scores(d, "text", coarse)
    s = decode_sources(spark, sf_dir).withColumn("prefix", F.transform("prefix", coarse))
    size = sc.select("token_id").distinct().count()
    r = D.decode_beam(s, sc, 5, SAMPLE_BEAM, 1.0, SAMPLE_DIVERSITY, vocab_size=size)
    return r.select("ex_id", "tokens", _round("score", "score"), "done")


def q_decode_greedy_scorer(spark, sf_dir):
    """Greedy decoding with a batch scorer run by mapInPandas."""
    sc = table_scorer(char_scores(spark, sf_dir))
    r = decode_with_scorer(decode_sources(spark, sf_dir), sc, "greedy", max_len=SAMPLE_MAX_LEN)
    return r.select("ex_id", "tokens")


def q_beam_two_steps(spark, sf_dir):
    """D3 + D5 + D6 + B5: two beam rounds (beam 8, diversity 0.1)."""
    s = decode_sources(spark, sf_dir)
    sc = char_scores(spark, sf_dir)
    b = s.select("ex_id", F.lit(0).alias("beam_idx"), F.col("prefix").alias("tokens"), F.lit(0.0).alias("score"))
    for step in range(2):
        b = D.beam_step(b, sc, step, SAMPLE_BEAM, 1.0, SAMPLE_DIVERSITY)
    return b.select("ex_id", F.col("beam_idx").cast("long").alias("beam_idx"), "tokens", _round("score", "score"))


def q_decode_beam(spark, sf_dir):
    """Full beam search (beam 8, diversity 0.1, ≤ 30 tokens), best beam."""
    r = D.decode_beam(decode_sources(spark, sf_dir), char_scores(spark, sf_dir), SAMPLE_MAX_LEN,
                      SAMPLE_BEAM, 1.0, SAMPLE_DIVERSITY)
    return r.select("ex_id", "tokens", _round("score", "score"), "done")


def q_decode_random(spark, sf_dir):
    """D2 + R3: top-5 sampling at temperature 1.0, seeded."""
    r = D.decode_random(decode_sources(spark, sf_dir), char_scores(spark, sf_dir), SAMPLE_MAX_LEN,
                        top_n=5, temperature=1.0, seed=SEED)
    return r.select("ex_id", "tokens")


def document_bigrams(spark, sf_dir):
    """Bigram scores over the ids of all documents."""
    return _cached(spark, (sf_dir, "doc_bigrams"), lambda: D.bigram_scores(_encoded_documents(spark, sf_dir), "ids"))


def q_translate(spark, sf_dir):
    """Cleaned source text → ids → greedy steps from [bos], the whole source scored at every step → text."""
    v = document_seeds(spark, sf_dir)
    r = translate(cleaned_pairs(spark, sf_dir), v, v, source_scorer(document_bigrams(spark, sf_dir)), "greedy", clean=False,
                  max_len=SAMPLE_MAX_LEN)
    return r.select(F.col("line_no").alias("ex_id"), "translation")


def q_sample_report(spark, sf_dir):
    """One sampled validation row: source, context, target and translation text."""
    from ..operators.split import exact_split
    v = document_seeds(spark, sf_dir)
    p = cleaned_pairs(spark, sf_dir)
    flags = exact_split(p.select("line_no"), TRAIN_FRAC, SEED, ["line_no"])
    val = p.join(flags.filter(~F.col("is_train")).select("line_no"), "line_no")
    r = sample_report(val, v, v, source_scorer(document_bigrams(spark, sf_dir)), 7, "greedy", max_len=SAMPLE_MAX_LEN)
    return r.withColumnRenamed("line_no", "ex_id")


REGISTRY = {
    "nmt_nfkc": q_nmt_nfkc,
    "vocab_token_stats": q_vocab_token_stats,
    "learn_vocab": q_learn_vocab,
    "seed_vocab": q_seed_vocab,
    "encode_documents": q_encode_documents,
    "decode_documents": q_decode_documents,
    "encode_pairs": q_encode_pairs,
    "bigram_scores": q_bigram_scores,
    "decode_greedy": q_decode_greedy,
    "decode_greedy_reference": q_decode_greedy_reference,
    "decode_random_reference": q_decode_random_reference,
    "decode_strategies": q_decode_strategies,
    "decode_padded": q_decode_padded,
    "decode_beam_coarse": q_decode_beam_coarse,
    "decode_greedy_scorer": q_decode_greedy_scorer,
    "beam_two_steps": q_beam_two_steps,
    "decode_beam": q_decode_beam,
    "decode_random": q_decode_random,
    "translate": q_translate,
    "sample_report": q_sample_report,
}


def q_seq_token_accuracy(spark, sf_dir):
    """A3 on sequences: teacher-forced argmax predictions of the bigram table vs labels."""
    from ..operators.evaluation import teacher_forced_predictions
    from ..operators.metrics import token_accuracy
    e = encoded_pairs(spark, sf_dir).withColumnRenamed("line_no", "ex_id")
    p = teacher_forced_predictions(e, char_scores(spark, sf_dir), "x_tgt", "ex_id")
    r = token_accuracy(p, "pred", "y")
    return r.select("correct", "counted", _round("accuracy", "accuracy"))


def q_prediction_bleu(spark, sf_dir):
    """A3 + A5 + F3 + T4 + T5: training-time evaluation of a prediction table
    (vocabulary ids, bigram predictions, hypotheses masked by predicted pad)."""
    from ..operators.evaluation import evaluate_predictions, teacher_forced_predictions
    e = q_encode_pairs(spark, sf_dir).withColumnRenamed("line_no", "ex_id")
    scores = D.bigram_scores(e, "y")
    p = teacher_forced_predictions(e, scores, "x_tgt", "ex_id")
    r = evaluate_predictions(p, "pred", "y", pair_seeds(spark, sf_dir, "tgt"), "ex_id")
    return r.select("correct", "counted", _round("accuracy", "accuracy"), _round("mean_bleu", "mean_bleu"))


REGISTRY.update({
    "seq_token_accuracy": q_seq_token_accuracy,
    "prediction_bleu": q_prediction_bleu,
})


def q_decode_random_scorer(spark, sf_dir):
    """U2 + D2: top-5 sampling with the batch scorer (same draws as the table form)."""
    sc = table_scorer(char_scores(spark, sf_dir))
    r = decode_with_scorer(decode_sources(spark, sf_dir), sc, "random", max_len=SAMPLE_MAX_LEN,
                           top_n=5, temperature=1.0, seed=SEED)
    return r.select("ex_id", "tokens")


def q_decode_beam_scorer(spark, sf_dir):
    """U2 + D4: beam 8, diversity 0.1 with the batch scorer."""
    sc = table_scorer(char_scores(spark, sf_dir))
    r = decode_with_scorer(decode_sources(spark, sf_dir), sc, "beam", max_len=SAMPLE_MAX_LEN,
                           beam_size=SAMPLE_BEAM, temperature=1.0, diversity=SAMPLE_DIVERSITY)
    return r.select("ex_id", "tokens")


REGISTRY.update({
    "decode_random_scorer": q_decode_random_scorer,
    "decode_beam_scorer": q_decode_beam_scorer,
})
