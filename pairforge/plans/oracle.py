"""DuckDB oracle SQL, one statement per registered query."""

from __future__ import annotations

from ..constants import NA_STRINGS
from . import tokenizer_sql
from .sqlfrag import (CLEAN_PAIRS, EVENTS_LOG, PAIRS, WS, bleu_ctes, char_ids, clean, hash_key,
                      ngram_list, pad_to, teacher, truncate_eos, words)

_WORDS = f"""
wp AS (SELECT line_no, {words('src')} AS sw, {words('tgt')} AS tw FROM clean_pairs)"""


def _pair_sql() -> dict[str, str]:
    q = {}
    q["pairs"] = f"WITH {PAIRS} SELECT line_no, src, tgt FROM pairs"
    q["clean_pairs"] = f"WITH {CLEAN_PAIRS} SELECT line_no, src, tgt FROM clean_pairs"
    q["pair_bleu"] = (f"WITH {CLEAN_PAIRS}, {_WORDS}, {bleu_ctes('wp', 'line_no', 'sw', 'tw')} "
                      "SELECT line_no, round(bleu, 6) AS bleu, hyp_len, ref_len FROM bleu")
    q["pair_stats"] = (f"WITH {CLEAN_PAIRS}, {_WORDS}, {bleu_ctes('wp', 'line_no', 'sw', 'tw')} "
                       "SELECT CAST(floor(ref_len / 10) AS BIGINT) AS len_bucket, count(*) AS n_pairs, "
                       "round(avg(ref_len), 6) AS mean_src_words, round(avg(hyp_len), 6) AS mean_tgt_words, "
                       "round(coalesce(avg(bleu), 0.0), 6) AS mean_bleu FROM bleu GROUP BY 1")
    return q


_LI_SPLIT = f"""
li AS (SELECT l_orderkey, l_linenumber FROM lineitem),
lr AS (SELECT l_orderkey, l_linenumber,
         row_number() OVER (ORDER BY {hash_key(42, 'l_orderkey', 'l_linenumber')}, l_orderkey, l_linenumber) - 1 AS rk,
         count(*) OVER () AS n FROM li),
lsplit AS (SELECT l_orderkey, l_linenumber, rk < round_even(CAST(0.9 AS DOUBLE) * n, 0) AS is_train FROM lr)"""

_PAIR_SPLIT = CLEAN_PAIRS + f""",
pr AS (SELECT *, row_number() OVER (ORDER BY {hash_key(42, 'line_no')}, line_no) - 1 AS rk,
         count(*) OVER () AS n FROM clean_pairs),
psplit AS (SELECT line_no, src, tgt, rk < round_even(CAST(0.9 AS DOUBLE) * n, 0) AS is_train FROM pr)"""


def _enc(shift="skip"):
    x, y = teacher(char_ids("tgt"), 1024, shift)
    return CLEAN_PAIRS + f""",
enc AS (SELECT line_no, {truncate_eos(char_ids('src'), 1024)} AS x_src, {x} AS x_tgt, {y} AS y
        FROM clean_pairs)"""


_BATCHED = _enc() + f""",
bat AS (SELECT *, row_number() OVER (ORDER BY {hash_key('42:0', 'line_no')}, line_no) - 1 AS rank FROM enc),
bat2 AS (SELECT *, CAST(floor(rank / 16) AS BIGINT) AS batch_id FROM bat),
padded AS (SELECT line_no, rank, batch_id,
   {pad_to('x_src', 'max(len(x_src)) OVER (PARTITION BY batch_id)')} AS x_src,
   {pad_to('x_tgt', 'max(len(x_tgt)) OVER (PARTITION BY batch_id)')} AS x_tgt,
   {pad_to('y', 'max(len(y)) OVER (PARTITION BY batch_id)')} AS y FROM bat2)"""

_LOGITS = """
lg AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS logits, label AS y FROM embeddings),
lz AS (SELECT *, list_transform(logits, lambda x: x / 1.2) AS z FROM lg),
lz2 AS (SELECT *, list_max(z) AS zm, list_max(logits) AS lm FROM lz),
lz3 AS (SELECT *, ln(list_sum(list_transform(z, lambda x: exp(x - zm)))) + zm AS lse,
               list_sum(list_transform(logits, lambda x: exp(x - lm))) AS se FROM lz2)"""

_TOP_CHECKS = EVENTS_LOG + """,
chk AS (SELECT run_id, step, value FROM mlog WHERE name = 'view')"""


def _corpus_sql() -> dict[str, str]:
    q = {}
    q["exact_split"] = f"WITH {_LI_SPLIT} SELECT * FROM lsplit"
    q["validation_rows"] = f"WITH {_LI_SPLIT} SELECT l_orderkey, l_linenumber FROM lsplit WHERE NOT is_train"
    q["sample_one"] = (f"WITH {_PAIR_SPLIT} SELECT line_no, src, tgt FROM psplit WHERE NOT is_train "
                       f"ORDER BY {hash_key(7, 'line_no')}, line_no LIMIT 1")
    q["shuffle_batches"] = (
        f"WITH r AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY "
        f"{hash_key('42:0', 'l_orderkey', 'l_linenumber')}) - 1 AS rank FROM lineitem) "
        "SELECT l_orderkey, l_linenumber, rank, CAST(floor(rank / 16) AS BIGINT) AS batch_id FROM r")
    q["teacher_forcing"] = f"WITH {_enc()} SELECT * FROM enc"
    q["teacher_forcing_standard"] = f"WITH {_enc('standard')} SELECT * FROM enc"
    q["padded_batches"] = f"WITH {_BATCHED} SELECT * FROM padded"
    q["collate"] = (f"WITH {_BATCHED}, c AS (SELECT batch_id, list(rank ORDER BY rank) AS ranks, "
                    "list(x_src ORDER BY rank) AS x_src, list(x_tgt ORDER BY rank) AS x_tgt, "
                    "list(y ORDER BY rank) AS y FROM padded GROUP BY batch_id) SELECT * FROM c")
    q["batch_max_len"] = (f"WITH {_BATCHED} SELECT batch_id, max(len(x_src)) AS max_x_src, "
                          "max(len(x_tgt)) AS max_x_tgt, max(len(y)) AS max_y FROM bat2 GROUP BY batch_id")
    q["pad_mask"] = (f"WITH {_BATCHED} SELECT line_no, list_transform(x_src, lambda v: v <> 0) AS mask "
                     "FROM padded")
    q["validation_batches"] = (
        f"WITH {_PAIR_SPLIT}, v AS (SELECT line_no, row_number() OVER (ORDER BY line_no) - 1 AS rank "
        "FROM psplit WHERE NOT is_train) SELECT line_no, rank, CAST(floor(rank / 16) AS BIGINT) AS batch_id FROM v")
    ids = char_ids("tgt")
    allg = ("CASE WHEN len(ids) >= 3 THEN list_transform(range(1, len(ids) - 1), "
            "lambda i: ids[i:i + 2]) ELSE [] END")
    q["ngram_stats"] = (f"WITH {CLEAN_PAIRS}, e AS (SELECT line_no, {ids} AS ids FROM clean_pairs), "
                        f"g AS (SELECT line_no, {allg} AS allg FROM e) "
                        "SELECT line_no, CAST(len(list_distinct(allg)) AS BIGINT) AS n_trigrams, "
                        "len(list_distinct(allg)) < len(allg) AS has_repeat FROM g")
    q["logit_ops"] = (
        f"WITH {_LOGITS} SELECT vec_id, CAST(list_position(logits, lm) - 1 AS INTEGER) AS arg, "
        "round(1.0 / se, 6) AS p_max, round(z[y + 1] - lse, 6) AS lsm_label, "
        "CAST(len(list_filter(logits, lambda x: x < list_sort(logits, 'DESC')[5])) AS BIGINT) AS n_masked, "
        "round(zm, 6) AS max_scaled FROM lz3")
    q["token_accuracy"] = (
        f"WITH {_LOGITS}, p AS (SELECT y, list_position(logits, lm) - 1 AS pred FROM lz3) "
        "SELECT sum(CASE WHEN y <> 0 AND pred = y THEN 1 ELSE 0 END) AS correct, "
        "sum(CASE WHEN y <> 0 THEN 1 ELSE 0 END) AS counted, "
        "round(sum(CASE WHEN y <> 0 AND pred = y THEN 1 ELSE 0 END) / "
        "sum(CASE WHEN y <> 0 THEN 1 ELSE 0 END), 6) AS accuracy FROM p")
    q["label_smoothed_loss"] = (
        f"WITH {_LOGITS}, t AS (SELECT 0.85 * (lse - z[y + 1]) + 0.15 * (lse - list_sum(z) / len(z)) AS l "
        "FROM lz3 WHERE y <> 0) SELECT count(*) AS n_tokens, round(avg(l), 6) AS loss FROM t")
    q["epoch_metrics"] = (
        f"WITH {EVENTS_LOG} SELECT run_id, epoch, name, round(sum(value * weight) / sum(weight), 6) AS value, "
        "sum(weight) AS weight, count(*) AS n_steps FROM mlog GROUP BY run_id, epoch, name")
    q["top_checkpoints"] = (
        f"WITH {_TOP_CHECKS}, r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY value DESC, step) AS rk, "
        "max(step) OVER (PARTITION BY run_id) AS last_step FROM chk) "
        "SELECT run_id, step, value, CASE WHEN rk <= 3 THEN rk END AS rank, step = last_step AS is_last "
        "FROM r WHERE rk <= 3 OR step = last_step")
    q["early_stop"] = (
        f"WITH {_TOP_CHECKS}, c AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step) AS check_no, "
        "max(value) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best "
        "FROM chk), i AS (SELECT *, max(CASE WHEN prev_best IS NULL OR value > prev_best THEN check_no END) "
        "OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_best FROM c) "
        "SELECT run_id, min(CASE WHEN check_no - last_best >= 2 THEN check_no END) AS stop_check, "
        "min(CASE WHEN check_no - last_best >= 2 THEN step END) AS stop_step, max(value) AS best_value, "
        "count(*) AS n_checks FROM i GROUP BY run_id")
    q["sample_cadence"] = f"WITH {EVENTS_LOG} SELECT run_id, step, name FROM mlog WHERE step % 50 = 0"
    holed = (f"WITH {PAIRS}, np AS (SELECT count(*) AS n FROM pairs), holed AS (SELECT line_no, src, tgt FROM pairs "
             "UNION ALL SELECT line_no + n, NULL, tgt FROM pairs, np WHERE line_no % 7 = 0 "
             "UNION ALL SELECT line_no + 2 * n, src, 'NA' FROM pairs, np WHERE line_no % 11 = 0)")
    q["corpus_lines"] = (
        f"{holed}, placed AS (SELECT src, row_number() OVER (ORDER BY line_no) - 1 AS pos FROM holed) "
        "SELECT CAST(floor(pos / 3) AS BIGINT) AS group_id, "
        "string_agg(coalesce(src, 'nan'), chr(9) ORDER BY pos) AS line FROM placed GROUP BY 1")
    na = ", ".join("'" + x.replace("'", "''") + "'" for x in NA_STRINGS)
    q["missing_pairs"] = (f"{holed} SELECT src, tgt FROM holed WHERE src IS NOT NULL AND tgt IS NOT NULL "
                          f"AND src NOT IN ({na}) AND tgt NOT IN ({na})")
    q["stringified_pairs"] = f"{holed} SELECT line_no, coalesce(src, 'nan') AS src FROM holed"
    q["head_pairs_cut"] = f"WITH {PAIRS} SELECT line_no, src, tgt FROM pairs WHERE line_no < 50"
    q["head_pairs"] = f"WITH {PAIRS} SELECT line_no, src, tgt FROM pairs WHERE line_no < 2007723"
    q["length_penalty"] = (
        f"WITH {CLEAN_PAIRS}, s AS (SELECT line_no, len({words('tgt')}) AS step FROM clean_pairs) "
        "SELECT line_no, step, round(pow(6.0 + step, 0.6) / pow(6.0, 0.6), 6) AS lp FROM s")
    q["top_tokens"] = (
        "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS l FROM embeddings), "
        "x AS (SELECT vec_id, CAST(i - 1 AS INTEGER) AS token, l[i] AS logit FROM e, range(1, len(l) + 1) t(i)), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, token) AS rank FROM x) "
        "SELECT vec_id, token, round(logit, 6) AS logit, rank FROM r WHERE rank <= 3")
    q["row_counts"] = f"WITH {PAIRS} SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_cols FROM pairs"
    _ws = WS
    q["strip_documents"] = (
        "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(length(regexp_replace(text, "
        f"'^[{_ws}]+|[{_ws}]+$', '', 'g')) AS BIGINT) AS n_stripped FROM documents")
    q["document_words"] = (
        f"WITH w AS (SELECT doc_id, {words(clean('text'))} AS w FROM documents) "
        "SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, "
        "CAST(coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS max_word_len FROM w")
    q["token_stats"] = (
        f"WITH {CLEAN_PAIRS}, l AS (SELECT 'src' AS side, {char_ids('src')} AS ids FROM clean_pairs "
        f"UNION ALL SELECT 'tgt', {char_ids('tgt')} FROM clean_pairs) "
        "SELECT side, count(*) AS n_rows, sum(len(ids)) AS n_tokens, round(avg(len(ids)), 6) AS mean_tokens, "
        "CAST(max(len(ids)) AS BIGINT) AS max_tokens, round(avg(CASE WHEN len(ids) > 1024 THEN 1.0 ELSE 0.0 END), 6) "
        "AS truncated_share, round(sum(len(list_filter(ids, lambda v: v = 3))) / sum(len(ids)), 6) AS unk_share "
        "FROM l GROUP BY side")
    return q


_SCORES = f"""
cdocs AS (SELECT {char_ids(clean('text'))} AS ids FROM documents),
cseq AS (SELECT list_concat(list_concat([1], ids), [2]) AS s FROM cdocs),
cpair AS (SELECT s[i] AS prev_id, s[i + 1] AS token_id FROM cseq, range(1, len(s)) t(i)),
ccnt AS (SELECT prev_id, token_id, count(*) AS c FROM cpair GROUP BY prev_id, token_id),
cv AS (SELECT count(DISTINCT token_id) AS v FROM ccnt),
ctot AS (SELECT prev_id, sum(c) AS tc FROM ccnt GROUP BY prev_id),
scores AS (SELECT ccnt.prev_id, ccnt.token_id, ln((c + 1) / (tc + v)) AS logit
           FROM ccnt JOIN ctot ON ctot.prev_id = ccnt.prev_id, cv)"""

_SOURCES = _enc() + """,
dsrc AS (SELECT line_no AS ex_id, list_concat([1], x_tgt[1:3]) AS prefix FROM enc)"""

_GREEDY = f"""
nxt AS (SELECT prev_id, first(token_id ORDER BY logit DESC, token_id) AS next_id FROM scores GROUP BY prev_id),
walk(ex_id, step, seq, done) AS (
  SELECT ex_id, 0, prefix, false FROM dsrc
  UNION ALL
  SELECT w.ex_id, w.step + 1, list_append(w.seq, coalesce(n.next_id, 2)), coalesce(n.next_id, 2) = 2
  FROM walk w LEFT JOIN nxt n ON n.prev_id = w.seq[-1]
  WHERE NOT w.done AND w.step < 30),
greedy AS (SELECT ex_id, arg_max(seq, step) AS tokens, arg_max(seq, step)[len(any_value(seq)):] AS x
           FROM walk GROUP BY ex_id)"""


def _beam_round(prev: str, step: int, name: str, k: int = 16, table: str = "scores") -> str:
    lp = f"(pow(6.0 + {step}, 0.6) / pow(6.0, 0.6))"
    live = f"{prev}" if step == 0 else f"(SELECT * FROM {prev} WHERE tokens[-1] <> 2)"
    div = ""
    zexpr = "b.logit"
    if step > 0:
        div = f"""
{name}_occ AS (SELECT ex_id, beam_idx, unnest(tokens) AS token_id FROM {prev}),
{name}_tot AS (SELECT ex_id, token_id, count(*) AS n_all FROM {name}_occ GROUP BY ex_id, token_id),
{name}_own AS (SELECT ex_id, beam_idx, token_id, count(*) AS n_own FROM {name}_occ GROUP BY ex_id, beam_idx, token_id),"""
        zexpr = "b.logit - 0.1 * (coalesce(t.n_all, 0) - coalesce(o.n_own, 0))"
    joins = "" if step == 0 else (
        f" LEFT JOIN {name}_tot t ON t.ex_id = b.ex_id AND t.token_id = b.token_id"
        f" LEFT JOIN {name}_own o ON o.ex_id = b.ex_id AND o.beam_idx = b.beam_idx AND o.token_id = b.token_id")
    rep = ("1.0" if step == 0 else
           f"(CASE WHEN len(list_intersect({ngram_list('nt')}, {ngram_list('tokens')})) > 0 THEN 0.5 ELSE 1.0 END)")
    carried = "" if step == 0 else (
        f" UNION ALL SELECT ex_id, beam_idx AS parent, 0 AS cand, tokens, score FROM {prev} WHERE tokens[-1] = 2")
    return f"""{div}
{name}_s AS (SELECT b.*, coalesce(s.token_id, 2) AS token_id, coalesce(s.logit, 0.0) AS logit
             FROM {live} b LEFT JOIN {table} s ON s.prev_id = b.tokens[-1]),
{name}_c AS (SELECT b.ex_id, b.beam_idx AS parent, b.token_id, {zexpr} AS z, b.score, b.tokens
             FROM {name}_s b{joins}),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY ex_id, parent ORDER BY z DESC, token_id) AS cand
             FROM {name}_c),
{name}_k AS (SELECT ex_id, parent, cand, tokens, list_append(tokens, token_id) AS nt, score, z
             FROM {name}_r WHERE cand <= {k}),
{name}_u AS (SELECT ex_id, parent, cand, nt AS tokens, (score + z) / {lp} * {rep} AS score FROM {name}_k{carried}),
{name} AS (SELECT ex_id, row_number() OVER (PARTITION BY ex_id ORDER BY score DESC, parent, cand) - 1 AS beam_idx,
              tokens, score FROM {name}_u QUALIFY beam_idx < 8)"""


def _decoding_sql() -> dict[str, str]:
    q = {}
    q["bigram_scores"] = f"WITH {_SCORES} SELECT prev_id, token_id, round(logit, 6) AS logit FROM scores"
    q["decode_greedy"] = f"WITH RECURSIVE {_SCORES}, {_SOURCES}, {_GREEDY} SELECT ex_id, tokens FROM greedy"
    q["decode_greedy_scorer"] = q["decode_greedy"]
    q["decode_greedy_reference"] = f"""WITH RECURSIVE {_SCORES}, {_SOURCES},
ended AS (SELECT prev_id, token_id, logit FROM scores UNION ALL SELECT 2, 101, -1.0 UNION ALL SELECT 2, 2, -2.0),
nxt AS (SELECT prev_id, first(token_id ORDER BY logit DESC, token_id) AS next_id FROM ended GROUP BY prev_id),
walk(ex_id, step, seq, nx) AS (
  SELECT ex_id, 0, prefix, 0 FROM dsrc
  UNION ALL
  SELECT w.ex_id, w.step + 1, list_append(w.seq, coalesce(n.next_id, 2)), coalesce(n.next_id, 2)
  FROM walk w LEFT JOIN nxt n ON n.prev_id = w.seq[-1] WHERE w.step < 30),
stop AS (SELECT coalesce((SELECT min(step) FROM (SELECT step FROM walk WHERE step > 0 GROUP BY step HAVING min(CASE WHEN nx = 2 THEN 1 ELSE 0 END) = 1)), 30) AS s)
SELECT ex_id, seq AS tokens FROM walk, stop WHERE step = s"""
    q["decode_random"] = f"""WITH RECURSIVE {_SCORES}, {_SOURCES},
top AS (SELECT prev_id, token_id, logit FROM scores QUALIFY rank() OVER (PARTITION BY prev_id ORDER BY logit DESC) <= 5),
wt AS (SELECT prev_id, token_id, logit, exp(logit - max(logit) OVER (PARTITION BY prev_id)) AS w FROM top),
cum AS (SELECT prev_id, token_id, sum(w) OVER (PARTITION BY prev_id ORDER BY logit DESC, token_id ROWS UNBOUNDED PRECEDING) AS c FROM wt),
cl AS (SELECT prev_id, list({{'c': c, 't': token_id}} ORDER BY c, token_id) AS cand, max(c) AS total FROM cum GROUP BY prev_id),
rnd(ex_id, step, seq, done) AS (
  SELECT ex_id, 0, prefix, false FROM dsrc
  UNION ALL
  SELECT ex_id, step + 1, list_append(seq, nx), nx = 2 FROM (
    SELECT w.ex_id, w.step, w.seq, coalesce(list_filter(c.cand, lambda x: x.c >
        (CAST('0x' || substr(md5('42:' || w.ex_id || ':' || w.step), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 * c.total)[1].t, 2) AS nx
    FROM rnd w LEFT JOIN cl c ON c.prev_id = w.seq[-1] WHERE NOT w.done AND w.step < 30))
SELECT ex_id, seq AS tokens FROM rnd WHERE done OR step = 30"""
    q["decode_random_scorer"] = q["decode_random"]
    init = "b0 AS (SELECT ex_id, 0 AS beam_idx, prefix AS tokens, 0.0 AS score FROM dsrc)"
    q["beam_two_steps"] = (
        f"WITH {_SCORES}, {_SOURCES}, {init}, {_beam_round('b0', 0, 'b1')}, {_beam_round('b1', 1, 'b2')} "
        "SELECT ex_id, beam_idx, tokens, round(score, 6) AS score FROM b2")
    # 29 rounds; a finished beam is carried, so later rounds change nothing once all have ended
    rounds = ", ".join(_beam_round(f"b{k}", k, f"b{k + 1}") for k in range(29))
    text = f"WITH {_SCORES}, {_SOURCES}, {init}, {rounds} ".replace(" AS (", " AS MATERIALIZED (")
    best = "FROM b29 WHERE beam_idx = 0"
    q["decode_beam"] = f"{text} SELECT ex_id, tokens, round(score, 6) AS score, tokens[-1] = 2 AS done {best}"
    q["decode_beam_scorer"] = f"{text} SELECT ex_id, tokens {best}"
    q["decode_padded"] = (f"WITH RECURSIVE {_SCORES}, {_SOURCES}, {_GREEDY}, m AS (SELECT max(len(tokens)) AS w FROM greedy) "
                          f"SELECT ex_id, {pad_to('tokens', 'w')} AS tokens FROM greedy, m")
    q["decode_strategies"] = (f"SELECT 'greedy' AS strategy, ex_id, tokens FROM ({q['decode_greedy']}) UNION ALL "
                              f"SELECT 'random', ex_id, tokens FROM ({q['decode_random']}) UNION ALL SELECT 'beam', ex_id, tokens FROM ({q['decode_beam_scorer']})")
    # seven kinds of token: the vocabulary is smaller than twice the beam
    coarse = _SCORES.replace(f"{char_ids(clean('text'))} AS ids", f"list_transform({char_ids(clean('text'))}, lambda x: CAST(3 + x % 7 AS INTEGER)) AS ids")
    csrc = _SOURCES.replace("x_tgt[1:3]", "list_transform(x_tgt[1:3], lambda x: CASE WHEN x > 2 THEN CAST(3 + x % 7 AS INTEGER) ELSE x END)")
    few = ", ".join(_beam_round(f"b{k}", k, f"b{k + 1}", 7) for k in range(4))
    q["decode_beam_coarse"] = f"WITH {coarse}, {csrc}, {init}, {few} SELECT ex_id, tokens, round(score, 6) AS score, tokens[-1] = 2 AS done FROM b4 WHERE beam_idx = 0"
    q["decode_random_reference"] = f"""WITH RECURSIVE {_SCORES}, {_SOURCES},
ended AS (SELECT prev_id, token_id, logit FROM scores UNION ALL SELECT 2, 2, 0.0 UNION ALL SELECT 2, 101, -1.0),
wt AS (SELECT prev_id, token_id, logit, exp(logit - max(logit) OVER (PARTITION BY prev_id)) AS w FROM ended),
cum AS (SELECT prev_id, token_id, sum(w) OVER (PARTITION BY prev_id ORDER BY logit DESC, token_id ROWS UNBOUNDED PRECEDING) AS c FROM wt),
cl AS (SELECT prev_id, list({{'c': c, 't': token_id}} ORDER BY c, token_id) AS cand, max(c) AS total FROM cum GROUP BY prev_id),
rnd(ex_id, step, seq, nx) AS (
  SELECT ex_id, 0, prefix, 0 FROM dsrc
  UNION ALL
  SELECT ex_id, step + 1, list_append(seq, nx), nx FROM (
    SELECT w.ex_id, w.step, w.seq, coalesce(list_filter(c.cand, lambda x: x.c >
        (CAST('0x' || substr(md5('42:' || w.ex_id || ':' || w.step), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 * c.total)[1].t, 2) AS nx
    FROM rnd w LEFT JOIN cl c ON c.prev_id = w.seq[-1] WHERE w.step < 12)),
stop AS (SELECT coalesce((SELECT min(step) FROM (SELECT step FROM rnd WHERE step > 0 GROUP BY step HAVING min(CASE WHEN nx = 2 THEN 1 ELSE 0 END) = 1)), 12) AS s)
SELECT ex_id, seq AS tokens FROM rnd, stop WHERE step = s"""
    return q


def _flat_strip(x: str) -> str:
    flat = f"regexp_replace({x}, '\\r\\n|\\r|\\n', ' ', 'g')"
    return f"regexp_replace({flat}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def _na(x: str) -> str:
    lits = ", ".join("'" + s.replace("'", "''") + "'" for s in NA_STRINGS)
    return f"CASE WHEN {x} IN ({lits}) THEN NULL ELSE {x} END"


def _io_sql() -> dict[str, str]:
    q = {}
    aligned = f"WITH {PAIRS}, al AS (SELECT line_no, {_flat_strip('src')} AS src, {_flat_strip('tgt')} AS tgt FROM pairs)"
    q["aligned_text"] = f"{aligned} SELECT * FROM al"
    q["pairs_csv_roundtrip"] = f"{aligned} SELECT line_no, {_na('src')} AS src, {_na('tgt')} AS tgt FROM al"
    q["pairs_csv_raw"] = f"WITH {PAIRS} SELECT line_no, {_na('src')} AS src, {_na('tgt')} AS tgt FROM pairs"
    q["ensure_pairs"] = f"WITH {PAIRS} SELECT line_no, src, tgt FROM pairs"
    q["preview"] = f"WITH {PAIRS} SELECT line_no, src, tgt FROM pairs ORDER BY line_no LIMIT 5"
    q["stream_epoch_metrics"] = _corpus_sql()["epoch_metrics"]
    return q


def _evaluation_sql() -> dict[str, str]:
    q = {}
    q["split_strata"] = (
        f"WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {hash_key(42, 'doc_id')}, doc_id) - 1 AS rk, "
        "count(*) OVER () AS n FROM documents), s AS (SELECT doc_id, rk < round_even(CAST(0.9 AS DOUBLE) * n, 0) "
        "AS is_train FROM r) SELECT l.quality, l.toxic, sum(CASE WHEN is_train THEN 1 ELSE 0 END) AS n_train, "
        "sum(CASE WHEN is_train THEN 0 ELSE 1 END) AS n_val FROM s JOIN labels l ON l.doc_id = s.doc_id "
        "GROUP BY l.quality, l.toxic")
    q["seq_token_accuracy"] = (
        f"WITH {_SCORES}, {_enc()}, "
        "nxt AS (SELECT prev_id, first(token_id ORDER BY logit DESC, token_id) AS next_id FROM scores GROUP BY prev_id), "
        "px AS (SELECT line_no, i, x_tgt[i] AS t FROM enc, range(1, len(x_tgt) + 1) r(i)), "
        "pp AS (SELECT px.line_no, px.i, coalesce(n.next_id, 2) AS p FROM px LEFT JOIN nxt n ON n.prev_id = px.t), "
        "cmp AS (SELECT pp.p, e.y[pp.i] AS yy FROM pp JOIN enc e ON e.line_no = pp.line_no) "
        "SELECT sum(CASE WHEN yy <> 0 AND p = yy THEN 1 ELSE 0 END) AS correct, "
        "sum(CASE WHEN yy <> 0 THEN 1 ELSE 0 END) AS counted, "
        "round(sum(CASE WHEN yy <> 0 AND p = yy THEN 1 ELSE 0 END) / sum(CASE WHEN yy <> 0 THEN 1 ELSE 0 END), 6) "
        "AS accuracy FROM cmp")
    return q


def registry() -> dict[str, str]:
    """All oracle statements by query name."""
    q = {}
    for part in (_pair_sql, _corpus_sql, _decoding_sql, _io_sql, _evaluation_sql, tokenizer_sql.registry):
        q.update(part())
    return q
