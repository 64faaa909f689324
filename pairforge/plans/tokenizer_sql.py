"""DuckDB statements of the tokenizer queries: seed vocabulary, best paths, decoding, translation.

The vocabulary is counted in SQL (pieces by count × length, characters by coverage);
the best path of a word is found by a recursion over its end positions."""

from __future__ import annotations

from .sqlfrag import CLEAN_PAIRS, bleu_ctes, clean, hash_key, teacher, truncate_eos, words

#: fixed values shared with the queries
DOC_SEEDS, PAIR_SEEDS = 4000, 2000
COVERAGE, UNK_GAP = 0.9995, 10.0

_PATTERN = "▁[^▁0-9]*|[0-9]|[^▁0-9]+"
_BLANK = "[ \\t\\n\\f\\r\\x{00A0}]+"


def _norm(x: str) -> str:
    s = f"trim(regexp_replace({x}, '{_BLANK}', ' ', 'g'), ' ')"
    return f"CASE WHEN {s} = '' THEN '' ELSE '▁' || replace({s}, ' ', '▁') END"


def vocabulary(name: str, texts: str, seeds: int) -> str:
    """CTEs ending in ``{name}(id, piece, score)`` from ``SELECT t`` texts, control pieces included, and ``{name}_unk``."""
    return f"""
{name}_w AS (SELECT word, count(*) AS f FROM (SELECT unnest(regexp_extract_all({_norm('t')}, '{_PATTERN}')) AS word FROM ({texts})) GROUP BY word),
{name}_s AS (SELECT substr(word, i, l) AS piece, sum(f) AS n FROM (SELECT word, f, unnest(range(1, length(word))) AS i FROM {name}_w), range(2, 17) r(l)
             WHERE i + l - 1 <= length(word) GROUP BY piece HAVING sum(f) >= 2),
{name}_t AS (SELECT piece, n FROM {name}_s ORDER BY n * length(piece) DESC, piece LIMIT {seeds}),
{name}_c AS (SELECT ch AS piece, sum(f) AS n FROM (SELECT unnest(string_split(word, '')) AS ch, f FROM {name}_w) WHERE ch <> '' GROUP BY ch),
{name}_r AS (SELECT piece, n FROM (SELECT piece, n, sum(n) OVER (ORDER BY n DESC, piece) - n AS before, sum(n) OVER () AS total FROM {name}_c)
             WHERE before / total < {COVERAGE}),
{name}_p AS (SELECT piece, n FROM {name}_t UNION ALL SELECT piece, n FROM {name}_r),
{name}_n AS (SELECT piece, ln(n / sum(n) OVER ()) AS score FROM {name}_p),
{name} AS MATERIALIZED (SELECT CAST(3 + row_number() OVER (ORDER BY score DESC, piece) AS INTEGER) AS id, piece, score FROM {name}_n
           UNION ALL SELECT id, piece, 0.0 FROM (VALUES (0, '<pad>'), (1, '<s>'), (2, '</s>'), (3, '<unk>')) x(id, piece)),
{name}_unk AS (SELECT min(score) - {UNK_GAP} AS score FROM {name} WHERE id > 3)"""


def encoded(name: str, texts: str, vocab: str) -> str:
    """CTEs ending in ``{name}(key, ids)`` for ``SELECT key, t`` texts.  The recursion needs WITH RECURSIVE."""
    return f"""
{name}_n AS (SELECT key, regexp_extract_all({_norm('t')}, '{_PATTERN}') AS ws FROM ({texts})),
{name}_o AS MATERIALIZED (SELECT key, ws[k] AS word, k FROM (SELECT key, ws, unnest(range(1, len(ws) + 1)) AS k FROM {name}_n)),
{name}_d AS MATERIALIZED (SELECT DISTINCT word FROM {name}_o),
{name}_i AS (SELECT word, unnest(range(length(word))) AS i FROM {name}_d),
{name}_u AS (SELECT word, i, l, substr(word, i + 1, l) AS piece FROM (SELECT word, i, unnest(range(1, least(16, length(word) - i) + 1)) AS l FROM {name}_i)),
{name}_k AS MATERIALIZED (SELECT id, piece, score FROM {vocab} WHERE id > 3),
{name}_e AS (SELECT u.word, u.i, u.i + u.l AS j, v.id, v.score FROM {name}_u u JOIN {name}_k v ON v.piece = u.piece
             UNION ALL
             SELECT x.word, x.i, x.i + 1, 3, s.score FROM (SELECT * FROM {name}_u u ANTI JOIN {name}_k v ON v.piece = u.piece WHERE u.l = 1) x, {vocab}_unk s),
{name}_j AS (SELECT word, j, list({{'i': i, 'id': id, 's': score}}) AS es FROM {name}_e GROUP BY word, j),
{name}_l AS MATERIALIZED (SELECT word, list(es ORDER BY j) AS ends FROM {name}_j GROUP BY word),
{name}_v(word, ends, j, b, p) AS (
  SELECT word, ends, 0, [0.0::DOUBLE], [''] FROM {name}_l
  UNION ALL
  SELECT word, ends, j + 1, list_append(b, -best.s), list_append(p, p[best.i + 1] || best.id || ',') FROM (
    SELECT word, ends, j, b, p, list_sort(list_transform(ends[j + 1], lambda e: {{'s': -(b[e.i + 1] + e.s), 'i': e.i, 'id': e.id}}))[1] AS best
    FROM {name}_v WHERE j < len(ends))),
{name}_b AS MATERIALIZED (SELECT word, p[len(ends) + 1] AS path FROM {name}_v WHERE j = len(ends)),
{name}_g AS (SELECT o.key, regexp_replace(string_agg(b.path, '' ORDER BY o.k), '(^|,)3,(?:3,)+', '\\13,', 'g') AS path
             FROM {name}_o o JOIN {name}_b b ON b.word = o.word GROUP BY o.key),
{name} AS MATERIALIZED (SELECT n.key, CASE WHEN g.path IS NULL THEN []::INTEGER[]
                  ELSE list_transform(string_split(rtrim(g.path, ','), ','), lambda x: CAST(x AS INTEGER)) END AS ids
           FROM {name}_n n LEFT JOIN {name}_g g ON g.key = n.key)"""


def decoded(name: str, ids: str, vocab: str) -> str:
    """CTEs ending in ``{name}(key, t)`` for ``SELECT key, ids``."""
    return f"""
{name}_q AS (SELECT key, ids FROM ({ids})),
{name}_x AS (SELECT key, k, ids[k] AS id FROM (SELECT key, ids, unnest(range(1, len(ids) + 1)) AS k FROM {name}_q)),
{name}_y AS (SELECT x.key, string_agg(CASE WHEN x.id = 3 THEN ' ⁇ ' WHEN x.id < 3 THEN '' ELSE v.piece END, '' ORDER BY x.k) AS s
             FROM {name}_x x JOIN {vocab} v ON v.id = x.id GROUP BY x.key),
{name} AS (SELECT q.key, replace(regexp_replace(coalesce(y.s, ''), '^▁', ''), '▁', ' ') AS t FROM {name}_q q LEFT JOIN {name}_y y ON y.key = q.key)"""


def scores(name: str, ids: str) -> str:
    """CTEs ending in ``{name}(prev_id, token_id, logit)``: add-one bigrams of ``SELECT ids``."""
    return f"""
{name}_s AS (SELECT list_concat(list_concat([1], ids), [2]) AS s FROM ({ids})),
{name}_p AS (SELECT s[i] AS prev_id, s[i + 1] AS token_id FROM (SELECT s, unnest(range(1, len(s))) AS i FROM {name}_s)),
{name}_c AS (SELECT prev_id, token_id, count(*) AS c FROM {name}_p GROUP BY prev_id, token_id),
{name}_v AS (SELECT count(DISTINCT token_id) AS v FROM {name}_c),
{name}_t AS (SELECT prev_id, sum(c) AS tc FROM {name}_c GROUP BY prev_id),
{name} AS MATERIALIZED (SELECT c.prev_id, c.token_id, ln((c.c + 1) / (t.tc + v.v)) AS logit FROM {name}_c c JOIN {name}_t t ON t.prev_id = c.prev_id, {name}_v v)"""


def greedy_from_source(name: str, sources: str, table: str, steps: int) -> str:
    """CTEs ending in ``{name}(key, ids)``: greedy steps for ``SELECT key, src, prefix``; a token that the source
    holds and the prefix doesn't gets one more."""
    return f"""
{name}_l AS MATERIALIZED (SELECT prev_id, list({{'t': token_id, 'z': logit}}) AS succ FROM {table} GROUP BY prev_id),
{name}_w(key, src, seq, step, done) AS (
  SELECT key, src, prefix, 0, false FROM ({sources})
  UNION ALL
  SELECT key, src, list_append(seq, nx), step + 1, nx = 2 FROM (
    SELECT w.key, w.src, w.seq, w.step, coalesce(list_sort(list_transform(l.succ, lambda x: {{
      'z': -(x.z + CASE WHEN x.t <> 2 AND list_contains(w.src, x.t) AND NOT list_contains(w.seq, x.t) THEN 1.0 ELSE 0.0 END), 't': x.t}}))[1].t, 2) AS nx
    FROM {name}_w w LEFT JOIN {name}_l l ON l.prev_id = w.seq[-1] WHERE NOT w.done AND w.step < {steps})),
{name} AS (SELECT key, seq AS ids FROM {name}_w WHERE done OR step = {steps})"""


_DOCS = f"SELECT {clean('text')} AS t FROM documents"
_KEYED = f"SELECT doc_id AS key, {clean('text')} AS t FROM documents"
_VOC = vocabulary("voc", _DOCS, DOC_SEEDS)
_ENC = f"{_VOC}, {encoded('enc', _KEYED, 'voc')}"


def _pair_encoding(shift: str = "skip") -> str:
    x, y = teacher("t.ids", 1024, shift)
    return f"""{CLEAN_PAIRS}, {vocabulary('sv', 'SELECT src AS t FROM clean_pairs', PAIR_SEEDS)}, {vocabulary('tv', 'SELECT tgt AS t FROM clean_pairs', PAIR_SEEDS)},
{encoded('es', 'SELECT line_no AS key, src AS t FROM clean_pairs', 'sv')}, {encoded('et', 'SELECT line_no AS key, tgt AS t FROM clean_pairs', 'tv')},
pe AS (SELECT s.key AS line_no, {truncate_eos('s.ids', 1024)} AS x_src, {x} AS x_tgt, {y} AS y FROM es s JOIN et t ON t.key = s.key)"""


def registry() -> dict[str, str]:
    q = {}
    q["seed_vocab"] = f"WITH {_VOC} SELECT id, piece, round(score, 6) AS score FROM voc"
    q["vocab_roundtrip"] = q["seed_vocab"]
    q["encode_documents"] = (f"WITH RECURSIVE {_ENC} SELECT key AS doc_id, CAST(len(ids) AS BIGINT) AS n_ids, "
                             "CAST(len(list_filter(ids, lambda x: x = 3)) AS BIGINT) AS n_unk, md5(array_to_string(ids, ',')) AS ids_md5 FROM enc")
    q["stream_encode"] = f"WITH RECURSIVE {_ENC} SELECT key AS doc_id, CAST(len(ids) AS BIGINT) AS n_ids, md5(array_to_string(ids, ',')) AS ids_md5 FROM enc"
    q["decode_documents"] = (f"WITH RECURSIVE {_ENC}, {decoded('back', 'SELECT key, ids FROM enc', 'voc')} "
                             f"SELECT b.key AS doc_id, CAST(length(b.t) AS BIGINT) AS n_chars, md5(b.t) AS text_md5, "
                             "len(list_filter(e.ids, lambda x: x = 3)) > 0 AS has_unk FROM back b JOIN enc e ON e.key = b.key")
    q["vocab_token_stats"] = (
        f"WITH RECURSIVE {_ENC}, l AS (SELECT d.lang, e.ids, len(e.ids) AS n FROM documents d JOIN enc e ON e.key = d.doc_id), "
        "u AS (SELECT lang, count(DISTINCT id) AS used FROM (SELECT lang, unnest(ids) AS id FROM l) GROUP BY lang), "
        "v AS (SELECT count(*) AS size FROM voc) "
        "SELECT l.lang, count(*) AS n_rows, sum(n)::BIGINT AS n_tokens, round(avg(n), 6) AS mean_tokens, max(n)::BIGINT AS max_tokens, "
        "quantile_disc(n, 0.5)::BIGINT AS p50_tokens, quantile_disc(n, 0.9)::BIGINT AS p90_tokens, quantile_disc(n, 0.99)::BIGINT AS p99_tokens, "
        "round(avg(CASE WHEN n > 1024 THEN 1.0 ELSE 0.0 END), 6) AS truncated_share, "
        "round(sum(len(list_filter(ids, lambda x: x = 3))) / sum(n), 6) AS unk_share, round(any_value(u.used) / any_value(v.size), 6) AS coverage "
        "FROM l JOIN u ON u.lang = l.lang, v GROUP BY l.lang")
    q["encode_pairs"] = f"WITH RECURSIVE {_pair_encoding()} SELECT line_no, x_src, x_tgt, y FROM pe"
    q["prediction_bleu"] = f"""WITH RECURSIVE {_pair_encoding()}, {scores('bg', 'SELECT y AS ids FROM pe')},
nxt AS (SELECT prev_id, first(token_id ORDER BY logit DESC, token_id) AS next_id FROM bg GROUP BY prev_id),
px AS (SELECT line_no, i, x_tgt[i] AS t, y[i] AS yy FROM (SELECT line_no, x_tgt, y, unnest(range(1, len(x_tgt) + 1)) AS i FROM pe)),
pp AS (SELECT px.line_no, px.i, px.yy, coalesce(n.next_id, 2) AS p FROM px LEFT JOIN nxt n ON n.prev_id = px.t),
acc AS (SELECT sum(CASE WHEN yy <> 0 AND p = yy THEN 1 ELSE 0 END) AS correct, sum(CASE WHEN yy <> 0 THEN 1 ELSE 0 END) AS counted FROM pp),
pl AS (SELECT line_no AS key, list(p ORDER BY i) FILTER (p <> 0) AS ids FROM pp GROUP BY line_no),
{decoded('hyp', 'SELECT pe.line_no AS key, coalesce(pl.ids, []::INTEGER[]) AS ids FROM pe LEFT JOIN pl ON pl.key = pe.line_no', 'tv')},
{decoded('lab', 'SELECT line_no AS key, list_filter(y, lambda v: v <> 0) AS ids FROM pe', 'tv')},
hr AS (SELECT h.key AS line_no, {words('h.t')} AS hw, {words('l.t')} AS rw FROM hyp h JOIN lab l ON l.key = h.key),
{bleu_ctes('hr', 'line_no', 'rw', 'hw')}
SELECT any_value(correct) AS correct, any_value(counted) AS counted, round(any_value(correct / counted), 6) AS accuracy,
       round(avg(bleu), 6) AS mean_bleu FROM bleu, acc"""
    q["translate"] = f"""WITH RECURSIVE {CLEAN_PAIRS}, {_ENC}, {scores('bg', 'SELECT ids FROM enc')},
{encoded('es', 'SELECT line_no AS key, src AS t FROM clean_pairs', 'voc')},
{greedy_from_source('gr', 'SELECT key, ids AS src, [1] AS prefix FROM es', 'bg', 30)},
{decoded('out', 'SELECT key, ids FROM gr', 'voc')} SELECT key AS ex_id, t AS translation FROM out"""
    x, y = teacher("t.ids", 1024)
    q["sample_report"] = f"""WITH RECURSIVE {CLEAN_PAIRS}, {_ENC}, {scores('bg', 'SELECT ids FROM enc')},
sp AS (SELECT line_no, row_number() OVER (ORDER BY {hash_key(42, 'line_no')}, line_no) - 1 AS rk, count(*) OVER () AS n FROM clean_pairs),
one AS (SELECT p.line_no, p.src, p.tgt FROM sp JOIN clean_pairs p ON p.line_no = sp.line_no WHERE rk >= round_even(CAST(0.9 AS DOUBLE) * n, 0)
        ORDER BY {hash_key(7, 'p.line_no')}, p.line_no LIMIT 1),
{encoded('es', 'SELECT line_no AS key, src AS t FROM one', 'voc')}, {encoded('et', 'SELECT line_no AS key, tgt AS t FROM one', 'voc')},
row1 AS (SELECT s.key, {truncate_eos('s.ids', 1024)} AS x_src, {x} AS x_tgt, {y} AS y FROM es s JOIN et t ON t.key = s.key),
{greedy_from_source('gr', 'SELECT key, x_src AS src, list_concat([1], x_tgt[1:3]) AS prefix FROM row1', 'bg', 30)},
{decoded('d1', 'SELECT key, x_src AS ids FROM row1', 'voc')}, {decoded('d2', 'SELECT key, x_tgt AS ids FROM row1', 'voc')},
{decoded('d3', 'SELECT key, y AS ids FROM row1', 'voc')}, {decoded('d4', 'SELECT key, ids FROM gr', 'voc')}
SELECT d1.key AS ex_id, d1.t AS source, d2.t AS context, d3.t AS target, d4.t AS translation
FROM d1 JOIN d2 ON d2.key = d1.key JOIN d3 ON d3.key = d1.key JOIN d4 ON d4.key = d1.key"""
    return q
