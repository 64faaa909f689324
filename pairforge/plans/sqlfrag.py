"""DuckDB SQL fragments used by the oracle queries.

They restate the Spark expressions of this package in plain SQL so that
the driver can compare results on the same parquet tables.
"""

from __future__ import annotations

from ..constants import WS  # noqa: F401


def clean(x: str) -> str:
    c = f"regexp_replace(lower({x}), '^[{WS}]+|[{WS}]+$', '', 'g')"
    c = f"regexp_replace({c}, '[^\\p{{L}}\\p{{N}}_''{WS}]', ' ', 'g')"
    return f"regexp_replace({c}, '[.{WS}]{{2,}}', ' ', 'g')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{WS}]+'), lambda w: w <> '')"


def char_ids(x: str) -> str:
    return (f"CASE WHEN length({x}) = 0 THEN []::INTEGER[] ELSE "
            f"list_transform(string_split({x}, ''), lambda ch: CAST(unicode(ch) AS INTEGER)) END")


PAIRS = """
pairs_raw AS (
  SELECT u.conv_id, u.turn, u.text AS src, a.text AS tgt
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'),
pairs AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS line_no, src, tgt, conv_id, turn
  FROM pairs_raw)"""

CLEAN_PAIRS = PAIRS + f""",
clean_pairs AS (
  SELECT line_no, {clean('src')} AS src, {clean('tgt')} AS tgt
  FROM pairs WHERE src IS NOT NULL AND tgt IS NOT NULL)"""


def grams(tokens: str, n: int) -> str:
    return (f"CASE WHEN len({tokens}) >= {n} THEN list_transform(range(1, len({tokens}) - {n} + 2), "
            f"lambda i: array_to_string({tokens}[i:i + {n - 1}], ' ')) ELSE []::VARCHAR[] END")


def bleu_ctes(src_cte: str, key: str, ref: str, hyp: str, max_n: int = 2, eps: float = 0.1,
              name: str = "bleu") -> str:
    """CTEs ending in ``{name}({key}, bleu, hyp_len, ref_len)``."""
    unions = []
    for n in range(1, max_n + 1):
        unions.append(f"SELECT {key}, {n} AS n, unnest({grams(hyp, n)}) AS g, 1 AS side FROM {src_cte}")
        unions.append(f"SELECT {key}, {n} AS n, unnest({grams(ref, n)}) AS g, 2 AS side FROM {src_cte}")
    m_cols = ", ".join(f"sum(CASE WHEN n = {n} THEN least(ch, cr) ELSE 0 END) AS m{n}"
                       for n in range(1, max_n + 1))
    logp = " + ".join(
        f"ln(CASE WHEN coalesce(m{n}, 0) = 0 THEN {eps} / greatest(1.0, lh - {n} + 1) "
        f"ELSE m{n} / greatest(1.0, lh - {n} + 1) END) / {max_n}" for n in range(1, max_n + 1))
    return f"""
{name}_g AS ({' UNION ALL '.join(unions)}),
{name}_pg AS (SELECT {key}, n, g, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS ch,
                 sum(CASE WHEN side = 2 THEN 1 ELSE 0 END) AS cr FROM {name}_g GROUP BY {key}, n, g),
{name}_pr AS (SELECT {key}, {m_cols} FROM {name}_pg GROUP BY {key}),
{name}_j AS (SELECT s.{key}, CAST(len({hyp}) AS DOUBLE) AS lh, CAST(len({ref}) AS DOUBLE) AS lr,
                 {', '.join(f'coalesce(pr.m{n}, 0) AS m{n}' for n in range(1, max_n + 1))}
             FROM {src_cte} s LEFT JOIN {name}_pr pr ON pr.{key} = s.{key}),
{name} AS (SELECT {key}, CAST(lh AS BIGINT) AS hyp_len, CAST(lr AS BIGINT) AS ref_len,
  CASE WHEN m1 = 0 THEN 0.0 ELSE
    (CASE WHEN lh > lr THEN 1.0 WHEN lh = 0 THEN 0.0 ELSE exp(1.0 - lr / lh) END) * exp({logp})
  END AS bleu FROM {name}_j)"""


def hash_key(seed, *cols) -> str:
    parts = " || ':' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"md5('{seed}:' || {parts})"


def teacher(ids: str, max_len: int, shift: str = "skip") -> tuple[str, str]:
    t = f"{ids}[1:{max_len - 2}]"
    if shift == "skip":
        x = f"list_concat([1], {t}[1:len({t}) - 1])"
        y = f"list_concat({t}[2:len({t})], [2])"
    else:
        x = f"list_concat([1], {t})"
        y = f"list_concat({t}, [2])"
    return x, y


def truncate_eos(ids: str, max_len: int) -> str:
    return f"list_concat({ids}[1:{max_len - 1}], [2])"


def pad_to(ids: str, m: str, pad: int = 0) -> str:
    return f"list_concat({ids}, list_transform(range(greatest({m} - len({ids}), 0)), lambda i: {pad}))"


EVENTS_LOG = """
mlog AS (
  SELECT user_id AS run_id, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS epoch, event_id AS step,
         event_type AS name, CAST(value AS DOUBLE) AS value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS weight
  FROM events)"""


def ngram_list(x: str, n: int = 3) -> str:
    return (f"CASE WHEN len({x}) >= {n} THEN list_transform(range(1, len({x}) - {n - 2}), "
            f"lambda i: {x}[i:i + {n - 1}]) ELSE [] END")
