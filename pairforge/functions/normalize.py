"""nmt_nfkc text normalization (T0): a longest-match rewriting of character sequences.

The rule table is read from left to right; at each place the longest sequence that is
a key is replaced, and what was written is never read again.  Keys are single
characters and the full decompositions of composed characters, so marks are neither
reordered nor joined to a character that is composed already.

ASCII rows are done by Spark's own functions; only other rows reach the
Arrow-batched Python step (Spark has no Unicode normalization builtin).
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from ..constants import WORD_BOUNDARY

# --- Fixed values: where nmt_nfkc differs from plain NFKC --------------------
# Removed code points.
NMT_REMOVE = [0x0001, 0x0002, 0x0003, 0x0004, 0x0005, 0x0006, 0x0007, 0x0008, 0x000B,
              0x000E, 0x000F, 0x0010, 0x0011, 0x0012, 0x0013, 0x0014, 0x0015, 0x0016,
              0x0017, 0x0018, 0x0019, 0x001A, 0x001B, 0x001C, 0x001D, 0x001E, 0x001F,
              0x007F, 0x008F, 0x009F]
# Code points mapped to a space.
NMT_SPACE = [0x0009, 0x000A, 0x000C, 0x000D, 0x061C, 0x1680, 0x200B, 0x200C, 0x200E,
             0x200F, 0x2028, 0x2029, 0x2581, 0xFEFF, 0xFFFD]
# Code points left as they are (NFKC would change them).
NMT_KEEP = [0xFF5E]
# Characters that the Unicode data of older Python versions doesn't hold: first code point, what it and the next ones become.
NEWER = [(0xA7F1, "S"), (0x1CCD6, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (0x1CCF0, "0123456789")]

_SPACES = re.compile(" +")


class _Singles(dict):
    """What a code point becomes; filled as code points are met."""

    def __missing__(self, cp: int) -> str:
        self[cp] = out = unicodedata.normalize("NFKC", chr(cp))
        return out


_SINGLES = _Singles({cp: "" for cp in NMT_REMOVE} | {cp: " " for cp in NMT_SPACE} | {cp: chr(cp) for cp in NMT_KEEP}
                    | {first + k: c for first, chars in NEWER for k, c in enumerate(chars)})


@lru_cache(maxsize=1)
def sequence_rules() -> tuple[dict[str, str], int, re.Pattern]:
    """(decomposition -> composed text, longest key, pattern of characters that stand second or later in a key).

    A rule whose result the shorter rules give as well is none."""
    found = {}
    for cp in range(0x80, 0x30000):
        c = chr(cp)
        if unicodedata.decomposition(c) or 0xAC00 <= cp <= 0xD7A3:
            parts = unicodedata.normalize("NFKD", c)
            if len(parts) > 1:
                found[parts] = unicodedata.normalize("NFKC", c)
    rules: dict[str, str] = {}
    for key in sorted(found, key=len):
        if _rewritten(key, rules, len(key) - 1) != found[key]:
            rules[key] = found[key]
    later = sorted({c for key in rules for c in key[1:]})
    # other characters that stand for these
    same = [chr(cp) for cp in range(0x80, 0x30000) if len(d := unicodedata.normalize("NFKD", chr(cp))) == 1 and d in set(later)]
    return rules, max(map(len, rules)), re.compile("[" + "".join(map(re.escape, {*later, *same})) + "]")


def _rewritten(text: str, rules: dict[str, str], longest: int) -> str:
    # a character counts in a sequence as the one that it is decomposed to
    plain = [unicodedata.normalize("NFKD", c) for c in text]
    out, i, n = [], 0, len(text)
    while i < n:
        for size in range(min(longest, n - i), 1, -1):
            if all(len(p) == 1 for p in plain[i: i + size]) and (new := rules.get("".join(plain[i: i + size]))) is not None:
                out.append(new)
                i += size
                break
        else:
            out.append(_SINGLES[ord(text[i])])
            i += 1
    return "".join(out)


def rewrite(text: str) -> str:
    """The rule table alone, without the treatment of spaces."""
    if text.isascii():  # no sequence is ASCII alone
        return text.translate(_SINGLES)
    rules, longest, later = sequence_rules()
    if later.search(text):
        return _rewritten(text, rules, longest)
    return text.translate(_SINGLES)


def nmt_nfkc(text: str | None, add_prefix: bool = True) -> str | None:
    """Normalize one string: rule table, collapse/trim spaces, ``▁`` for spaces."""
    if text is None:
        return None
    t = _SPACES.sub(" ", rewrite(text)).strip(" ")
    if not t:
        return ""
    if add_prefix:
        t = " " + t
    return t.replace(" ", WORD_BOUNDARY)


@F.pandas_udf(T.StringType())
def _nmt_nfkc_udf(s: pd.Series) -> pd.Series:
    return s.map(nmt_nfkc, na_action="ignore")


#: bytes of text that are cut into words at once
PORTION_BYTES = 4 << 20


def text_portions(texts: pa.Array, limit: int = PORTION_BYTES):
    """Slices of a string array of about ``limit`` bytes (one text at least)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, side="right")))
        yield texts.slice(a, b - a)
        a = b


def tokens(texts: pa.Array) -> pa.Array:
    """What stands between the ASCII spaces of every text (null: nothing), as lists.

    No sequence of the rule table holds a space, so a normalized text is its normalized
    tokens one after the other."""
    return pc.split_pattern(pc.fill_null(texts, ""), " ")


def _ascii_normalized(c: Column) -> Column:
    spaces, gone = ("".join(chr(cp) for cp in cps if cp < 0x80) for cps in (NMT_SPACE, NMT_REMOVE))
    t = F.trim(F.regexp_replace(F.translate(c, spaces + gone, " " * len(spaces)), " +", " "))
    return F.when(t == "", t).otherwise(F.translate(F.concat(F.lit(" "), t), " ", WORD_BOUNDARY))


def normalize_nmt_nfkc(col) -> Column:
    """T0 as a column expression; the Python step gets null for ASCII rows."""
    c = F.col(col) if isinstance(col, str) else col
    plain = ~c.rlike("[^\\x00-\\x7F]")
    return F.when(plain, _ascii_normalized(c)).otherwise(_nmt_nfkc_udf(F.when(~plain, c)))
