"""Column expressions for text: strip, cleanup, word split, null handling.

All are built-in regex / string functions, so they stay inside whole-stage
codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import NA_STRINGS, WS

#: the characters of ``WS``
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WORD_CHARS = "\\p{L}\\p{N}_'"
#: what becomes one space: a run of non-word characters (white space too), or one that is no white space.
#: The same as every non-word character to a space and then runs of dots and white space to one.
GAPS_RE = f"[^{WORD_CHARS}]{{2,}}|[^{WORD_CHARS}{WS}]"
SPLIT_RE = f"[{WS}]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_text(col) -> Column:
    """Unicode strip at both ends."""
    return F.btrim(_c(col), F.lit(SPACES))


def clean_text(col) -> Column:
    """lower → strip → non-word chars to space → collapse dot/space runs.

    There is no final strip: ``Hello, World!`` becomes ``hello world ``.
    """
    c = strip_text(F.lower(_c(col)))
    return F.regexp_replace(c, GAPS_RE, " ")


def stringify_nulls(col) -> Column:
    """null → the text ``nan`` (P4), as a vocabulary corpus writer would."""
    return F.coalesce(_c(col), F.lit("nan"))


def words(col) -> Column:
    """Whitespace split without empty strings (T5)."""
    return F.filter(F.split(_c(col), SPLIT_RE), lambda x: x != F.lit(""))


def na_to_null(col) -> Column:
    """Strings a pandas CSV reader takes as missing become null."""
    c = _c(col)
    return F.when(c.isin(NA_STRINGS), F.lit(None).cast("string")).otherwise(c)


def strip_lines(df, cols):
    """P2 over several columns of a DataFrame."""
    for c in cols:
        df = df.withColumn(c, strip_text(c))
    return df


def drop_missing(df, cols, na_values: bool = False):
    """drop a row when any of ``cols`` is null.

    With ``na_values=True`` the pandas NA strings count as missing as well
    (use this on text that did not pass through :func:`na_to_null`).
    """
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull()
        if na_values:
            ok = ok & ~F.col(c).isin(NA_STRINGS)
        cond = ok if cond is None else cond & ok
    return df.filter(cond)


def clean_pairs(df, cols=("src", "tgt")):
    for c in cols:
        df = df.withColumn(c, clean_text(c))
    return df
