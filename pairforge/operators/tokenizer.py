"""Encoding and decoding with a unigram vocabulary table.

``vocab(id INT, piece STRING, score DOUBLE)`` is small (bounded by the
vocabulary size, checked on load) and shipped once per executor: as a
broadcast dict for encoding, as a literal array for decoding.
"""

from __future__ import annotations

import itertools
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..constants import BOS_ID, EOS_ID, MAX_LEN, PAD_ID, SPECIAL_PIECES, UNK_ID, UNK_SURFACE, WORD_BOUNDARY
from ..functions.arrays import teacher_forcing, truncate_with_eos
from ..functions.lattice import Lattice, Trie, best_path, in_portions
from ..functions.normalize import nmt_nfkc, text_portions, tokens

MAX_VOCAB_ROWS = 1_000_000
UNK_PENALTY = 10.0
#: words that a worker keeps the ids of
CACHED_WORDS = 200_000
_SEP = "\u0000"
#: the pattern of a text that may not be cut
WHOLE = "(?s).+"


def collect_vocab(vocab: DataFrame) -> list[tuple[int, str, float]]:
    """The vocabulary rows on the driver, after checking their number."""
    n = vocab.count()
    if n > MAX_VOCAB_ROWS:
        raise ValueError(f"vocabulary of {n} rows is above the {MAX_VOCAB_ROWS} row limit")
    rows = [(int(r[0]), r[1], float(r[2])) for r in vocab.select("id", "piece", "score").collect()]
    ids = sorted(r[0] for r in rows)
    if ids != list(range(len(ids))):
        raise ValueError("vocabulary ids must be 0..n-1")
    return rows


class WordEncoder:
    """Ids of words, by the best path through the lattice of each distinct word.

    New words of a batch are solved together over one prefix table; a bounded cache
    (values are pure functions of the word) spares repeated ones."""

    def __init__(self, rows: list[tuple[int, str, float]]):
        normal = [(p, i, s) for i, p, s in rows if p not in set(SPECIAL_PIECES) and i > UNK_ID]
        self.pieces = [p for p, _, _ in normal]
        self.ids = np.array([i for _, i, _ in normal] + [UNK_ID], np.int64)
        self.score = np.array([s for _, _, s in normal])
        self.unknown = (float(self.score.min()) if normal else 0.0) - UNK_PENALTY
        self.trie = Trie(self.pieces)
        self.known: dict[str, list[int]] = {}
        self.tokens: dict[str, list[int]] = {}

    def learn(self, words: list[str]) -> None:
        for some, long in in_portions(words):
            if long:
                table = {p: (i, s) for p, i, s in zip(self.pieces, self.ids.tolist(), self.score.tolist())}
                path = best_path(words[some[0]], table, self.trie.max_len, self.unknown)
                self.known[words[some[0]]] = [UNK_ID if p is None else table[p][0] for p in path]
                continue
            word, piece = Lattice([words[k] for k in some], self.trie, len(self.pieces)).best(self.score, self.unknown)
            ids, end = self.ids[piece].tolist(), np.cumsum(np.bincount(word, minlength=len(some))).tolist()
            for k, a, b in zip(some, [0, *end], end):
                self.known[words[k]] = ids[a:b]

    def encode(self, texts: list[list[str]]) -> list[list[int]]:
        """Ids of texts (lists of words); neighbouring unknown characters are one id, across words too."""
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        self.learn(sorted(set().union(*texts).difference(known)))
        out = []
        for words in texts:
            ids = [i for w in words for i in known[w]]
            if UNK_ID in ids:
                ids = [i for i, before in zip(ids, [None, *ids]) if not i == before == UNK_ID]
            out.append(ids)
        return out

    def encode_texts(self, texts: pa.Array, pattern: str) -> pa.Array:
        """Ids of raw texts as lists: every distinct token is normalized, cut and solved once, and its ids are
        copied to where it stands.  ``pattern`` has to cut at every word mark."""
        found = tokens(texts)
        coded = found.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.tokens) > CACHED_WORDS:
            self.tokens.clear()
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        # ASCII letters alone are one word as they are
        cut = {t: [WORD_BOUNDARY + t] if t.isascii() and t.isalpha() else split_words(nmt_nfkc(t), pattern)
               for t in distinct if t not in self.tokens}
        self.learn(sorted(set().union(*cut.values()).difference(self.known)))
        self.tokens.update((t, [i for w in words for i in self.known[w]]) for t, words in cut.items())
        lists = [self.tokens[t] for t in distinct]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(sizes.sum()))
        code = coded.indices.to_numpy()
        n = sizes[code]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[code] - ends[:-1], n) + np.arange(ends[-1])]
        rows = ends[found.offsets.to_numpy()]
        # neighbouring unknown characters of a text are one id
        keep = np.ones(len(ids), bool)
        keep[1:] = (ids[1:] != UNK_ID) | (ids[:-1] != UNK_ID)
        keep[rows[:-1][rows[:-1] < rows[1:]]] = True
        rows = np.concatenate([[0], np.cumsum(keep)])[rows]
        return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(ids[keep], pa.int32()))


def encode(df: DataFrame, col: str, vocab: DataFrame, out: str = "ids", normalize: bool = True) -> DataFrame:
    """Best segmentation of each text into vocabulary ids (ARRAY<INT>).

    Empty or null text gives ``[]``.  Runs per Arrow batch, some MB of text at a time; a
    distinct word is solved once per Python worker (as long as its bounded cache holds it)."""
    spark = df.sparkSession
    rows = collect_vocab(vocab)
    bc = spark.sparkContext.broadcast((uuid.uuid4().hex, WordEncoder(rows)))
    pattern = cut_pattern([p for i, p, _ in rows if i > UNK_ID])

    by_token = normalize and pattern != WHOLE

    @F.arrow_udf("array<int>")
    def _encode(texts: pa.Array) -> pa.Array:
        encoder, done = _word_encoder(bc), [pa.array([], pa.list_(pa.int32()))]
        for some in text_portions(texts):
            if by_token:
                done.append(encoder.encode_texts(some, pattern))
            else:
                cut = [split_words((nmt_nfkc(t) if normalize else t) if t is not None else "", pattern) for t in some.to_pylist()]
                done.append(pa.array(encoder.encode(cut), pa.list_(pa.int32())))
        return pa.concat_arrays(done)

    return df.withColumn(out, _encode(F.col(col)))


_ENCODERS: dict = {}


def _word_encoder(bc) -> WordEncoder:
    """The encoder of one broadcast vocabulary, kept with its cache for the life of
    the Python worker (workers are reused across tasks)."""
    token, encoder = bc.value
    if token not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[token] = encoder
    return _ENCODERS[token]


def cut_pattern(pieces) -> str:
    """Where a text may be cut before the search for its best path: at word marks
    and around digits, unless some piece reaches across such a cut."""
    w = WORD_BOUNDARY
    if any(w in p[1:] for p in pieces):
        return WHOLE
    if any(len(p) > 1 and any("0" <= c <= "9" for c in p) for p in pieces):
        return f"{w}[^{w}]*|[^{w}]+"
    return f"{w}[^{w}0-9]*|[0-9]|[^{w}0-9]+"


def split_words(s: str, pattern: str | None = None) -> list[str]:
    """Words of a normalized text: ``▁``-prefixed runs; by default every digit alone."""
    return re.findall(pattern or cut_pattern(()), s)


def surface_array(rows) -> list[str]:
    """Index = id; control pieces print nothing, unknown prints `` ⁇ ``."""
    arr = [""] * len(rows)
    for i, p, _ in rows:
        if i in (PAD_ID, BOS_ID, EOS_ID) or p in ("<pad>", "<s>", "</s>"):
            arr[i] = ""
        elif i == UNK_ID or p == "<unk>":
            arr[i] = UNK_SURFACE
        else:
            arr[i] = p
    return arr


def decode_col(ids, surfaces: list[str]) -> Column:
    """T4 as an expression: pieces joined, one leading ``▁`` of the first piece
    dropped, ``▁`` → space.  The surface table is a constant-folded literal
    array, so each lookup is O(1) and stays JVM-side."""
    if any(_SEP in s for s in surfaces):
        raise ValueError("piece contains NUL")
    table = F.split(F.lit(_SEP.join(surfaces)), _SEP)
    c = F.col(ids) if isinstance(ids, str) else ids
    surf = F.filter(F.transform(c, lambda i: F.element_at(table, i + 1)), lambda s: s != F.lit(""))
    first = F.regexp_replace(F.element_at(surf, 1), f"^{WORD_BOUNDARY}", "")
    rest = F.array_join(F.slice(surf, 2, F.greatest(F.size(surf), F.lit(1))), "")
    text = F.when(F.size(surf) == 0, F.lit("")).otherwise(F.concat(first, rest))
    return F.translate(text, WORD_BOUNDARY, " ")


def decode(df: DataFrame, ids: str, vocab: DataFrame, out: str = "text") -> DataFrame:
    """T4: ids back to text."""
    return df.withColumn(out, decode_col(ids, surface_array(collect_vocab(vocab))))


def encode_pairs(df: DataFrame, src_vocab: DataFrame, tgt_vocab: DataFrame, max_len: int = MAX_LEN,
                 shift: str = "skip", src="src", tgt="tgt") -> DataFrame:
    """Encode both sides, then P5 on the source and P6 on the target."""
    e = encode(encode(df, src, src_vocab, "_s"), tgt, tgt_vocab, "_t")
    x_tgt, y = teacher_forcing("_t", max_len, shift)
    return e.select(*[c for c in df.columns if c not in (src, tgt)],
                    truncate_with_eos("_s", max_len).alias("x_src"), x_tgt.alias("x_tgt"), y.alias("y"))
