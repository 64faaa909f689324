"""Operator 2: language identification with segmentation-marginalised unigrams.

Over the pieces of a fixed public vocabulary every language has piece
probabilities, learned by expectation-maximisation from labelled texts.  A word
scores as the sum over all of its segmentations into pieces (forward algorithm
in log space), a text as the product over its words, and the language with the
largest posterior wins.  A character outside the vocabulary passes as its
bytes, so that any text has a segmentation.

Cases: null text and text without a letter give ``und`` with score 0; empty and
very long texts and words are scored whole; rows with null ``lang`` are never
learned from but predicted; ties fall to the first language in sorted order;
without any labelled row every text is ``und``; an empty table gives an empty
result; other columns are ignored.

The model is fitted on every labelled row, as counts of distinct words by language;
prediction covers every row and every word.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.lattice import Trie
from ..sources.tables import table
from .common import LETTER, crc32_mod, small_batches, spread_rows, stage

ROUNDS = 3
SMOOTHING = 0.05
#: words whose scores a process keeps
MODEL_CACHE = 500_000
#: fixed value: the space mark of the vocabulary
SPACE_MARK = "▁"
#: words that a task takes into one step of the fit
FIT_WORDS = 20_000
STRIP = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"
UND = "und"
#: logarithms of probabilities down to minus this are far inside the range of a double
LEAST_LOG = 600


class Pieces:
    """Pieces of a vocabulary file: index, and the prefixes that end the search for longer ones."""

    _loaded: dict[str, Pieces] = {}

    @classmethod
    def load(cls, path: str) -> Pieces:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.index = {p: 256 + i for i, p in enumerate(dict.fromkeys(names))}  # 0..255: bytes
        self.size = 256 + len(self.index)

    @cached_property
    def prefixes(self) -> Trie:
        return Trie(list(self.index))

    def edges(self, words: list[str]):
        """(word, start, end, piece) of every piece inside every word, and (word, place, byte) of characters that are no piece.

        The prefix table is walked from all characters of all words side by side."""
        n = np.array([len(w) for w in words], np.int64)
        text = "".join(words)
        codes = self.prefixes.codes(text)
        word = np.repeat(np.arange(len(words)), n)
        place = np.arange(len(codes)) - (np.cumsum(n) - n)[word]
        left = n[word] - place
        at, state, length = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0
        found, single = [], np.zeros(len(codes), bool)
        while len(at) and length < self.prefixes.max_len:
            inside = left[at] > length
            at, state = at[inside], state[inside]
            state = self.prefixes.step(state, codes[at + length])
            at, state = at[state > 0], state[state > 0]
            length += 1
            piece = self.prefixes.piece[state]
            ends = piece >= 0
            found.append((word[at[ends]], place[at[ends]], place[at[ends]] + length, 256 + piece[ends]))
            if length == 1:
                single[at[ends]] = True
        rare = [(word[k], place[k], b) for k in np.flatnonzero(~single) for b in text[k].encode("utf-8", "surrogatepass")]
        out = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found)] or [np.zeros(0, np.int64)] * 4
        return *out, *(np.array(x, np.int64) for x in (zip(*rare) if rare else ([], [], [])))


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray  # log, by language
    logp: np.ndarray   # pieces x languages, float64
    path: str


class Scores:
    """Word scores of one model that a Python process keeps from task to task."""

    _now: Scores | None = None

    def __init__(self, model: Model):
        self.model, self.cache, self.table = model, {}, np.zeros((1024, len(model.langs)))

    @classmethod
    def of(cls, model: Model) -> Scores:
        if cls._now is None or not (cls._now.model is model or (cls._now.model.langs == model.langs and np.array_equal(cls._now.model.logp, model.logp))):
            cls._now = cls(model)
        return cls._now


def _lattice(pieces: Pieces, words: list[str]):
    """Edges in steps: all edges of one step end at the same place and have one length.

    A character that is no piece passes as its bytes (``single``); all others only as pieces."""
    w, i, j, p, bw, bi, bb = pieces.edges(words)
    n = max(map(len, words))
    order = np.argsort(j * 64 + (j - i), kind="stable")
    w, i, j, p = w[order], i[order], j[order], p[order]
    cuts = np.flatnonzero(np.diff(j.astype(np.int64) * 64 + (j - i))) + 1
    return w, i, j, p, np.concatenate(([0], cuts, [len(w)])) if len(w) else np.array([0]), bw, bi, bb, n


def _byte_scores(logp, shape, bw, bi, bb):
    out = np.full((*shape, logp.shape[1]), -np.inf)
    out[bw, bi] = 0
    np.add.at(out, (bw, bi), logp[bb])
    return out


def forward(pieces: Pieces, words: list[str], logp: np.ndarray) -> np.ndarray:
    """log of the sum over all segmentations, words x languages."""
    w, i, j, p, cuts, bw, bi, bb, n = _lattice(pieces, words)
    ends = [len(x) for x in words]
    if logp.size and max(len(x.encode("utf-8", "surrogatepass")) for x in words) * -logp.min() < LEAST_LOG:
        # no product of probabilities can leave the range of a double: sums of products do
        prob = np.exp(logp)
        single = np.zeros((n, len(words), logp.shape[1]))  # by place, so that a step reads one plane
        if len(bw):
            some = np.exp(_byte_scores(logp, (len(words), n), bw, bi, bb))
            single[bi, bw] = some[bw, bi]
        a = np.zeros((n + 1, len(words), logp.shape[1]))
        a[0] = 1
        at = 0
        for end in range(1, n + 1):
            a[end] = a[end - 1] * single[end - 1]
            while at < len(cuts) - 1 and j[cuts[at]] == end:
                s = slice(cuts[at], cuts[at + 1])
                a[end, w[s]] += a[i[cuts[at]], w[s]] * prob[p[s]]
                at += 1
        return np.log(a[ends, np.arange(len(words))])
    a = np.full((len(words), n + 1, logp.shape[1]), -np.inf)
    a[:, 0] = 0
    single = _byte_scores(logp, (len(words), n), bw, bi, bb)
    at = 0
    for end in range(1, n + 1):
        a[:, end] = a[:, end - 1] + single[:, end - 1]
        while at < len(cuts) - 1 and j[cuts[at]] == end:
            s = slice(cuts[at], cuts[at + 1])
            a[w[s], end] = np.logaddexp(a[w[s], end], a[w[s], i[s]] + logp[p[s]])
            at += 1
    return a[np.arange(len(words)), ends]


def expected(pieces: Pieces, words: list[str], counts: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Expected uses of every piece over all segmentations (one language's ``logp``, a vector)."""
    lp = logp[:, None]
    w, i, j, p, cuts, bw, bi, bb, n = _lattice(pieces, words)
    m, ends = len(words), np.array([len(x) for x in words])
    single = _byte_scores(lp, (m, n), bw, bi, bb)[:, :, 0]
    a = np.full((m, n + 1), -np.inf)
    a[:, 0] = 0
    at = 0
    for end in range(1, n + 1):
        a[:, end] = a[:, end - 1] + single[:, end - 1]
        while at < len(cuts) - 1 and j[cuts[at]] == end:
            s = slice(cuts[at], cuts[at + 1])
            a[w[s], end] = np.logaddexp(a[w[s], end], a[w[s], i[s]] + logp[p[s]])
            at += 1
    b = np.full((m, n + 1), -np.inf)
    b[np.arange(m), ends] = 0
    at = len(cuts) - 2
    for end in range(n, 0, -1):
        while at >= 0 and j[cuts[at]] == end:
            s = slice(cuts[at], cuts[at + 1])
            b[w[s], i[s]] = np.logaddexp(b[w[s], i[s]], b[w[s], end] + logp[p[s]])
            at -= 1
        b[:, end - 1] = np.logaddexp(b[:, end - 1], b[:, end] + single[:, end - 1])
    total = a[np.arange(m), ends]
    out = np.zeros(len(logp))
    np.add.at(out, p, counts[w] * np.exp(a[w, i] + logp[p] + b[w, j] - total[w]))
    one = np.exp(a[bw, bi] + single[bw, bi] + b[bw, bi + 1] - total[bw])
    np.add.at(out, bb, counts[bw] * one)
    return out


def by_length(words: list[str], cells: int = 100_000):
    """Groups of word numbers of like length, with a bounded lattice each."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    group, top = [], 1
    for k in order:
        top = len(words[k]) + 1
        if group and (len(group) + 1) * top > cells:
            yield group
            group = []
        group.append(k)
    if group:
        yield group


def core(word: str) -> str:
    """A word without ASCII punctuation and digits at its ends, behind the space mark ("" if nothing is left)."""
    w = word.strip(STRIP)
    return SPACE_MARK + w if w else ""


def count_words(train: DataFrame) -> DataFrame:
    """lang, word, n over whole training texts (counted inside tasks first)."""
    def count(batches):
        for b in batches:
            by = defaultdict(Counter)
            for lang, text in zip(b["lang"], b["text"]):
                by[lang].update(text.lower().split())
            rows = Counter()
            for lang, c in by.items():
                for w, n in c.items():
                    rows[lang, core(w)] += n
            yield pd.DataFrame([(a, w, n) for (a, w), n in rows.items() if w], columns=["lang", "word", "n"])

    return (train.select("lang", "text").mapInPandas(count, "lang string, word string, n long")
                 .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def _joined(batches, rows: int = FIT_WORDS):
    """Batches put together to about ``rows`` rows."""
    held = []
    for b in batches:
        held.append(b)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held)
            held = []
    if held:
        yield pd.concat(held)


def fit(spark: SparkSession, train: DataFrame, path: str, rounds: int = ROUNDS) -> Model:
    """``doc_id, lang, text`` (no nulls) -> model of all rows."""
    per_lang = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs, total = sorted(per_lang), sum(per_lang.values())
    size = Pieces.load(path).size
    logp = np.full((size, len(langs)), -np.log(size))
    if not langs:
        return Model([], np.zeros(0), logp, path)
    words = spread_rows(stage(count_words(spread_rows(train)), "langid-words"))
    for _ in range(rounds):
        now = logp

        def e_step(batches):
            pieces = Pieces.load(path)
            out = np.zeros_like(now)
            for b in _joined(batches):
                for k, lang in enumerate(langs):
                    one = b[b["lang"] == lang]
                    ws, ns = one["word"].tolist(), one["n"].to_numpy(float)
                    for g in by_length(ws):
                        out[:, k] += expected(pieces, [ws[x] for x in g], ns[g], now[:, k])
            a, b = np.nonzero(out > 0)
            yield pd.DataFrame({"piece": a, "lang": b, "n": out[a, b]})

        # at most pieces x languages rows, whatever the corpus
        got = words.mapInPandas(e_step, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full((size, len(langs)), SMOOTHING)
        counts[got["piece"], got["lang"]] += got["n"]
        logp = np.log(counts / counts.sum(axis=0))
    prior = np.log([per_lang[x] / total for x in langs])
    return Model(langs, prior, logp, path)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every whole text."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = dict(rows.dtypes)["doc_id"]
    shared = df.sparkSession.sparkContext.broadcast(model)  # pieces x languages numbers

    def run(batches):
        m = shared.value
        pieces, n_langs = Pieces.load(m.path), len(m.langs)
        known = Scores.of(m)
        cache, table_ = known.cache, known.table
        for b in batches:
            texts = [(t or "").lower() for t in b["text"]]
            words = [t.split() for t in texts]
            if len(cache) > MODEL_CACHE:
                cache.clear()
            new = [w for w in set(chain.from_iterable(words)) if w not in cache]
            cores = {w: core(w) for w in new}
            todo = sorted({c for c in cores.values() if c and c not in cache})
            base = len(cache)
            need = base + len(todo) + len(new) + 1
            if need > len(table_):
                table_ = known.table = np.concatenate([table_, np.zeros((max(need, len(table_)), n_langs))])
            for g in by_length(todo):
                got = forward(pieces, [todo[k] for k in g], m.logp)
                for k, row in zip(g, got):
                    cache[todo[k]] = len(cache)
                    table_[cache[todo[k]]] = row
            zero = cache.setdefault("", len(cache))
            table_[zero] = 0
            for w, c in cores.items():
                if w not in cache:
                    cache[w] = cache[c]
            get = cache.__getitem__
            langs, scores = [], []
            for t, ws in zip(texts, words):
                if not n_langs or not LETTER.search(t):
                    langs.append(UND)
                    scores.append(0.0)
                    continue
                ll = table_[np.fromiter(map(get, ws), np.int64, len(ws))].sum(axis=0) + m.prior
                k = int(np.argmax(ll))
                langs.append(m.langs[k])
                scores.append(float(1 / np.exp(ll - ll[k]).sum()))
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": langs, "score": scores})

    return spread_rows(rows).mapInPandas(run, f"doc_id {id_type}, lang_pred string, score double")


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    train = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc32_mod("doc_id", 4) != 2))
    model = fit(spark, train.select("doc_id", "lang", "text"), vocabulary_path())
    return predict(docs, model).withColumn("held_out", crc32_mod("doc_id", 4) == 2).select("doc_id", "held_out", "lang_pred", "score")
