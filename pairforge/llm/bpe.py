"""Operator 7: BPE encoding and decoding by tree concatenation.

A text is normalised and cut into pre-tokens as the tokenizer file says.  A long
unsplit stretch is encoded in halves; around each join a growing window of whole
tokens is encoded again until its first and last tokens are those the halves had
there.  Neighbouring tokens then all stand as the encoder would leave them, so
the concatenation equals the encoding of the whole stretch.

Long texts are cut into parts that many tasks encode (a part may end inside a
long stretch); the parts of one text are joined the same way.

The tokenizer file must have the layout of ``word_bpe_49k.json``: NFC, white
space as separator, lower case per character, the split pattern below, byte
symbols, an end-of-word suffix, no decoder.

Cases: null text encodes to no ids; texts of white space only have no ids; texts
may be of any length; special tokens inside a text become their ids; repeated
rows are encoded as often as they occur; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from .common import CACHE_WORDS, shuffle_parts, small_batches, spread_rows

#: (rank, new id) of a pair without a merge
NONE = (1 << 60, -1)
#: symbols up to which a stretch is merged directly
LEAF = 48
#: texts of more bytes are cut into parts of about this many characters
PART = 65_536

# fixed values: the split pattern of the tokenizer file, general and for lower-case ASCII text
GENERAL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\r\f\va-z0-9]+")


def byte_symbols() -> list[str]:
    """The printable character of every byte: printable Latin-1 bytes stand for themselves, the rest follow 255."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in own)}
    return [rest.get(b, chr(b)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one tokenizer file; one per Python process."""

    _loaded: dict[str, Bpe] = {}

    @classmethod
    def load(cls, path: str) -> Bpe:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.first = [vocab[c] for c in byte_symbols()]
        self.last = [vocab[c + suffix] for c in byte_symbols()]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.names = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for s, i in (*vocab.items(), *special.items()):
            self.names[i] = s
        # symbols of every token, found by undoing merges
        parts = {new: pair for pair, (_, new) in sorted(self.merges.items(), key=lambda x: -x[1][0])}
        self.spell: dict[int, list[int]] = {i: [i] for i in (*self.first, *self.last)}
        for (a, b), (_, new) in sorted(self.merges.items(), key=lambda x: x[1][0]):
            if parts[new] == (a, b):
                self.spell[new] = self.spell[a] + self.spell[b]
        self.decimal = [str(i) for i in range(len(self.names))]
        self.cache: dict[str, bytes] = {}

    # -- merging -------------------------------------------------------------
    def merge(self, ids: list[int]) -> list[int]:
        """All merges of a stretch, lowest rank first, leftmost first."""
        if len(ids) > LEAF:
            return self._merge_queue(ids)
        get, ids = self.merges.get, list(ids)
        pairs = [get(p, NONE) for p in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best is NONE:
                break
            i = pairs.index(best)
            ids[i: i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get((ids[i - 1], ids[i]), NONE)
            if i < len(pairs):
                pairs[i] = get((ids[i], ids[i + 1]), NONE)
        return ids

    def _merge_queue(self, ids: list[int]) -> list[int]:
        """The same with a queue of pairs, for long stretches."""
        get, n, ids = self.merges.get, len(ids), list(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], right[i] = new, -1, right[j]
            if right[j] < n:
                left[right[j]] = i
                if m := get((new, ids[right[j]])):
                    heapq.heappush(queue, (m[0], i, new, ids[right[j]], m[1]))
            if left[i] >= 0 and (m := get((ids[left[i]], new))):
                heapq.heappush(queue, (m[0], left[i], ids[left[i]], new, m[1]))
        return [x for x in ids if x >= 0]

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """The encoding of two stretches that follow one another, from their own encodings."""
        if not a or not b:
            return a or b
        k = 2
        while True:
            i, j = max(0, len(a) - k), min(len(b), k)
            window = self.merge([s for t in (*a[i:], *b[:j]) for s in self.spell[t]])
            if (i == 0 or window[0] == a[i]) and (j == len(b) or window[-1] == b[j - 1]):
                return a[:i] + window + b[j:]
            k *= 2

    def tree(self, symbols: list[int]) -> list[int]:
        """Halves, bottom up: level by level, so the depth of the text doesn't matter."""
        level = [self.merge(symbols[i: i + LEAF]) for i in range(0, len(symbols), LEAF)]
        while len(level) > 1:
            level = [self.join(level[i], level[i + 1]) if i + 1 < len(level) else level[i]
                     for i in range(0, len(level), 2)]
        return level[0] if level else []

    def symbols(self, data: bytes, end: bool) -> list[int]:
        ids = [self.first[b] for b in data]
        if end and data:
            ids[-1] = self.last[data[-1]]
        return ids

    # -- texts ---------------------------------------------------------------
    def pretokens(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """Pre-tokens up to each special token, and its id."""
        pieces = self.cut.split(text) if "<|" in text else [text]
        for k in range(0, len(pieces), 2):
            s = pieces[k]
            if s.isascii():
                words = ASCII.findall(s.lower())
            else:
                # per character: a capital sigma never becomes the final form
                words = GENERAL.findall(unicodedata.normalize("NFC", s).replace("Σ", "σ").lower())
            yield words, self.special[pieces[k + 1]] if k + 1 < len(pieces) else None

    def words(self, words: list[str]) -> bytes:
        """Ids of pre-tokens as 32-bit integers."""
        cache = self.cache
        try:
            return b"".join([cache[w] for w in words])
        except KeyError:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            for w in set(words):
                if w not in cache:
                    symbols = self.symbols(w.encode("utf-8", "surrogatepass"), True)
                    cache[w] = np.array(self.tree(symbols), np.int32).tobytes()
            return b"".join([cache[w] for w in words])

    def encode(self, text: str | None) -> np.ndarray:
        out = []
        for words, special in self.pretokens(text or ""):
            out.append(self.words(words))
            if special is not None:
                out.append(np.int32(special).tobytes())
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the file, names are joined by a space."""
        names = self.names
        return " ".join([names[i] for i in ids])

    def parts(self, text: str, size: int) -> Iterator[tuple[int, int, list[str] | None, bytes | None]]:
        """A long text as (special id or -1, glue, pre-tokens, bytes of a stretch).

        glue 1: the stretch goes on in the next part; 2: it ends here.
        A text without pre-tokens and special tokens is one part without pre-tokens."""
        empty = True
        for words, special in self.pretokens(text):
            held, n = [], 0
            empty = empty and not words and special is None
            for w in words:
                if len(w) > size:
                    if held:
                        yield -1, 0, held, None
                        held, n = [], 0
                    data = w.encode("utf-8", "surrogatepass")
                    cuts = [*range(0, len(data), size), len(data)]
                    for a, b in zip(cuts, cuts[1:]):
                        yield -1, 2 if b == len(data) else 1, None, data[a:b]
                    continue
                held.append(w)
                n += len(w) + 1
                if n > size:
                    yield -1, 0, held, None
                    held, n = [], 0
            if held:
                yield -1, 0, held, None
            if special is not None:
                yield special, 0, None, None
        if empty:
            yield -1, 0, [], None


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", part: int = PART) -> DataFrame:
    """doc_id, ids array<int> of every whole text."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = dict(rows.dtypes)["doc_id"]

    def whole(batches):
        bpe = Bpe.load(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _lists([bpe.encode(t) for t in b.column(1).to_pylist()])], names=["doc_id", "ids"])

    schema = f"doc_id {id_type}, ids array<int>"
    short = spread_rows(rows.filter(F.octet_length("text") <= part)).mapInArrow(whole, schema)

    def cut(batches):
        bpe = Bpe.load(path)
        for b in batches:
            for i, t, n, h in zip(*(b.column(k).to_pylist() for k in range(4))):
                for no, (special, glue, words, data) in enumerate(bpe.parts(t, part)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], ty) for x, ty in zip((i, n, no, special, glue, words, data, h), types)], names=names)

    def part_ids(batches):
        bpe = Bpe.load(path)
        for b in batches:
            ids = []
            for special, glue, words, data in zip(*(b.column(k).to_pylist() for k in range(3, 7))):
                if special >= 0:
                    ids.append(np.array([special], np.int32))
                elif data is not None:
                    ids.append(np.array(bpe.tree(bpe.symbols(data, glue == 2)), np.int32))
                else:
                    ids.append(np.frombuffer(bpe.words(words), np.int32))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(3)), b.column(4), _lists(ids), b.column(7)],
                                             names=["doc_id", "copies", "no", "glue", "ids", "text_hash"])

    def glued(key, t):
        bpe = Bpe.load(path)
        t = t.sort_by("no")
        out, run = [], []
        for glue, ids in zip(t["glue"].to_pylist(), t["ids"]):
            ids = ids.values.to_numpy()
            if not glue:
                out.append(ids)
                continue
            run.append(ids.tolist())
            if glue == 2:
                while len(run) > 1:
                    run = [bpe.join(run[i], run[i + 1]) if i + 1 < len(run) else run[i] for i in range(0, len(run), 2)]
                out.append(np.array(run[0], np.int32))
                run = []
        row = _lists([np.concatenate(out)] if out else [np.empty(0, np.int32)])
        return pa.table({"doc_id": t["doc_id"].slice(0, 1).combine_chunks(), "copies": t["copies"].slice(0, 1).combine_chunks(), "ids": row})

    import pyspark.sql.pandas.types as pt
    arrow_id = pt.to_arrow_type(rows.schema["doc_id"].dataType)
    names = ["doc_id", "copies", "no", "special", "glue", "words", "data", "text_hash"]
    types = [arrow_id, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.binary(), pa.int64()]
    longs = (rows.filter(F.octet_length("text") > part).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
                 .withColumn("text_hash", F.xxhash64("text", F.octet_length("text"))))
    pieces = longs.mapInArrow(cut, f"doc_id {id_type}, copies long, no int, special int, glue int, words array<string>, data binary, text_hash long")
    pieces = pieces.repartition(shuffle_parts(df.sparkSession), F.xxhash64("doc_id", "text_hash", "no"))
    done = (pieces.mapInArrow(part_ids, f"doc_id {id_type}, copies long, no int, glue int, ids array<int>, text_hash long")
                  .groupBy("doc_id", "text_hash").applyInArrow(glued, f"doc_id {id_type}, copies long, ids array<int>"))
    many = done.select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_c"), "ids")
    return short.unionByName(many.select("doc_id", "ids"))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The text of every row's ids, as a column."""
    @F.pandas_udf("string")
    def text(ids):
        bpe = Bpe.load(path)
        return ids.map(lambda x: bpe.decode(x.tolist()))

    return df.withColumn(out, text(F.col(ids_col)))


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and hex digests of the ids and of the decoded text."""
    id_type = dict(encoded.dtypes)["doc_id"]

    def digest(batches):
        bpe = Bpe.load(path)
        for b in batches:
            n, a, d = [], [], []
            for x in b.column(1):
                ids = x.values.to_numpy().tolist() if x.values is not None else []
                n.append(len(ids))
                a.append(hashlib.sha256(" ".join([bpe.decimal[i] for i in ids]).encode()).hexdigest())
                d.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(digest, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = tokenizer_path()
    return digests(encode(table(spark, sf_dir, "documents"), path), path)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: doc_id, n_tokens, ids of every text."""
    small_batches(spark)
    out = encode(docs, tokenizer_path())
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")
