"""Operator 13: encoding and decoding with merge-type (BPE) SentencePiece models.

The symbols of a text are its characters.  An agenda holds every adjacent pair of
symbols whose concatenation is a piece, best score first and leftmost first among
equal scores; the best pair is merged and the pairs with its new neighbours join the
agenda, until it is empty.  Symbols that are no piece become byte pieces.

Two neighbouring characters that stand next to one another in no piece are never
merged, whatever surrounds them.  Where the pieces allow it (checked when a model is
loaded), a text is therefore cut before a space that follows another character and
around line feeds; every stretch has an agenda of its own and equal words share their
result (a bounded cache of a pure function).  New words of a portion of texts are merged
side by side, one merge of each in a step; long stretches have a heap as agenda.

``disagreements`` encodes and decodes the same rows with the sentencepiece library in
Arrow batches and returns the rows that differ.

Models must be of type BPE with the identity normalizer, spaces kept and escaped, no
user-defined and no unused pieces (checked when a model is loaded).

Cases: null and empty texts have no ids and decode to the empty text; texts of any
length are encoded whole; repeated rows and repeated or null ids are encoded as often
as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from .common import CACHE_WORDS, small_batches, spread_rows

#: fixed value: the symbol that stands for a space in pieces
SPACE = "▁"
#: fixed value: what an unknown piece decodes to
UNKNOWN = " ⁇ "
#: stretches of more characters aren't kept in the cache
CACHED_CHARS = 48
#: stretches that are merged together
TOGETHER = 20_000
#: texts of about so many characters are encoded together (a longer one alone)
CHARS = 2_000_000
#: rank of a pair that makes no piece
NONE = (1 << 31) - 1
#: words with the spaces before them, and spaces at the end
RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """Encoder and decoder of one model; one per Python process."""

    _loaded: dict[str, Pieces] = {}

    @classmethod
    def load(cls, path: str) -> Pieces:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb
        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm, train = spec.normalizer_spec, spec.trainer_spec
        kinds = pb.ModelProto.SentencePiece
        odd = {kinds.USER_DEFINED, kinds.UNUSED} & {p.type for p in spec.pieces}
        if (train.model_type != pb.TrainerSpec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces or train.treat_whitespace_as_suffix or odd):
            raise ValueError(f"{path}: a BPE model with the identity normalizer and ordinary pieces is needed")
        self.library = SentencePieceProcessor(model_file=path)
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.by_bytes = train.byte_fallback
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes, self.spell, self.plain = [0] * 256, [], []
        for i, p in enumerate(spec.pieces):
            byte = p.type == kinds.BYTE
            if byte:
                self.bytes[int(p.piece[3:5], 16)] = i
                self.spell.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kinds.NORMAL:
                self.ids[p.piece], self.scores[p.piece] = i, p.score
                self.spell.append(p.piece.replace(SPACE, " ").encode())
            else:
                self.spell.append(UNKNOWN.encode() if p.type == kinds.UNKNOWN else b"")
            if p.type == kinds.UNKNOWN:
                self.unknown = i
            self.plain.append(not byte)
        self.control = {i for i, x in enumerate(self.spell) if not x}
        # by id, for many ids at once: the decimal number behind a comma, the text, and whether
        # its first character may be the space that stands before every text
        self.decimals = pa.array([b",%d" % i for i in range(len(self.spell))], pa.large_binary())
        self.spells = pa.array(self.spell, pa.large_binary())
        self.spaced = np.array([x[:1] == b" " and p and i != self.unknown for i, (x, p) in enumerate(zip(self.spell, self.plain))], bool)
        #: a space never follows another character inside a piece, and a line feed stands alone
        inner = [p for p in self.ids if len(p) > 1]
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in inner)
        self.by_lines = not any("\n" in p for p in inner)
        # symbols by number: pieces, and characters that only occur inside longer pieces
        self.symbol = dict(self.ids)
        for c in sorted({c for p in inner for c in p}):
            self.symbol.setdefault(c, len(self.spell) + len(self.symbol))
        #: no symbol has the last number below the width, so keys with an unknown symbol (-1) are no keys
        self.width = 2 + max(self.symbol.values(), default=0)
        #: rank of the merge of two symbols (equal scores have equal ranks), and the symbol that it makes
        self.rank: dict[int, int] = {}
        self.made: dict[int, int] = {}
        order = {x: k for k, x in enumerate(sorted({self.scores[p] for p in inner}, reverse=True))}
        for p in inner:
            for k in range(1, len(p)):
                left, right = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if left is not None and right is not None:
                    self.rank[left * self.width + right] = order[self.scores[p]]
                    self.made[left * self.width + right] = self.symbol[p]
        self.text = {i: p for p, i in self.symbol.items()}
        # the same as arrays: symbol by code point, merges by sorted key
        self.by_code = np.full(0x110000, -1, np.int32)
        for p, i in self.symbol.items():
            if len(p) == 1:
                self.by_code[ord(p)] = i
        self.keys = np.array(sorted(self.rank), np.int64)
        self.key_rank = np.array([*(self.rank[k] for k in self.keys.tolist()), NONE], np.int32)
        self.key_made = np.array([*(self.made[k] for k in self.keys.tolist()), -1], np.int32)
        #: ids of words (see ``words``) and of other stretches
        self.known: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}
        #: the same as they stood when the caches were last full
        self.known_before: dict[str, bytes] = {}
        self.odd_before: dict[str, bytes] = {}

    # -- encoding ------------------------------------------------------------
    def merge(self, sym: list) -> list:
        """Symbols (numbers, or characters of no piece) after all merges, best score first, leftmost first.

        The agenda is a heap; pairs that have changed since they entered are passed over."""
        rank, made, width, n = self.rank, self.made, self.width, len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list = []

        def enter(i, j):
            a, b = sym[i], sym[j]
            if a.__class__ is int and b.__class__ is int and (r := rank.get(a * width + b)) is not None:
                heapq.heappush(heap, (r, i, j, a, b))

        for i in range(n - 1):
            enter(i, i + 1)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if sym[i] != a or sym[j] != b or right[i] != j:
                continue
            sym[i], sym[j], right[i] = made[a * width + b], None, right[j]
            if right[j] < n:
                left[right[j]] = i
                enter(i, right[j])
            if left[i] >= 0:
                enter(left[i], i)
        return [s for s in sym if s is not None]

    def stretch(self, text: str) -> bytes:
        """Ids of a stretch of escaped text, as 32-bit integers."""
        symbol, out = self.symbol.get, []
        for s in self.merge([symbol(c, c) for c in text]):
            if s.__class__ is int and s < len(self.spell):
                out.append(s)
            elif self.by_bytes:
                out += [self.bytes[b] for b in (s if s.__class__ is str else self.text[s]).encode("utf-8", "replace")]
            else:
                out.append(self.unknown)
        return np.array(out, np.int32).tobytes()

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of the merge of every two symbols; the last number if there is none."""
        key = a.astype(np.int64) * self.width + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, len(self.keys)) if len(self.keys) else np.zeros(len(key), np.int64)

    def stretches(self, texts: list[str]) -> list[bytes]:
        """Ids of many short stretches at once: a row of a matrix is the agenda of a stretch."""
        n = np.array(list(map(len, texts)))
        cols = np.arange(int(n.max()), dtype=np.int32)
        sym = np.full((len(texts), len(cols)), -1, np.int32)
        sym[cols < n[:, None]] = self.by_code[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        # ranks of the pairs (no symbol: no merge)
        agenda = self.key_rank[self.pairs(sym[:, :-1].ravel(), sym[:, 1:].ravel())].reshape(len(texts), -1)
        done, rows = np.full_like(sym, -1), np.arange(len(texts))
        # every row that is left has had as many merges, so the matrix gets narrower by one column a step
        while agenda.shape[1]:
            at = agenda.argmin(axis=1)  # the leftmost of the best
            live = agenda[np.arange(len(rows)), at] < NONE
            if not live.all():
                done[rows[~live], : sym.shape[1]] = sym[~live]
                rows, sym, agenda, at = rows[live], sym[live], agenda[live], at[live]
                if not len(rows):
                    break
            r, last = np.arange(len(rows)), agenda.shape[1] - 1
            new = self.key_made[self.pairs(sym[r, at], sym[r, at + 1])]
            n[rows] -= 1
            # what stands behind the pair moves one place to the left
            behind = cols[: last + 1] > at[:, None]
            sym = np.where(behind, sym[:, 1:], sym[:, :-1])
            agenda = np.where(behind[:, :last], agenda[:, 1:], agenda[:, :-1])
            sym[r, at] = new
            after, before = np.flatnonzero(at < last), np.flatnonzero(at > 0)
            agenda[after, at[after]] = self.key_rank[self.pairs(new[after], sym[after, at[after] + 1])]
            agenda[before, at[before] - 1] = self.key_rank[self.pairs(sym[before, at[before] - 1], new[before])]
        done[rows, : sym.shape[1]] = sym
        inside = cols < n[:, None]
        plain = ((done >= 0) & (done < len(self.spell)) | ~inside).all(axis=1)
        data, end = done[inside].astype(np.int32).tobytes(), np.cumsum(n * 4).tolist()
        return [data[a:b] if ok else self.stretch(t) for t, a, b, ok in zip(texts, [0, *end], end, plain.tolist())]

    def learn(self, known: dict[str, bytes], words: list[str], texts: list[str]) -> None:
        """Ids of words whose stretches are ``texts``; rows of a matrix have about the same length."""
        order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
        for a in range(0, len(order), TOGETHER):
            some = order[a: a + TOGETHER]
            for k, ids in zip(some, self.stretches([texts[k] for k in some])):
                known[words[k]] = ids

    def words(self, text: str) -> tuple[list[str], dict[str, bytes]]:
        """A text as keys of stretches, and the cache that holds them.

        Keys of ``known`` are words without the space before them, or a line feed with the
        word behind it; keys of ``odd`` are stretches with their spaces escaped."""
        if self.by_words and self.by_lines and self.prefix and SPACE not in text:
            words = text.replace("\n", " \n").split(" ")
            # the first word has the space that stands before every text
            if "" not in words and words[0][0] != "\n":
                return words, self.known
        text = self.prefix + text.replace(" ", SPACE)
        return (RUNS.findall(text) if self.by_words else [text]), self.odd

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        found = [self.words(t) if t else ([], self.odd) for t in texts]
        for known, before in ((self.known, self.known_before), (self.odd, self.odd_before)):
            new = set().union(*[w for w, d in found if d is known]).difference(known)
            if len(known) + len(new) > CACHE_WORDS:
                # words that are used again come back from the generation before
                before.clear()
                before.update(known)
                known.clear()
                new = set().union(*[w for w, d in found if d is known])
            old = new.intersection(before)
            known.update((w, before[w]) for w in old)
            new = sorted(w for w in new.difference(old) if len(w) < CACHED_CHARS)
            self.learn(known, new, new if known is self.odd else [w if w[0] == "\n" else SPACE + w for w in new])
        out = []
        for words, known in found:
            try:
                ids = b"".join([known[w] for w in words])
            except KeyError:  # long stretches
                ids = b"".join([known[w] if w in known else
                                self.stretch(w if known is self.odd or w[0] == "\n" else SPACE + w) for w in words])
            ids = np.frombuffer(ids, np.int32)
            if not self.by_bytes and len(ids):
                # neighbouring unknown symbols are one id
                ids = ids[np.append(True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown))]
            out.append(ids)
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_many([text or ""])[0]

    # -- decoding ------------------------------------------------------------
    def decode(self, ids: list[int]) -> str:
        spell, plain = self.spell, self.plain
        if not self.control.isdisjoint(ids):
            return self._decode_runs(ids)
        data = b"".join([spell[i] for i in ids])
        if self.prefix:
            # the space that stands before every text goes: that of the first piece that has any text
            for i in ids:
                if spell[i]:
                    if spell[i][:1] == b" " and plain[i] and i != self.unknown:
                        data = data[1:]
                    break
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids)

    def decode_many(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
        """The decoded texts (UTF-8) of many rows of ids, of which one ends where the next begins."""
        odd = np.isin(ids, list(self.control))
        for (a, b), data in zip(pairwise(ends.tolist()), _joined(self.spells, ids, ends)):
            if a < b and not odd[a:b].any():
                if self.prefix and self.spaced[ids[a]]:
                    data = data[1:]
                try:
                    str(data, "utf-8")
                    yield data
                    continue
                except UnicodeDecodeError:
                    pass
            yield self.decode(ids[a:b].tolist()).encode()

    def _decode_runs(self, ids: list[int]) -> str:
        """Runs of byte pieces on their own: every byte that starts no character is replaced."""
        out, first = [], bool(self.prefix)
        for plain, run in groupby(ids, key=self.plain.__getitem__):
            run = list(run)
            data = b"".join([self.spell[i] for i in run])
            if plain:
                if first and data[:1] == b" " and next((i for i in run if self.spell[i]), self.unknown) != self.unknown:
                    data = data[1:]
                out.append(data.decode())
            else:
                out.append(replace_bytes(data))
            first = first and not out[-1]
        return "".join(out)


def replace_bytes(data: bytes) -> str:
    out, k = [], 0
    while k < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[k: k + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            size = 1
            out.append("�")
        k += size
    return "".join(out)


def _joined(words: pa.Array, ids: np.ndarray, ends: np.ndarray) -> Iterator[memoryview]:
    """The words of every row's ids one after the other."""
    taken = words.take(pa.array(ids))
    at, data = np.frombuffer(taken.buffers()[1], np.int64, len(ids) + 1), memoryview(taken.buffers()[2] or b"")
    for a, b in pairwise(at[ends].tolist()):
        yield data[a:b]


def _portions(texts: list) -> Iterator[list[str]]:
    held, n = [], 0
    for t in texts:
        held.append(t or "")
        n += len(held[-1])
        if n >= CHARS:
            yield held
            held, n = [], 0
    if held:
        yield held


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32)))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int> of every whole text."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        pieces = Pieces.load(path)
        for b in batches:
            at = 0
            for texts in _portions(b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), _lists(pieces.encode_many(texts))], names=["doc_id", "ids"])
                at += len(texts)

    return spread_rows(rows).mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The text of every row's ids, as a column (null ids: null)."""
    @F.pandas_udf("string")
    def text(ids):
        pieces = Pieces.load(path)
        return ids.map(lambda x: None if x is None else pieces.decode(x.tolist()))

    return df.withColumn(out, text(F.col(ids_col)))


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and hex digests of the ids and of the text decoded from them."""
    def run(batches):
        pieces = Pieces.load(path)
        for b in batches:
            ends, ids = b.column(1).offsets.to_numpy(), b.column(1).values.to_numpy()
            a = [hashlib.sha256(x[1:]).hexdigest() for x in _joined(pieces.decimals, ids, ends)]
            d = [hashlib.sha256(x).hexdigest() for x in pieces.decode_many(ids, ends)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends), pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {dict(encoded.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def disagreements(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, library_ids of the rows whose ids or decoded text differ from the sentencepiece library's."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        pieces = Pieces.load(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            theirs = pieces.library.encode(texts, num_threads=1)
            back = pieces.library.decode(theirs)
            own = [pieces.encode(t) for t in texts]
            bad = [k for k, x in enumerate(own) if x.tolist() != theirs[k] or pieces.decode(theirs[k]) != back[k]]
            if bad:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(bad)), _lists([own[k] for k in bad]), _lists([np.array(theirs[k], np.int32) for k in bad])],
                    names=["doc_id", "ids", "library_ids"])

    return spread_rows(rows).mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>, library_ids array<int>")


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = model_path()
    return digests(encode(table(spark, sf_dir, "documents"), path), path)
