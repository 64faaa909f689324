"""Unigram lattices of many words at once, over a prefix table of the pieces.

A :class:`Trie` is a sorted array of (state, character) keys.  A :class:`Lattice`
walks it from every character of many words side by side and holds one edge per
piece that occurs; paths are then found for all words together, one end position
after the other.  Everything is arrays: no Python step per character.

Words above ``LONG_WORD`` characters are solved one by one with the same rules
(a position-by-position sweep over arrays of one word gains nothing).
"""

from __future__ import annotations

import math

import numpy as np

NEG = float("-inf")
#: words of more characters are solved on their own
LONG_WORD = 200
#: words whose lattice is held at once, and characters of them
TOGETHER = 20_000
TOGETHER_CHARS = 200_000


class Trie:
    """Prefix table of a piece list; ``piece[state]`` is the number of the piece that ends there, or -1."""

    def __init__(self, pieces: list[str]):
        chars = sorted({c for p in pieces for c in p})
        self.code = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.width = len(chars) + 1
        self.max_len = max(map(len, pieces), default=0)
        lens = np.array([len(p) for p in pieces], np.int64)
        codes = np.zeros((len(pieces), self.max_len), np.int64)
        codes[np.arange(self.max_len) < lens[:, None]] = self.codes("".join(pieces))
        state, n_states = np.zeros(len(pieces), np.int64), 1
        keys, ends = [], [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for k in range(self.max_len):
            at = np.flatnonzero(lens > k)
            found, which = np.unique(state[at] * self.width + codes[at, k], return_inverse=True)
            state[at] = which + n_states
            keys.append(found)
            n_states += len(found)
            last = at[lens[at] == k + 1]
            ends.append((state[last], last))
        # states are numbered by level and parent, so the keys are in order of their states
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.piece = np.full(n_states, -1, np.int64)
        for where, number in ends:
            self.piece[where] = number

    def codes(self, text: str) -> np.ndarray:
        return self.code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Next states; 0 where no piece goes on."""
        if not len(self.keys):
            return np.zeros(len(state), np.int64)
        key = state * self.width + code
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at + 1, 0)

    def __getstate__(self):
        used = np.flatnonzero(self.code)
        return {**self.__dict__, "code": (used, self.code[used])}

    def __setstate__(self, d):
        self.__dict__.update(d)
        used, values = d["code"]
        self.code = np.zeros(0x110000, np.int32)
        self.code[used] = values


class Lattice:
    """Pieces that occur in many words: ``piece[character, length - 1]`` is the number of the piece of that
    length that starts there.  A character that is no piece is an ``unknown`` edge; ``none`` marks no edge.

    A word of n characters has n + 1 nodes; every node can be reached, by single characters at least."""

    def __init__(self, words: list[str], trie: Trie, pieces: int):
        self.unknown, self.none = pieces, pieces + 1
        self.n = np.array([len(w) for w in words], np.int64)
        chars = int(self.n.sum())
        codes = trie.codes("".join(words))
        self.word = np.repeat(np.arange(len(words)), self.n)
        self.first = np.cumsum(self.n) - self.n  # first character of every word
        self.root = self.first + np.arange(len(words))  # first node of every word
        left = self.n[self.word] - (np.arange(chars) - self.first[self.word])
        self.piece = np.full((chars, max(1, trie.max_len)), self.none, np.int32)
        at, state, length = np.arange(chars), np.zeros(chars, np.int64), 0
        while len(at) and length < trie.max_len:
            inside = left[at] > length
            at, state = at[inside], state[inside]
            state = trie.step(state, codes[at + length])
            at, state = at[state > 0], state[state > 0]
            number = trie.piece[state]
            self.piece[at[number >= 0], length] = number[number >= 0]
            length += 1
        self.piece[self.piece[:, 0] == self.none, 0] = self.unknown
        self.nodes = chars + len(words)
        self.by_length = np.argsort(self.n, kind="stable")

    def _values(self, score: np.ndarray, unknown: float) -> np.ndarray:
        return np.concatenate([score, [unknown, NEG]])[self.piece]

    def _forward(self, value: np.ndarray, combine) -> np.ndarray:
        """Total of every node; ``combine`` makes one number of the sums over the edges into a node, longest edge first."""
        total = np.zeros(self.nodes)
        lens, words = self.n[self.by_length], self.by_length
        for depth in range(1, int(self.n.max(initial=0)) + 1):
            w = words[np.searchsorted(lens, depth):]
            size = np.arange(min(depth, value.shape[1]), 0, -1)
            node = self.root[w] + depth
            total[node] = combine(total[node[:, None] - size] + value[(self.first[w] + depth)[:, None] - size, size - 1], node, size)
        return total

    def best(self, score: np.ndarray, unknown: float, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Best paths: (word, piece or ``unknown``) of their edges, in order.  Of equal sums the longer last piece wins.

        Without ``whole``, no piece may be a whole word."""
        value = self._values(score, unknown)
        if not whole:
            some = np.flatnonzero((self.n >= 1) & (self.n <= value.shape[1]))
            value[self.first[some], self.n[some] - 1] = np.where(self.n[some] > 1, NEG, value[self.first[some], 0])
        back = np.zeros(self.nodes, np.int64)

        def longest(sums, node, size):
            k = sums.argmax(axis=1)
            back[node] = size[k]
            return sums[np.arange(len(k)), k]

        self._forward(value, longest)
        node, word = self.root + self.n, np.arange(len(self.n))
        found = []
        while True:
            live = node > self.root[word]
            node, word = node[live], word[live]
            if not len(node):
                break
            size = back[node]
            node = node - size
            found.append((word, node, self.piece[node - word, size - 1]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        word, node, piece = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(node, kind="stable")
        return word[order], piece[order]

    def log_likelihoods(self, score: np.ndarray, unknown: float) -> np.ndarray:
        """Log of the sum over all paths of every word."""
        return self._forward(self._values(score, unknown), _log_sums)[self.root + self.n]

    def expected(self, score: np.ndarray, unknown: float, weight: np.ndarray) -> np.ndarray:
        """Expected occurrences of every piece, words weighted."""
        value = self._values(score, unknown)
        ahead = self._forward(value, _log_sums)
        behind = np.zeros(self.nodes)
        lens, words, width = self.n[self.by_length], self.by_length, value.shape[1]
        for depth in range(int(self.n.max(initial=0)) - 1, -1, -1):
            w = words[np.searchsorted(lens, depth + 1):]
            node = self.root[w] + depth
            size = np.arange(1, min(width, int(self.n.max()) - depth) + 1)
            to = np.minimum(node[:, None] + size, self.nodes - 1)  # edges beyond a word have no value
            behind[node] = _log_sums(behind[to] + value[self.first[w] + depth][:, size - 1])
        at, size = np.nonzero(self.piece < self.unknown)
        word, number = self.word[at], self.piece[at, size]
        node = at + word
        z = ahead[self.root + self.n]
        share = np.exp(ahead[node] + value[at, size] + behind[node + size + 1] - z[word])
        return np.bincount(number, weights=share * weight[word], minlength=self.unknown)


def _log_sums(x: np.ndarray, *_) -> np.ndarray:
    """log of the sums of exp of rows."""
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None]).sum(axis=1))


def in_portions(words: list[str]):
    """(words, whether they are long): short ones in portions of about equal length, long ones one by one."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    n = next((k for k, i in enumerate(order) if len(words[i]) > LONG_WORD), len(order))
    a = 0
    while a < n:
        # the longest word of a portion stands last
        b = min(a + TOGETHER, n)
        while b > a + 1 and (b - a) * len(words[order[b - 1]]) > TOGETHER_CHARS:
            b = a + max(1, (b - a) // 2)
        yield order[a:b], False
        a = b
    for i in order[n:]:
        yield [i], True


def best_path(word: str, pieces: dict, max_len: int, unk_score: float):
    """Viterbi: list of pieces (``None`` = unknown character) with the highest score sum."""
    n = len(word)
    best = [NEG] * (n + 1)
    back: list = [None] * (n + 1)
    best[0] = 0.0
    for i in range(n):
        bi = best[i]
        if bi == NEG:
            continue
        single = False
        for j in range(i + 1, min(n, i + max_len) + 1):
            p = word[i:j]
            e = pieces.get(p)
            if e is None:
                continue
            if j == i + 1:
                single = True
            s = bi + e[1]
            if s > best[j]:
                best[j] = s
                back[j] = (i, p)
        if not single:
            s = bi + unk_score
            if s > best[i + 1]:
                best[i + 1] = s
                back[i + 1] = (i, None)
    out = []
    j = n
    while j > 0:
        i, p = back[j]
        out.append(p)
        j = i
    out.reverse()
    return out


def _lse(a: float, b: float) -> float:
    if a == NEG:
        return b
    if b == NEG:
        return a
    m = max(a, b)
    return m + math.log(math.exp(a - m) + math.exp(b - m))


def expected_counts(word: str, logp: dict, max_len: int, unk_score: float, weight: float, acc: dict):
    """Forward-backward of one word: add ``weight`` × expected occurrences of each piece to ``acc``."""
    n = len(word)
    edges = []
    alpha = [NEG] * (n + 1)
    alpha[0] = 0.0
    for i in range(n):
        if alpha[i] == NEG:
            continue
        single = False
        for j in range(i + 1, min(n, i + max_len) + 1):
            p = word[i:j]
            s = logp.get(p)
            if s is None:
                continue
            if j == i + 1:
                single = True
            edges.append((i, j, p, s))
            alpha[j] = _lse(alpha[j], alpha[i] + s)
        if not single:
            edges.append((i, i + 1, None, unk_score))
            alpha[i + 1] = _lse(alpha[i + 1], alpha[i] + unk_score)
    beta = [NEG] * (n + 1)
    beta[n] = 0.0
    for i, j, p, s in reversed(edges):
        beta[i] = _lse(beta[i], s + beta[j])
    z = alpha[n]
    for i, j, p, s in edges:
        if p is None:
            continue
        e = math.exp(alpha[i] + s + beta[j] - z)
        if e > 0:
            acc[p] = acc.get(p, 0.0) + weight * e
    return z
