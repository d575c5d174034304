"""Linear-chain conditional random field over words, in numpy inside tasks.

Weights: one vector per hashed word feature (emissions) and one matrix of
label transitions.  Marginals come from forward-backward, exact for texts of
any length: long texts are cut into segments whose transfer matrices are
multiplied first, so that all the segments of a slice of documents advance
together, word by word, as one array.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np

from .common import slices

BUCKETS = 1 << 17
SEGMENT = 256
CACHED_WORDS = 150_000

WORD = re.compile(r"[^\W\d_]+")
#: Fractions, circled and Roman numbers and the like are word characters for ``re``, but no letters.
NUMERALS = {c: " " for c in map(chr, range(128, sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()}
_NUMERALS = frozenset(NUMERALS)


def letters_of(text: str) -> str:
    """The text with blanks for numerals that ``WORD`` would take for letters; of the same length."""
    if text.isascii() or _NUMERALS.isdisjoint(text):
        return text
    return text.translate(str.maketrans(NUMERALS))


def matches(text: str) -> Iterator[re.Match]:
    """The runs of letters, with their places in the text."""
    return WORD.finditer(letters_of(text))


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower case."""
    return [w.lower() for w in WORD.findall(letters_of(text or ""))]


def features(word: str, lexicon: dict[str, str]) -> list[int]:
    """Hashed affixes, character 3-grams, the word itself and its lexicon entry."""
    padded = f"^{word}$"
    names = [padded[i:i + 3] for i in range(len(padded) - 2)]
    names += [f"p{word[:n]}" for n in (1, 3, 4, 5)] + [f"s{word[-n:]}" for n in (1, 2, 4)] + [f"w{word}"]
    if entry := lexicon.get(word):
        names.append(f"l{entry}")
    return [crc32(n.encode()) % BUCKETS for n in names]


def feature_table(words: list[str], lexicon: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in one array, and where each word's begin."""
    rows = [features(w, lexicon) for w in words]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])[:-1]]).astype(np.int64)
    return np.fromiter((f for r in rows for f in r), dtype=np.int64, count=sum(map(len, rows))), starts


def potentials(scores: np.ndarray) -> np.ndarray:
    """exp of scores, scaled per word."""
    return np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -40.0)).astype(np.float32)


def _scaled(x: np.ndarray, axis) -> np.ndarray:
    return x / x.max(axis=axis, keepdims=True)


def forward_backward(e: np.ndarray, lengths: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """alpha and beta of every word, scaled per word.

    ``e``: potentials of all words, texts one after the other; ``lengths``:
    words per text (none of zero); ``a``: exp of the transitions.
    """
    k = e.shape[1]
    n_segments = -(-lengths // SEGMENT)
    text_of = np.repeat(np.arange(len(lengths)), n_segments)
    first_segment = np.concatenate([[0], np.cumsum(n_segments)[:-1]])
    rank = np.arange(len(text_of)) - first_segment[text_of]
    text_start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    start = text_start[text_of] + rank * SEGMENT
    size = np.minimum(SEGMENT, lengths[text_of] - rank * SEGMENT)

    entry = np.ones((len(start), k), np.float32)  # alpha before the segment
    leave = np.ones((len(start), k), np.float32)  # beta at its last word
    if (n_segments > 1).any():
        several = np.flatnonzero(n_segments[text_of] > 1)
        several = several[np.argsort(-size[several], kind="stable")]
        product = np.empty((len(several), k, k), np.float32)
        product[:] = np.where((rank[several] == 0)[:, None, None], np.eye(k, dtype=np.float32), a) * e[start[several]][:, None, :]
        for t in range(1, int(size[several].max())):
            n = int(np.searchsorted(-size[several], -t, "left"))
            product[:n] = _scaled((product[:n] @ a) * e[start[several[:n]] + t][:, None, :], (1, 2))
        transfer = np.empty((len(start), k, k), np.float32)
        transfer[several] = product
        for r in range(1, int(n_segments.max())):
            now = first_segment[n_segments > r] + r
            entry[now] = _scaled(np.einsum("ni,nij->nj", entry[now - 1], transfer[now - 1]), 1)
        for r in range(int(n_segments.max()) - 1, 0, -1):
            now = first_segment[n_segments > r] + r
            leave[now - 1] = _scaled(np.einsum("nij,nj->ni", transfer[now], leave[now]), 1)

    order = np.argsort(-size, kind="stable")
    start, size, rank, entry, leave = start[order], size[order], rank[order], entry[order], leave[order]
    alpha, beta = np.empty_like(e), np.empty_like(e)
    now = np.where((rank == 0)[:, None], entry, entry @ a) * e[start]
    alpha[start] = now = _scaled(now, 1)
    longest = int(size[0])
    active = [int(np.searchsorted(-size, -t, "left")) for t in range(longest + 1)]
    for t in range(1, longest):
        n = active[t]
        now = _scaled((now[:n] @ a) * e[start[:n] + t], 1)
        alpha[start[:n] + t] = now
    beta[start + size - 1] = leave
    back = a.T.copy()
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        at = start[:n] + t
        beta[at] = _scaled((e[at + 1] * beta[at + 1]) @ back, 1)
    return alpha, beta


def marginals(e: np.ndarray, lengths: np.ndarray, a: np.ndarray) -> np.ndarray:
    alpha, beta = forward_backward(e, lengths, a)
    p = alpha * beta
    return p / p.sum(axis=1, keepdims=True)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # BUCKETS x labels
    transitions: np.ndarray  # labels x labels
    lexicon: dict[str, str]
    extra: dict = field(default_factory=dict)

    def scores(self, words: list[str]) -> np.ndarray:
        at, starts = feature_table(words, self.lexicon)
        return np.add.reduceat(self.weights[at], starts, axis=0)


def train(sequences: list[tuple[list[str], list[int]]], labels: list[str], lexicon: dict[str, str],
          steps: int = 60, rate: float = 0.15, l2: float = 1e-4) -> Model:
    """Maximum likelihood with an L2 penalty: full-batch Adam, gradients by forward-backward."""
    k = len(labels)
    sequences = [s for s in sequences if s[0]]
    vocab: dict[str, int] = {}
    tokens = np.array([vocab.setdefault(w, len(vocab)) for ws, _ in sequences for w in ws], dtype=np.int64)
    truth = np.array([y for _, ys in sequences for y in ys], dtype=np.int64)
    lengths = np.array([len(ws) for ws, _ in sequences], dtype=np.int64)
    w, trans = np.zeros((BUCKETS, k), np.float32), np.zeros((k, k), np.float32)
    if not len(tokens):
        return Model(labels, w, trans, lexicon)
    at, starts = feature_table(list(vocab), lexicon)
    word_of = np.repeat(np.arange(len(vocab)), np.diff(np.concatenate([starts, [len(at)]])))
    inner = np.ones(len(tokens), bool)
    inner[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = False
    inner = np.flatnonzero(inner)  # words with one before them in the text
    seen_pairs = np.zeros((k, k))
    np.add.at(seen_pairs, (truth[inner - 1], truth[inner]), 1)
    moments = [np.zeros_like(x) for x in (w, w, trans, trans)]
    for step in range(1, steps + 1):
        e = potentials(np.add.reduceat(w[at], starts, axis=0)[tokens])
        a = np.exp(trans)
        alpha, beta = forward_backward(e, lengths, a)
        p = alpha * beta
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(tokens)), truth] -= 1.0  # expected minus seen
        after = e[inner] * beta[inner]
        norm = ((alpha[inner - 1] @ a) * after).sum(axis=1, keepdims=True)
        pairs = a * ((alpha[inner - 1] / norm).T @ after)
        per_word = np.stack([np.bincount(tokens, p[:, j], len(vocab)) for j in range(k)], axis=1)
        grad_w = np.stack([np.bincount(at, per_word[word_of, j], BUCKETS) for j in range(k)], axis=1)
        grad_w = (grad_w / len(tokens) + l2 * w).astype(np.float32)
        grad_t = ((pairs - seen_pairs) / len(tokens) + l2 * trans).astype(np.float32)
        for x, g, m, v in ((w, grad_w, *moments[:2]), (trans, grad_t, *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Model(labels, w, trans, lexicon)


class Tagger:
    """Marginals for many texts; scores of words are kept for up to ``CACHED_WORDS`` words at a time."""

    def __init__(self, model: Model):
        self.model, self.a = model, np.exp(model.transitions)
        self._reset()

    def _reset(self) -> None:
        self.at: dict[str, int] = {}
        self.table = np.zeros((0, len(self.model.labels)), np.float32)

    def tag(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(place of the text, marginals of its words) for every text, in order; no words: an empty array."""
        for lo, hi in slices(texts):
            yield from zip(range(lo, hi), self._slice([words_of(t) for t in texts[lo:hi]]))

    def _slice(self, words: list[list[str]]) -> list[np.ndarray]:
        if len(self.at) > CACHED_WORDS:
            self._reset()
        new = list({w: None for ws in words for w in ws if w not in self.at})
        if new:
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.table = np.concatenate([self.table, *(potentials(self.model.scores(new[i:i + 50_000]))
                                                       for i in range(0, len(new), 50_000))])
        lengths = np.array([len(ws) for ws in words], dtype=np.int64)
        get = self.at.__getitem__
        rows = np.fromiter((get(w) for ws in words for w in ws), dtype=np.int64, count=int(lengths.sum()))
        p = marginals(self.table[rows], lengths[lengths > 0], self.a) if len(rows) else np.zeros((0, len(self.a)))
        return np.split(p, np.cumsum(lengths)[:-1])


def lexicon_of(counts: Counter, least: int = 5, share: float = 0.8) -> dict[str, str]:
    """word -> label, for words seen ``least`` times with one label in ``share`` of the cases; ``counts[word, label]``."""
    total: Counter = Counter()
    for (word, _), n in counts.items():
        total[word] += n
    return {word: label for (word, label), n in counts.items() if total[word] >= least and n >= share * total[word]}
