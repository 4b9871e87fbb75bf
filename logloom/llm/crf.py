"""Linear-chain conditional random field over the words of whole batches of texts.

Emission weights are hashed: every n-gram of ``^word$`` (those that touch an end are
its affixes) and the whole word (the lexicon) have a weight per label; transitions and
starts are learned weights too. Forward-backward runs over all words of a batch at
once, with a reset at every text's first word: the words are laid out in about sqrt(n)
columns, column products of the transfer matrices give each column's start, and a
second pass fills in the columns. Numpy does the same few operations for all columns,
so there is no Python step per word.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BUCKETS = 1 << 18
NGRAMS = (2, 3, 4)
UNKNOWN = -1


@dataclass
class Model:
    labels: list[str]
    emit: np.ndarray  # (BUCKETS, labels)
    step: np.ndarray  # (labels, labels), from row to column
    start: np.ndarray  # (labels,)

    def parts(self) -> tuple:
        """Plain values to broadcast; ``Model(*parts)`` on the other side."""
        return self.labels, self.emit, self.step, self.start


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of every feature of the words."""
    ends = [f"\x02{w}\x03" for w in words]
    codes = np.frombuffer("".join(ends).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, ends), np.int64, len(ends)))
    owners = [np.arange(len(words))]
    lexicon = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    buckets = [lexicon]
    for n in NGRAMS:
        if len(codes) < n:
            continue
        size = len(codes) - n + 1
        hashed = np.full(size, n, dtype=np.uint64)
        for i in range(n):
            hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + size]
        inside = owner[:size] == owner[n - 1 : n - 1 + size]
        owners.append(owner[:size][inside])
        buckets.append((hashed ^ (hashed >> np.uint64(29)))[inside])
    return np.concatenate(owners), (np.concatenate(buckets) % np.uint64(BUCKETS)).astype(np.int64)


def emissions(words: list[str], emit: np.ndarray) -> np.ndarray:
    """Log-potentials (word, label)."""
    if not words:
        return np.zeros((0, emit.shape[1]))
    owner, bucket = features(words)
    return _sums(owner, emit[bucket], len(words))


def _sums(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(index, values[:, k], n) for k in range(values.shape[1])], axis=1)


def _normal(x: np.ndarray, axes) -> np.ndarray:
    return x / np.maximum(x.sum(axis=axes, keepdims=True), 1e-300)


def marginals(scores: np.ndarray, first: np.ndarray, model: Model, moves: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: label probabilities of every word, and expected transition counts.

    ``scores``: log-potentials (words, labels); ``first``: whether a word starts a text. Without
    ``moves``, which only a fit needs, the counts are left at zero.
    """
    n, k = scores.shape
    if not n:
        return np.zeros((0, k)), np.zeros((k, k))
    width = int(np.ceil(np.sqrt(n)))
    columns = -(-n // width)
    local = np.ones((columns * width, k))
    local[:n] = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60))
    resets = np.ones(columns * width, dtype=bool)
    resets[:n] = first
    local, resets = local.reshape(columns, width, k), resets.reshape(columns, width)
    step, start = np.exp(model.step - model.step.max()), np.exp(model.start - model.start.max())

    def transfer(t: int) -> np.ndarray:
        base = np.where(resets[:, t, None, None], start[None, None, :], step[None])
        return base * local[:, t, None, :]

    whole = np.tile(np.eye(k), (columns, 1, 1))
    for t in range(width):
        whole = _normal(whole @ transfer(t), (1, 2))
    entry, leave = np.zeros((columns, k)), np.ones((columns, k))
    entry[0] = 1 / k
    for c in range(1, columns):
        entry[c] = _normal(entry[c - 1] @ whole[c - 1], 0)
        leave[-1 - c] = _normal(whole[-c] @ leave[-c], 0)
    ahead, behind = np.empty((columns, width, k)), np.empty((columns, width, k))
    at = entry
    for t in range(width):
        at = _normal(np.einsum("ci,cij->cj", at, transfer(t)), 1)
        ahead[:, t] = at
    at = leave
    for t in range(width - 1, -1, -1):
        behind[:, t] = at
        at = _normal(np.einsum("cij,cj->ci", transfer(t), at), 1)
    ahead, behind = ahead.reshape(-1, k)[:n], behind.reshape(-1, k)[:n]
    local = local.reshape(-1, k)[:n]
    moved = np.zeros((k, k))
    for part in range(1, n if moves else 0, 1 << 17):
        rows = np.arange(part, min(n, part + (1 << 17)))
        rows = rows[~first[rows]]
        pairs = ahead[rows - 1][:, :, None] * step[None] * (local[rows] * behind[rows])[:, None, :]
        moved += _normal(pairs, (1, 2)).sum(axis=0)
    return _normal(ahead * behind, 1), moved


def fit(
    sequences: list[tuple[list[str], list[int]]], labels: list[str], rounds: int = 40, rate: float = 0.25, decay: float = 1e-4
) -> Model:
    """Maximum-likelihood weights by Adam over all sequences at once; repeatable.

    A word whose label is ``UNKNOWN`` counts under every label, as likely as the field finds it
    between its neighbours: the likelihood is that of the known labels alone.
    """
    k = len(labels)
    flat = [w for words, _ in sequences for w in words]
    truth = np.array([y for _, marks in sequences for y in marks], dtype=np.int64)
    first = np.zeros(len(flat), dtype=bool)
    first[np.cumsum([0] + [len(words) for words, _ in sequences if words][:-1])] = True
    kinds: dict[str, int] = {}
    kind = np.array([kinds.setdefault(w, len(kinds)) for w in flat], dtype=np.int64)
    owner, bucket = features(list(kinds))
    used, bucket = np.unique(bucket, return_inverse=True)
    unknown = truth == UNKNOWN
    wanted = np.eye(k)[truth]
    seen_steps = np.zeros((k, k))
    if not unknown.any():
        inner = np.flatnonzero(~first)
        np.add.at(seen_steps, (truth[inner - 1], truth[inner]), 1)
    barred = np.where(unknown[:, None] | (wanted > 0), 0.0, -1e6)
    weights = [np.zeros((len(used), k)), np.zeros((k, k)), np.zeros(k)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for i in range(1, rounds + 1):
        model = Model(labels, weights[0], weights[1], weights[2])
        scores = _sums(owner, weights[0][bucket], len(kinds))[kind]
        probs, moved = marginals(scores, first, model)
        if unknown.any():
            wanted, seen_steps = marginals(scores + barred, first, model)
        gap = _sums(kind, wanted - probs, len(kinds))
        slopes = [
            _sums(bucket, gap[owner], len(used)) / len(flat),
            (seen_steps - moved) / len(flat),
            (wanted - probs)[first].sum(axis=0) / len(flat),
        ]
        for w, g, (m, v) in zip(weights, slopes, moments, strict=True):
            g -= decay / len(flat) * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-12)
    emit = np.zeros((BUCKETS, k), dtype=np.float32)
    emit[used] = weights[0]
    return Model(labels, emit, weights[1], weights[2])


class Tagger:
    """Marginals of texts given as word lists; remembers the scores of up to ``limit`` words."""

    def __init__(self, model: Model, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.labels)), dtype=np.float32)

    def _rows(self, words: list[str]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known, self.scores = {}, self.scores[:0]
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            parts = [emissions(new[i : i + 50_000], self.model.emit) for i in range(0, len(new), 50_000)]
            self.scores = np.concatenate([self.scores, *parts]).astype(np.float32)
        return self.scores[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))].astype(np.float64)

    def tag(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Label probabilities (word, label) of each text."""
        out: list[np.ndarray] = []
        start = 0
        while start < len(texts):  # a bounded number of words at a time
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= 300_000):
                size += len(texts[end])
                end += 1
            part = texts[start:end]
            lengths = [len(t) for t in part]
            flat = [w for t in part for w in t]
            first = np.zeros(len(flat), dtype=bool)
            offsets = np.cumsum([0, *lengths])
            first[offsets[:-1][np.array(lengths) > 0]] = True
            probs, _ = marginals(self._rows(flat), first, self.model, moves=False)
            out += [probs[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            start = end
        return out
