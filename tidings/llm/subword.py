"""Hashed subword features and an averaged-embedding softmax, in numpy.

A text becomes a bag of buckets: hashes of its character n-grams inside words
(with word ends marked) and, if asked for, of its words and word pairs. Texts are
turned into arrays in blocks, so that a task holds a bounded number of
characters at a time; a text that is longer than a block is cut between words
and its parts are added up, with the word pairs that the cuts take apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np

# Characters per block.
BLOCK = 1 << 19
PRIME = np.uint64(0x100000001B3)
MIX = np.uint64(0x9E3779B97F4A7C15)
SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass(frozen=True)
class Features:
    bits: int
    sizes: tuple[int, ...]
    # Whole words and pairs of neighbouring words.
    words: bool
    # Letters only and lower case, or every character between white space.
    letters: bool

    def prepare(self, text: str) -> np.ndarray:
        """Code points of a text; 0 where a word ends."""
        x = code_points(text.lower() if self.letters else text)
        inside = _letters()[x] if self.letters else ~np.isin(x, SPACES)
        return np.where(inside, x, 0).astype(np.uint64)

    def buckets(self, x: np.ndarray, texts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(position, bucket) of each kind of feature. x starts and ends with 0; `texts` has the first positions of its texts."""
        gap = x == 0
        ends = np.cumsum(gap)
        shift = np.uint64(64 - self.bits)
        rolling = x.copy()
        for n in range(1, max(self.sizes) + 1):
            if n > 1:
                rolling = rolling[:-1] * PRIME + x[n - 1 :]
            if n not in self.sizes:
                continue
            # No word end inside, and at least one character.
            valid = ends[n - 2 : -1] - ends[: len(x) - n + 1] == 0 if n > 2 else ~gap[: len(x) - n + 1]
            if n == 2:
                valid = ~(gap[:-1] & gap[1:])
            at = np.flatnonzero(valid)
            yield at, ((rolling[at] + np.uint64(n)) * MIX) >> shift
        if self.words:
            starts, stops = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1, np.flatnonzero(~gap[:-1] & gap[1:]) + 1
            # Sums of a fixed pseudo-random value per character and place in the word.
            place = np.arange(len(x)) - np.maximum.accumulate(np.where(gap, np.arange(len(x)), 0))
            mixed = (x * MIX) ^ (x >> np.uint64(7))
            total = np.concatenate([[np.uint64(0)], np.cumsum(mixed * (place.astype(np.uint64) * PRIME | np.uint64(1)), dtype=np.uint64)])
            words = total[stops] - total[starts]
            words = (words ^ (words >> np.uint64(29))) * MIX
            yield starts, words >> shift
            # A pair's hash is the difference of its words', so that all doubled words share one bucket.
            owner = np.searchsorted(texts, starts, side="right")
            same = np.flatnonzero(owner[1:] == owner[:-1])
            pairs = words[same + 1] - words[same]
            yield starts[same + 1], ((pairs ^ (pairs >> np.uint64(31))) * MIX) >> shift


def _bridge(features: Features, x: np.ndarray, at: int, stop: int) -> int | None:
    """The bucket of the pair of words that a cut at `stop` takes apart; None if there is no word in x[at:stop] or behind it."""
    left, right = np.flatnonzero(x[at:stop]), np.flatnonzero(x[stop:])
    if not features.words or not len(left) or not len(right):
        return None
    end, first = at + int(left[-1]) + 1, stop + int(right[0])
    before, after = np.flatnonzero(x[:end] == 0), np.flatnonzero(x[first:] == 0)
    words = x[int(before[-1]) + 1 if len(before) else 0 : end], x[first : first + int(after[0]) if len(after) else len(x)]
    zero = np.zeros(1, np.uint64)
    *_, (_, bucket) = features.buckets(np.concatenate([zero, words[0], zero, words[1], zero]), np.ones(1, np.int64))
    return int(bucket[0])


def blocks(
    features: Features, texts: Sequence[str | None], bridges: list[tuple[int, int]] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text numbers, first position of each, code points with a 0 between texts) of bounded length.

    To `bridges` it adds (text number, bucket) of the word pairs that its cuts take apart.
    """
    own, starts, parts, length = [], [], [], 1
    zero = np.zeros(1, np.uint64)
    for number, text in enumerate(texts):
        if not text:
            continue
        x = features.prepare(text)
        at = 0
        while at < len(x):
            stop = min(len(x), at + BLOCK)
            if stop < len(x):
                # Cut between words; a word longer than a block stays whole.
                before = np.flatnonzero(x[at:stop] == 0)
                if len(before) and before[-1]:
                    stop = at + int(before[-1])
                else:
                    after = np.flatnonzero(x[stop:] == 0)
                    stop += int(after[0]) if len(after) else len(x) - stop
            if stop < len(x) and bridges is not None and (pair := _bridge(features, x, at, stop)) is not None:
                bridges.append((number, pair))
            if length + stop - at > BLOCK and own:
                yield np.array(own), np.array(starts), np.concatenate([zero, *parts])
                own, starts, parts, length = [], [], [], 1
            own.append(number)
            starts.append(length)
            parts += [x[at:stop], zero]
            length += stop - at + 1
            at = stop
    if own:
        yield np.array(own), np.array(starts), np.concatenate([zero, *parts])


def table_sums(features: Features, table: np.ndarray, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the sum of its features' table rows, and their number."""
    sums, counts = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts))
    columns = np.ascontiguousarray(table.T)
    bridges: list[tuple[int, int]] = []
    for own, starts, x in blocks(features, texts, bridges):
        for at, bucket in features.buckets(x, starts):
            # A feature at the mark before a text belongs to that text.
            cuts = np.searchsorted(at, np.append(starts - 1, len(x)))
            n = np.diff(cuts)
            some = n > 0
            np.add.at(counts, own, n)
            for k, column in enumerate(columns):
                values = column[bucket].astype(np.float64)
                if some.any():
                    np.add.at(sums[:, k], own[some], np.add.reduceat(values, cuts[:-1][some]))
    for number, bucket in bridges:
        sums[number] += table[bucket]
        counts[number] += 1
    return sums, counts


def bag(features: Features, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    total = np.zeros(1 << features.bits)
    bridges: list[tuple[int, int]] = []
    for _, starts, x in blocks(features, [text], bridges):
        for _, bucket in features.buckets(x, starts):
            total += np.bincount(bucket.astype(np.int64), minlength=len(total))
    np.add.at(total, [bucket for _, bucket in bridges], 1)
    found = np.flatnonzero(total)
    return found.astype(np.int32), (total[found] / max(total.sum(), 1)).astype(np.float32)


@dataclass
class Model:
    features: Features
    classes: list
    # Embeddings times output weights: a document's logits are the mean of its features' rows plus the bias.
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, texts: Sequence[str | None]) -> np.ndarray:
        sums, counts = table_sums(self.features, self.table, texts)
        return (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature

    def probabilities(self, texts: Sequence[str | None]) -> np.ndarray:
        return softmax(self.logits(texts))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(
    features: Features,
    bags: Sequence[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    classes: list,
    *,
    dim: int = 16,
    epochs: int = 8,
    rate: float = 0.5,
    seed: int = 0,
) -> Model:
    """Stochastic gradient descent over single documents; the rate falls linearly to zero.

    An embedding's step is scaled up by its document's number of buckets, up
    to a bound, as an average passes only a share of the gradient to each.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << features.bits, dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (dim, len(classes))).astype(np.float32)
    bias = np.zeros(len(classes), np.float32)
    steps, step = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            found, shares = bags[i]
            now = rate * (1 - step / steps)
            step += 1
            hidden = shares @ vectors[found] if len(found) else np.zeros(dim, np.float32)
            error = softmax(hidden @ out + bias).astype(np.float32)
            error[labels[i]] -= 1
            back = out @ error
            out -= now * np.outer(hidden, error)
            bias -= now * 0.1 * error
            if len(found):
                # Steps of the size one feature would take: shares relative to the largest.
                vectors[found] -= (now * shares / shares.max())[:, None] * back[None, :]
    return Model(features, classes, (vectors @ out).astype(np.float32), bias.astype(np.float64))


def calibrate(model: Model, logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least loss on held-back documents."""
    grid = np.exp(np.linspace(-4, 4, 81))
    losses = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])
