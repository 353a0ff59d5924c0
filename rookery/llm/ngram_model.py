"""A hashed word and character n-gram logistic regression, calibrated, fitted on a bounded sample and scored in batches.

Features are the shares of hashed n-grams among a text's n-grams of the same family (character trigrams and 4-grams over
UTF-8 bytes, words, word pairs), slightly smoothed, so a text's logit is the sum over families of the mean weight of its
n-grams: scoring is one gather and one sum for each n-gram, whatever the text's length.

Fitting takes at most ``FitBounds.per_class`` labelled rows of each class, the first by a hash of the key, of texts up to
``FitBounds.longest`` characters, one text for each key (the first in order where a key comes again); a fifth of them
calibrate the logit (a slope and an offset, weighted to the classes' true shares). Everything else sees whole texts and all
rows. A text of more than ``PIECE`` bytes is summed up piece by piece, cut at white space, so that memory stays bounded; the
sums are those of the whole text, unless a single word is as long as a piece: such a word counts as several.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.batches import slices

FAMILIES = ("char3", "char4", "word1", "word2")
BITS = 16
FIT_BYTES = 1 << 19
PIECE = 2 << 20
PRIOR_WEIGHT = 0.1
GAIN = 24.0  # shares are small; a fixed gain puts them on the scale of the penalty
SPARE = 200  # keys beyond twice the sample that a class may send to its ranking
SMOOTH = 16  # n-grams added to each count, so that a very short text says little either way
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
SPACE = re.compile(rb"[\x20\x09-\x0D]")
BLANK = b" \t\n\x0b\x0c\r"
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class FitBounds:
    per_class: int = 800
    longest: int = 60_000
    rounds: int = 100
    penalty: float = 1e-4


def _slot(hashes: np.ndarray) -> np.ndarray:
    """A bucket of each 64-bit value."""
    mixed = (hashes ^ hashes >> np.uint64(31)) * MIX
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    base, inverse = 0x100000001B3, pow(0x100000001B3, -1, 1 << 64)
    return tuple(
        np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64), dtype=np.uint64)])
        for b in (base, inverse)
    )


def ngrams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each family: (family number, buckets of all n-grams, where each text's n-grams start, with the total last)."""
    texts = texts.cast(pa.string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    wide = raw.astype(np.uint64)
    for family, n in ((0, 3), (1, 4)):
        code = np.zeros(max(0, len(raw) - n + 1), np.uint64)
        for i in range(n):
            code = code << np.uint64(8) | wide[i : len(raw) - n + 1 + i]
        # n-grams that cross into the next text are left out
        starts = np.minimum(offsets, len(code))
        inside = np.ones(len(code), bool)
        for i in range(1, n):
            at = offsets[1:-1] - i
            inside[at[(at >= 0) & (at < len(code))]] = False
        kept = np.concatenate([[0], np.cumsum(inside)])
        yield family, _slot(code[inside] * ODD + np.uint64(n)), kept[starts]
    space = SPACES[raw]
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = space[1:] != space[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    at = at[:-1] if len(raw) else at[:0]
    ends = np.append(at[1:], len(raw)) if len(at) else at
    word = ~space[at] if len(at) else np.empty(0, bool)
    first, last = at[word], ends[word]
    power, inverse = _powers(len(raw))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(wide * power[: len(raw)], dtype=np.uint64)])
    hashes = (total[last] - total[first]) * inverse[first] + (last - first).astype(np.uint64) * ODD
    bounds = np.searchsorted(first, offsets)
    yield 2, _slot(hashes * ODD), bounds
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    same = owner[1:] == owner[:-1] if len(owner) else np.empty(0, bool)
    # a word that follows itself is one pair, whatever the word: doubled words are seen in words never met in fitting
    doubled = hashes[:-1] == hashes[1:]
    pairs = np.where(doubled, np.uint64(0), hashes[:-1] * ODD + hashes[1:])[same] if len(owner) else hashes
    counts = np.bincount(owner[1:][same], minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
    yield 3, _slot(pairs * ODD + np.uint64(1)), np.concatenate([[0], np.cumsum(counts)])


def pieces(text: bytes, size: int) -> Iterator[tuple[bytes, bytes]]:
    """(context, piece) in turn: the context is the last word of what came before and up to three bytes of the blanks after it, or
    the last three bytes if these are more.

    The n-grams of a text are those of each context and piece together, less those of the contexts alone.
    """
    start, context = 0, b""
    while start < len(text):
        end = min(start + size, len(text))
        if end < len(text):
            space = SPACE.search(text, end, end + size)
            end = space.start() if space else end + size
        piece = text[start:end]
        yield context, piece
        tail = context + piece
        bare = tail.rstrip(BLANK)
        word = max(bare.rfind(bytes([b])) for b in BLANK) + 1
        if len(tail) - word > 3:
            context = bare[max(word, len(bare) - size):] + tail[max(len(bare), len(tail) - 3):]
        else:
            context = tail[-3:]
        start = end


@dataclass(frozen=True)
class NgramModel:
    """Weights by family and bucket, a bias, and the calibration of the logit."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def _sums(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Summed weights and numbers of each text's n-grams, by family."""
        found, counts = np.zeros((len(FAMILIES), len(texts))), np.zeros((len(FAMILIES), len(texts)))
        for family, buckets, starts in ngrams(texts):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[family][buckets], dtype=np.float64)])
            found[family], counts[family] = np.diff(sums[starts]), np.diff(starts)
        return found, counts

    def _long_sums(self, text: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long text, piece by piece."""
        found, counts = np.zeros(len(FAMILIES)), np.zeros(len(FAMILIES))
        for context, piece in pieces(text, size):
            for sign, part in ((1, context + piece), (-1, context)):
                # cut bytes need not be whole characters; n-grams only look at bytes
                sums, seen = self._sums(pa.array([part], pa.binary()).view(pa.string()))
                found, counts = found + sign * sums[:, 0], counts + sign * seen[:, 0]
        return found, counts

    def raw(self, texts: pa.Array, piece: int = PIECE) -> np.ndarray:
        """Uncalibrated logits."""
        texts = texts.cast(pa.string())
        long = np.flatnonzero(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False) > piece)
        short = texts
        if len(long):
            short = pa.compute.if_else(pa.array(np.isin(np.arange(len(texts)), long)), pa.scalar("", pa.string()), texts)
        found, counts = self._sums(short)
        for i in long.tolist():
            found[:, i], counts[:, i] = self._long_sums(texts[i].as_buffer().to_pybytes(), piece)
        return self.bias + (GAIN * found / (counts + SMOOTH)).sum(0)

    def probability(self, texts: pa.Array) -> np.ndarray:
        """Calibrated probability of the good class for each text; a null or empty text has that of the bias alone."""
        return sigmoid(self.slope * self.raw(texts) + self.offset)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bounds: FitBounds) -> pa.Table:
    """(text, good, n): at most ``per_class`` rows of each class by a hash of doc_id; n is the number of the class."""
    sound = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("good"))
    counts = {r["good"]: r["count"] for r in sound.groupBy("good").count().collect()}
    # only keys with small hashes are ranked: about twice what is taken, however many rows a class has
    share = F.lit(0.0)
    for good, count in counts.items():
        share = F.when(F.col("good") == good, min(1.0, (2 * bounds.per_class + SPARE) / count)).otherwise(share)
    hashed = F.xxhash64("doc_id")
    low = sound.where(F.shiftrightunsigned(hashed, 11) < share * (1 << 53))
    by_hash = Window.partitionBy("good").orderBy(F.shiftrightunsigned(hashed, 11), "doc_id")
    chosen = low.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= bounds.per_class)
    short = docs.where(F.length("text") <= bounds.longest).select("doc_id", "text")
    # the chosen rows are bounded by two classes times per_class, and each brings one text
    met = short.join(F.broadcast(chosen.select("doc_id", "good")), "doc_id")
    found = met.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("good").alias("good")).orderBy("doc_id").toArrow()
    n = pa.array([counts[g] for g in found.column("good").to_pylist()], pa.int64())
    return found.append_column("n", n)


def _sparse(sample: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the sample's features, made in slices."""
    cells, at = [], 0
    for part in slices(iter(sample.select(["text"]).to_batches()), "text", FIT_BYTES):
        for family, buckets, starts in ngrams(part.column("text")):
            counts = np.diff(starts)
            owner = np.repeat(np.arange(len(counts)), counts)
            keys, seen = np.unique(owner << BITS | buckets, return_counts=True)
            rows = keys >> BITS
            cells.append((
                (rows + at).astype(np.int32),
                ((keys & (1 << BITS) - 1) + (family << BITS)).astype(np.int32),
                (GAIN * seen / (counts[rows] + SMOOTH)).astype(np.float32),
            ))
        at += part.num_rows
    return tuple(np.concatenate(column) for column in zip(*cells))


def fit(sample: pa.Table, bounds: FitBounds = FitBounds()) -> NgramModel:
    """Fit and calibrate; with fewer than two classes the model is constant at the one class (good if there is none)."""
    good = np.array(sample.column("good").to_pylist(), np.float64)
    if len(set(good)) < 2:
        only = good[0] if len(good) else 1.0
        return NgramModel(np.zeros((len(FAMILIES), 1 << BITS), np.float32), 0.0, 1.0, 8.0 if only else -8.0)
    row, column, value = _sparse(sample)
    # every fifth row in order of its key is held out for calibration
    held = np.arange(len(good)) % 5 == 4
    if len(set(good[held])) < 2 or len(set(good[~held])) < 2:
        held[:] = False
    used = ~held[row]
    order = np.argsort(row[used], kind="stable")
    r, c, v = row[used][order], column[used][order], value[used][order]
    del row, column, value, used, order
    balance = np.where(good == 1, 0.5 / max(1, (good[~held] == 1).sum()), 0.5 / max(1, (good[~held] == 0).sum()))
    balance[held] = 0
    size = len(FAMILIES) << BITS
    w, b = np.zeros(size), 0.0
    m1, m2, n1, n2 = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, bounds.rounds + 1):  # full-batch Adam
        logits = np.bincount(r, w[c] * v, len(good)) + b
        error = balance * (sigmoid(logits) - good)
        slope, lift = np.bincount(c, v * error[r], size) + bounds.penalty * w, error.sum()
        m1, m2 = 0.9 * m1 + 0.1 * slope, 0.99 * m2 + 0.01 * slope * slope
        n1, n2 = 0.9 * n1 + 0.1 * lift, 0.99 * n2 + 0.01 * lift * lift
        w -= 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        b -= 0.05 * (n1 / (1 - 0.9**step)) / (np.sqrt(n2 / (1 - 0.99**step)) + 1e-8)
    model = NgramModel(w.reshape(len(FAMILIES), -1).astype(np.float32), float(b), 1.0, 0.0)
    keep = held if held.any() else ~held
    share = np.array(sample.column("n").to_pylist(), np.float64)
    weight = np.where(good == 1, share / max(1, (good[keep] == 1).sum()), share / max(1, (good[keep] == 0).sum()))
    logits = np.concatenate([model.raw(part.column("text")) for part in slices(iter(sample.to_batches()), "text", FIT_BYTES)])
    # a little weight at the bias, in the classes' true shares: a text that says nothing is as good as the corpus
    share = np.array([weight[keep][good[keep] == g].sum() for g in (0, 1)]) / weight[keep].sum()
    logits = np.concatenate([logits[keep], [model.bias, model.bias]])
    weight = np.concatenate([weight[keep] / weight[keep].sum(), PRIOR_WEIGHT * share])
    slope, offset = calibrate(logits, np.concatenate([good[keep], [0.0, 1.0]]), weight)
    return NgramModel(model.weights, model.bias, slope, offset)


def calibrate(logits: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic fit, slightly penalised towards slope 1 so that separable data end."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * logits + b)
        e, h = weight * (p - good), weight * p * (1 - p) + 1e-9
        gradient = np.array([(e * logits).sum() + 1e-2 * (a - 1), e.sum()])
        hessian = np.array([[(h * logits * logits).sum() + 1e-2, (h * logits).sum()], [(h * logits).sum(), h.sum() + 1e-6]])
        change = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        a, b = a - change[0], b - change[1]
        if np.abs(change).max() < 1e-9:
            break
    return float(max(a, 1e-3)), float(b)
