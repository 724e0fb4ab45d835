"""Hashed word and character n-gram counts, and a logistic fit on a bounded sample of them."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from .textkernel import IN_WORD, Hashes, _cut, mix, spans, windows

#: One salt per kind of feature.
WORD, WORD_PAIR, CHARS, PREFIX = (np.uint64(x) for x in (11, 23, 1000, 2000))


def pieces(text: bytes):
    """A text in pieces of bounded size; only words of over a million bytes are split, and count as several."""
    start = 0
    while start < len(text):
        end = _cut(text, start, IN_WORD)
        yield text[start:end]
        start = end


def characters(codes: np.ndarray) -> np.ndarray:
    """Where code points begin, and the end."""
    return np.append(np.flatnonzero((codes & 0xC0) != 0x80), len(codes))


def char_grams(h: Hashes, at: np.ndarray, n: int) -> np.ndarray:
    return h.of(at[:-n], at[n:]) if len(at) > n else np.empty(0, np.uint64)


def word_prefixes(h: Hashes, at: np.ndarray, s: np.ndarray, e: np.ndarray, n: int) -> np.ndarray:
    """The first n characters of words that are longer."""
    end = at[np.minimum(np.searchsorted(at, s) + n, len(at) - 1)]
    longer = end < e
    return h.of(s[longer], end[longer])


def slots(hashes: np.ndarray, kind: np.uint64, bits: int) -> np.ndarray:
    return (mix(hashes + kind) >> np.uint64(64 - bits)).astype(np.int64)


class LogisticModel:
    """``sigmoid(scale * (weights . x + bias) + shift)``; x is what ``vector`` makes of a text."""

    def __init__(self, weights: np.ndarray, bias: float, scale: float = 1.0, shift: float = 0.0):
        self.weights, self.bias, self.scale, self.shift = weights.astype(np.float32), bias, scale, shift

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        z = self.scale * (float(self.weights[index] @ value) + self.bias) + self.shift
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


class Rows:
    """Sparse rows of a bounded sample."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], size: int):
        self.size = size
        self.index = np.concatenate([i for i, _ in vectors] or [np.empty(0, np.int64)]).astype(np.int64)
        self.value = np.concatenate([v for _, v in vectors] or [np.empty(0, np.float32)]).astype(np.float64)
        self.owner = np.repeat(np.arange(len(vectors)), [len(i) for i, _ in vectors])
        self.count = len(vectors)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, self.value * weights[self.index], minlength=self.count)

    def back(self, residual: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, self.value * residual[self.owner], minlength=self.size)


def fit_logistic(rows: Rows, target: np.ndarray, weight: np.ndarray, l2: float, rounds: int = 60) -> LogisticModel:
    """Weights for soft targets in [0, 1] by limited-memory BFGS; the bias is not penalised."""

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = rows.times(w[:-1]) + w[-1]
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
        value = np.sum(weight * (np.logaddexp(0, z) - target * z)) / total + l2 * (w[:-1] @ w[:-1]) / 2
        residual = weight * (p - target) / total
        return value, np.append(rows.back(residual) + l2 * w[:-1], residual.sum())

    total = max(weight.sum(), 1e-9)
    w = np.zeros(rows.size + 1)
    value, slope = loss(w)
    history: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        direction = slope.copy()
        used = []
        for s, y, r in reversed(history):
            a = r * (s @ direction)
            used.append(a)
            direction -= a * y
        if history:
            s, y, r = history[-1]
            direction /= r * (y @ y)
        for (s, y, r), a in zip(history, reversed(used)):
            direction += s * (a - r * (y @ direction))
        step, descent = 1.0, slope @ direction
        while step > 1e-6:
            new_value, new_slope = loss(w - step * direction)
            if new_value <= value - 1e-4 * step * descent:
                break
            step /= 2
        else:
            break
        s, y = -step * direction, new_slope - slope
        if s @ y > 1e-12:
            history = [*history[-7:], (s, y, 1.0 / (s @ y))]
        done = value - new_value < 1e-7 * max(1.0, value)
        w, value, slope = w + s, new_value, new_slope
        if done:
            break
    return LogisticModel(w[:-1], float(w[-1]))


def calibrate(model: LogisticModel, rows: Rows, labels: np.ndarray, weight: np.ndarray) -> LogisticModel:
    """Platt scaling: a one-dimensional logistic fit of the labels on the model's raw scores."""
    raw = rows.times(model.weights.astype(np.float64)) + model.bias
    one = Rows([(np.zeros(1, np.int64), np.array([z])) for z in raw], 1)
    fitted = fit_logistic(one, labels, weight, l2=1e-3)
    return LogisticModel(model.weights, model.bias, float(fitted.weights[0]), fitted.bias)


def sample_labelled(labels: DataFrame, label: str, allowed: Column, per_class: int, seed: str) -> DataFrame:
    """``(doc_id, label)``, about ``per_class`` ids of either label, chosen by a digest of the id.

    Ids with contradicting labels count as 1; null ids and labels are left out.
    """
    own = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & allowed)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    sizes = dict.fromkeys((0, 1), 0) | {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, F.lit(per_class / max(1, sizes[1]))).otherwise(F.lit(per_class / max(1, sizes[0])))
    return own.where(uniform(F.lit(seed), F.col("doc_id")) < share).withColumn(
        "of_class", F.when(F.col("label") == 1, F.lit(sizes[1])).otherwise(F.lit(sizes[0]))
    )


def collect_vectors(sampled: DataFrame, vector) -> list[dict]:
    """The sample's vectors (bounded by the sample): doc_id, label, of_class, index, value."""

    def run(batches):
        for batch in batches:
            for text, *rest in zip(*[batch.column(c).to_pylist() for c in ("text", "doc_id", "label", "of_class")]):
                index, value = vector((text or "").encode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.int64()) for x in rest]
                    + [pa.array([index.astype(np.int32).tobytes()]), pa.array([value.astype(np.float32).tobytes()])],
                    names=["doc_id", "label", "of_class", "index", "value"],
                )

    rows = sampled.select("text", F.col("doc_id").cast("long"), F.col("label").cast("long"), F.col("of_class").cast("long"))
    # As Arrow, whose buffers the vectors look into: neither the driver's JVM nor its Python makes rows of them.
    found = rows.mapInArrow(run, "doc_id long, label long, of_class long, index binary, value binary").toArrow()
    of_row = zip(*[found.column(c).to_pylist() for c in ("doc_id", "label", "of_class")])
    views = [(np.frombuffer(i.as_buffer(), np.int32), np.frombuffer(v.as_buffer(), np.float32)) for i, v in zip(found["index"], found["value"])]
    vectors = [
        {"doc_id": doc_id, "label": label, "of_class": of_class, "vector": view}
        for (doc_id, label, of_class), view in zip(of_row, views)
    ]
    times = Counter(r["doc_id"] for r in vectors)
    return sorted(vectors, key=lambda r: (r["doc_id"], r["vector"][0].tobytes() if times[r["doc_id"]] > 1 else b""))


def prior_weights(found: list[dict]) -> np.ndarray:
    """Weights that restore the class shares the sample evened out."""
    labels = np.array([r["label"] for r in found])
    of_class = np.array([r["of_class"] for r in found], dtype=float)
    taken = np.where(labels == 1, max(1, (labels == 1).sum()), max(1, (labels == 0).sum()))
    weight = of_class / taken
    return weight / weight.mean() if len(weight) else weight


def word_features(text: bytes, bits: int, prefixes: tuple[int, ...] = (), pairs: bool = False, grams: tuple[int, ...] = ()):
    """Counts by slot of a lower-cased text: words, prefixes, word pairs, character n-grams; and the word count."""
    counts, words = np.zeros(1 << bits, dtype=np.float32), 0
    for piece in pieces(text):
        h = Hashes(piece)
        s, e = spans(h.codes, IN_WORD)
        at = characters(h.codes)
        w = h.of(s, e)
        found = [slots(w, WORD, bits)]
        if pairs:
            found.append(slots(windows(w, 2), WORD_PAIR, bits))
        found += [slots(word_prefixes(h, at, s, e, n), PREFIX + np.uint64(n), bits) for n in prefixes]
        found += [slots(char_grams(h, at, n), CHARS + np.uint64(n), bits) for n in grams]
        counts += np.bincount(np.concatenate(found), minlength=1 << bits).astype(np.float32)
        words += len(s)
    return counts, words


def sparse_word_features(text: bytes, bits: int, prefixes: tuple[int, ...] = ()):
    """Slots of words and prefixes of a lower-cased text, ascending, their counts, and the word count."""
    index, counts, words = np.empty(0, np.int64), np.empty(0, np.float32), 0
    for piece in pieces(text):
        h = Hashes(piece)
        s, e = spans(h.codes, IN_WORD)
        at = characters(h.codes)
        found = [slots(h.of(s, e), WORD, bits), *[slots(word_prefixes(h, at, s, e, n), PREFIX + np.uint64(n), bits) for n in prefixes]]
        own, times = np.unique(np.concatenate(found), return_counts=True)
        if words:
            own, owner = np.unique(np.concatenate([index, own]), return_inverse=True)
            times = np.bincount(owner, np.concatenate([counts, times]))
        index, counts, words = own, times.astype(np.float32), words + len(s)
    return index, counts, words


def lowered(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").lower().encode("utf-8")
