"""Quality rules: base counts, and a calibrated logistic regression over hashed n-grams.

The classifier learns from a bounded, class-balanced sample of labelled rows (``PER_CLASS`` of each label), half
of it for the weights, half for the calibration; all texts are scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashed_features import (
    Rows,
    calibrate,
    collect_vectors,
    fit_logistic,
    lowered,
    prior_weights,
    sample_labelled,
    word_features,
)
from .rows import row_type, rows_and_text
from .textkernel import documents_words, utf8, windows

BITS = 16
#: About so many rows of either label are learned from.
PER_CLASS = 2000
#: Probability of good quality from which a document is kept.
KEEP_FROM = 0.3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def vector(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of the counts of words, word pairs and character trigrams, of length one."""
    counts, _ = word_features(lowered(text), BITS, pairs=True, grams=(3,))
    index = np.flatnonzero(counts)
    value = np.sqrt(counts[index])
    return index, value / max(1e-9, float(np.sqrt(value @ value)))


def _repeat_words(h: np.ndarray) -> int:
    """Words inside runs of three words that occur twice or more."""
    runs = windows(h, 3)
    if not len(runs):
        return 0
    _, where, times = np.unique(runs, return_inverse=True, return_counts=True)
    cover = np.zeros(len(h) + 1, dtype=np.int64)
    starts = np.flatnonzero(times[where] > 1)
    cover[starts] += 1
    np.add.at(cover, starts + 3, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def _dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, repeated = set(), 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line.strip(b" \t\n\v\f\r"):
                repeated += line in seen
                seen.add(line)
    return repeated


def base_counts(texts: list[bytes]):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text, in order."""
    for lo, data, h, s, e, begins, at in documents_words(texts):
        codes = np.frombuffer(data, dtype=np.uint8)
        points = np.zeros(len(codes) + 1, dtype=np.int64)
        np.cumsum((codes & 0xC0) != 0x80, out=points[1:])
        symbols = np.zeros(len(codes) + 1, dtype=np.int64)
        np.cumsum(_SYMBOL[codes], out=symbols[1:])
        sizes = np.zeros(len(s) + 1, dtype=np.int64)
        np.cumsum(points[e] - points[s], out=sizes[1:])
        for i in range(len(begins) - 1):
            a, b = at[i], at[i + 1]
            start, end = begins[i], begins[i + 1] - 1
            yield (
                int(b - a),
                int(sizes[b] - sizes[a]),
                int(symbols[end] - symbols[start]),
                _dup_lines(texts[lo + i]),
                _repeat_words(h[a:b]),
            )


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judge(model, keep_from: float):
    def run(batches):
        learned = model.value
        for batch in batches:
            texts = utf8(batch.column("text"))
            counts = [pa.array(c, pa.int64()) for c in zip(*base_counts(texts))] or [pa.nulls(0, pa.int64())] * 5
            score = [learned.score(*vector(t)) for t in texts]
            failed = [
                n < MIN_WORDS or 100 * r > MAX_REPEAT_PERCENT * n
                for n, r in zip(counts[0].to_pylist(), counts[4].to_pylist())
            ]
            kept = [not f and p >= keep_from for f, p in zip(failed, score)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *counts, pa.array(failed, pa.bool_()), pa.array(score, pa.float64()), pa.array(kept, pa.bool_())],
                names=["row", *_COUNTS, "base_failed", "score", "kept"],
            )

    return run


def train_quality(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS):
    """The calibrated model; without labels of both kinds every text scores 1 or 0, whichever label there is."""
    chosen = sample_labelled(labels, "quality", F.lit(True), per_class, "quality")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Some thousands of ids, bounded by per_class.
    found = collect_vectors(texts.join(F.broadcast(chosen), "doc_id"), vector)
    labels_ = np.array([r["label"] for r in found], dtype=float)
    weight = prior_weights(found)
    rows = lambda keep: Rows([r["vector"] for r, k in zip(found, keep) if k], 1 << BITS)
    fold = np.arange(len(found)) % 2 == 0
    model = fit_logistic(rows(fold), labels_[fold], weight[fold], l2=1e-5)
    if len(set(labels_)) < 2:
        model.bias = 500.0 if len(labels_) == 0 or labels_[0] == 1 else -500.0
        model.weights[:] = 0
        return model
    return calibrate(model, rows(~fold), labels_[~fold], weight[~fold])


def quality_rules(
    documents: DataFrame, model, text_col: str = "text", keep_from: float = KEEP_FROM, carry: list[str] | None = None
) -> DataFrame:
    """Every row with its columns in ``row``, the base counts, ``base_failed``, ``score`` and ``kept`` beside it.

    A null or empty text has no words and fails. Repeated rows are answered each, an empty table gives an empty
    result. ``kept`` is false if the base failed, else ``score >= keep_from``.
    """
    df = rows_and_text(documents, text_col, carry)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"{c} long" for c in _COUNTS)
    return df.mapInArrow(
        _judge(shared, keep_from), f"row {row_type(df)}, {kinds}, base_failed boolean, score double, kept boolean"
    )
