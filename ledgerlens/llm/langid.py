"""Language identification by multinomial naive Bayes over hashed character n-grams.

Tasks count n-grams per language into tables of fixed size, which are summed by language; the matrix of log
probabilities (2^16 numbers a language) is broadcast and texts are scored in numpy.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashed_features import CHARS, char_grams, characters, lowered, pieces, slots
from .rows import row_type, rows_and_text
from .textkernel import Hashes

BITS = 16
GRAMS = (1, 2, 3)
UNDETERMINED = "und"
#: Languages of one model; the matrix takes 256 KB for each.
MAX_LANGUAGES = 400
#: Scores are softened as if a text had at most so many n-grams, since they don't occur independently.
EVIDENCE = 60.0
_LETTER = re.compile(r"[^\W\d_]")


def gram_slots(text: bytes):
    for piece in pieces(lowered(text)):
        h = Hashes(piece)
        at = characters(h.codes)
        yield np.concatenate([slots(char_grams(h, at, n), CHARS + np.uint64(n), BITS) for n in GRAMS])


def _count(batches):
    """This task's counts: one table per language, and the number of its documents."""
    tables: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            if not _LETTER.search(text):
                continue
            table = tables.setdefault(lang, np.zeros(1 << BITS, dtype=np.int64))
            docs[lang] = docs.get(lang, 0) + 1
            for found in gram_slots(text.encode("utf-8", "replace")):
                table += np.bincount(found, minlength=1 << BITS)
    yield from _tables(tables, docs)


def _tables(tables: dict[str, np.ndarray], docs: dict[str, int]):
    for lang, table in tables.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([docs[lang]], pa.int64()), pa.array([table.tobytes()])], names=["lang", "docs", "counts"]
        )


def _add(batches):
    tables: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for lang, n, blob in zip(*[batch.column(c).to_pylist() for c in ("lang", "docs", "counts")]):
            got = np.frombuffer(blob, dtype=np.int64)
            tables[lang] = tables[lang] + got if lang in tables else got
            docs[lang] = docs.get(lang, 0) + n
    yield from _tables(tables, docs)


class NaiveBayes:
    def __init__(self, counts: dict[str, tuple[int, np.ndarray]], smoothing: float = 0.5):
        self.languages = sorted(counts)
        total_docs = sum(n for n, _ in counts.values())
        self.prior = np.array([np.log(counts[x][0] / total_docs) for x in self.languages], dtype=np.float32)
        table = np.array([counts[x][1] for x in self.languages], dtype=np.float64).reshape(-1, 1 << BITS) + smoothing
        self.log_probability = np.log(table / table.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()

    def _evidence(self, found: np.ndarray) -> np.ndarray:
        """Summed log probabilities of n-grams; of many, by their counts, so memory stays bounded."""
        if len(found) <= 2000:
            return self.log_probability[found].sum(axis=0, dtype=np.float64)
        counts = np.bincount(found, minlength=1 << BITS)
        used = np.flatnonzero(counts)
        return counts[used].astype(np.float64) @ self.log_probability[used]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        total, grams = self.prior.astype(np.float64), 0
        for found in gram_slots(text.encode("utf-8", "replace")):
            total = total + self._evidence(found)
            grams += len(found)
        best = int(np.argmax(total))
        softened = (total - total[best]) * min(1.0, EVIDENCE / max(1, grams))
        return self.languages[best], float(1.0 / np.exp(softened).sum())


def train_languages(documents: DataFrame, allowed: Column, text_col: str = "text", lang_col: str = "lang") -> NaiveBayes:
    """Learns from all allowed rows with a letter and a language; ``allowed`` is an expression over the rows."""
    kinds = "lang string, docs long, counts binary"
    rows = documents.where(allowed & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    # Two steps, so that no task sums the tables of all others.
    parts = rows.mapInArrow(_count, kinds).withColumn("salt", F.spark_partition_id() % 64)
    parts = parts.repartition(64, "lang", "salt").drop("salt").mapInArrow(_add, kinds)
    summed = parts.repartition(16, "lang").mapInArrow(_add, kinds)
    found = summed.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return NaiveBayes({r["lang"]: (r["docs"], np.frombuffer(r["counts"], dtype=np.int64)) for r in found})


def _predict(model):
    def run(batches):
        learned = model.value
        for batch in batches:
            found = [learned.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    return run


def identify_languages(documents: DataFrame, model: NaiveBayes, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row with its columns in ``row``, ``lang_pred`` and ``score`` (0 to 1) beside it.

    A text that is null, empty or without a letter is ``und`` with score 0, as is every text if nothing was
    learned. Ties go to the first language by name. Repeated rows are answered each, an empty table gives an
    empty result.
    """
    df = rows_and_text(documents, text_col, carry)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return df.mapInArrow(_predict(shared), f"row {row_type(df)}, lang_pred string, score double")
