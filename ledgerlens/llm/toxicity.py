"""Toxicity by weak supervision.

1. A lexicon of words and word beginnings is mined from a bounded, class-balanced sample of labelled rows. Each
   entry gives voters: "occurs", "occurs twice or more", and so on, which vote for toxic or abstain.
2. A generative label model learns each voter's rate under either class by expectation maximisation, starting from
   the votes alone, and the correlations between voters that the classes leave unexplained; correlated voters count
   once.
3. A linear classifier over hashed words and word beginnings learns the posterior labels on two thirds of the sample,
   and its scores are calibrated on the labels of the other third. Every text is scored by it, whole.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches
from .hashed_features import (
    LogisticModel,
    Rows,
    calibrate,
    collect_vectors,
    fit_logistic,
    lowered,
    prior_weights,
    sample_labelled,
    sparse_word_features,
)
from .rows import Carried
from .textkernel import utf8

BITS = 18
PREFIXES = (3, 4, 5, 6)
LEVELS = (1, 2, 4)
#: About so many rows of either label are learned from.
PER_CLASS = 2500
#: Entries of the mined lexicon.
LEXICON = 300
MIN_PRECISION = 0.97
MIN_SHARE = 0.02
#: Words of a text are few against its length; counts per so many words are what the classifier sees.
RATE_WORDS = 50.0
#: A word's rate counts up to this, so that one word said over and over does not decide alone.
MOST_RATE = 2.5
#: Standard errors between the classes from which a slot counts.
TELLING = 6.0
_WORD = re.compile(r"\w+")
Pattern = tuple[str, str, int]


def pattern_counts(text: str) -> Counter:
    """Occurrences of each ``(kind, words or beginning)`` in a lower-cased text."""
    words = Counter(_WORD.findall(text.lower()))
    found: Counter = Counter()
    for word, n in words.items():
        found[("word", word)] += n
        for size in PREFIXES:
            if len(word) > size:
                found[("begins", word[:size])] += n
    return found


def votes_of(counts: Counter, lexicon: list[Pattern]) -> list[int]:
    return [1 if counts[(kind, text)] >= level else 0 for kind, text, level in lexicon]


# mining ------------------------------------------------------------------------------------------------------


def _pattern_rows(batches):
    """A task's document counts per pattern and class."""
    total: dict[tuple, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            for (kind, value), n in pattern_counts(text or "").items():
                for level in LEVELS:
                    if n >= level:
                        total.setdefault((kind, value, level), [0, 0])[label] += 1
    keys = list(total)
    for start in range(0, len(keys), 50_000):
        part = keys[start : start + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in part]) for i in range(2)]
            + [pa.array([k[2] for k in part], pa.int32())]
            + [pa.array([total[k][i] for k in part], pa.int64()) for i in (0, 1)],
            names=["kind", "value", "level", "clean", "toxic"],
        )


def mine_lexicon(sample: DataFrame, size: int = LEXICON, min_precision: float = MIN_PRECISION) -> list[Pattern]:
    """The patterns of toxic rows with the most of them, among those precise enough at even class shares."""
    counted = sample.select("text", "label").mapInArrow(
        _pattern_rows, "kind string, value string, level int, clean long, toxic long"
    )
    summed = counted.groupBy("kind", "value", "level").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    clean, toxic = (F.col(c) / max(1, sizes.get(i, 0)) for i, c in enumerate(("clean", "toxic")))
    least = 1.0 / max(1, sizes.get(0, 0))
    precise = summed.where((F.col("toxic") >= 4) & (toxic >= MIN_SHARE) & (toxic / (toxic + clean + least) >= min_precision))
    best = precise.orderBy(F.desc("toxic"), "clean", "kind", "value", "level").limit(size).collect()
    return [(r["kind"], r["value"], r["level"]) for r in best]


# label model -------------------------------------------------------------------------------------------------


class LabelModel:
    """Class-conditional vote rates of the voters, and the groups of voters that say the same.

    A voter votes for toxic or abstains; one more votes for clean where all others abstain. Voters whose votes
    stay correlated given the class form a group, which counts once, by the strongest vote cast in it.
    """

    def __init__(self, votes: np.ndarray, start: np.ndarray, rounds: int = 2, correlated: float = 0.3):
        """``votes``: rows x voters, 0 or 1; ``start``: what the rows are first taken for, 0 to 1."""
        self.prior = float(np.clip(start.mean(), 1e-3, 1 - 1e-3))
        posterior = np.clip(start, 0.01, 0.99)
        self._learn(votes, posterior)
        self.group = self._groups(votes, posterior, correlated)
        for _ in range(rounds):
            posterior = self.posterior(votes)
            self._learn(votes, posterior)

    def _learn(self, votes: np.ndarray, posterior: np.ndarray) -> None:
        silent = ~votes.any(axis=1)
        ones, zeros = posterior.sum() + 1.0, (1 - posterior).sum() + 1.0
        self.clean = ((1 - posterior) @ votes + 0.5) / zeros
        # A voter is never believed to be worse than chance.
        self.toxic = np.maximum((posterior @ votes + 0.5) / ones, self.clean)
        self.silence = np.log((posterior @ silent + 0.5) / ones) - np.log(((1 - posterior) @ silent + 0.5) / zeros)

    def _groups(self, votes: np.ndarray, posterior: np.ndarray, least: float) -> np.ndarray:
        """Each voter joins the first voter, by number of votes, that it is correlated with given the class."""
        rest = votes - np.outer(posterior, self.toxic)
        rest -= np.outer(1 - posterior, self.clean)
        scale = np.sqrt((rest**2).sum(axis=0)) + 1e-9
        self.correlation = (rest.T @ rest) / np.outer(scale, scale)
        group = np.full(votes.shape[1], -1)
        for voter in np.argsort(-votes.sum(axis=0), kind="stable"):
            if group[voter] < 0:
                group[(group < 0) & (self.correlation[voter] >= least)] = voter
                group[voter] = voter
        return group

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        ratio = np.log(self.toxic / self.clean)
        cast = np.zeros(len(votes))
        for leader in np.unique(self.group):
            members = self.group == leader
            cast += (votes[:, members] * ratio[members]).max(axis=1)
        z = np.log(self.prior / (1 - self.prior)) + np.where(votes.any(axis=1), cast, min(self.silence, 0.0))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


# classifier --------------------------------------------------------------------------------------------------


def vector(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of words and beginnings per ``RATE_WORDS`` words, at most ``MOST_RATE``."""
    clean = " ".join(_WORD.findall(lowered(text).decode("utf-8"))).encode("utf-8")
    index, counts, words = sparse_word_features(clean, BITS, prefixes=PREFIXES)
    return index, np.minimum(MOST_RATE, counts * (RATE_WORDS / max(words, 8)))


def _sampled_votes(sample: DataFrame, lexicon: list[Pattern]) -> dict[int, list[int]]:
    def run(batches):
        for batch in batches:
            rows = [votes_of(pattern_counts(t or ""), lexicon) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([bytes(r) for r in rows], pa.binary())], names=["doc_id", "votes"]
            )

    found = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, votes binary")
    return {r["doc_id"]: np.frombuffer(r["votes"], np.uint8) for r in found.collect()}


def train_toxicity(documents: DataFrame, labels: DataFrame, allowed: Column, per_class: int = PER_CLASS) -> LogisticModel:
    """Learns from allowed labelled rows only; ``allowed`` is an expression over ``labels``.

    Without toxic labels (or any) every text scores 0.
    """
    chosen = sample_labelled(labels, "toxic", allowed, per_class, "toxicity")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Some thousands of ids and texts, bounded by per_class.
    spread = 4 * documents.sparkSession.sparkContext.defaultParallelism
    sample = texts.join(F.broadcast(chosen), "doc_id").repartition(spread).persist()
    try:
        lexicon = mine_lexicon(sample)
        votes_by_id = _sampled_votes(sample, lexicon)
        found = collect_vectors(sample, vector)
    finally:
        sample.unpersist()
    labels_ = np.array([r["label"] for r in found], dtype=float)
    if not lexicon or not labels_.any():
        return LogisticModel(np.zeros(1 << BITS), -500.0)
    target = _learned_labels(found, votes_by_id)
    told = _telling_slots([r["vector"] for r in found], target)
    kept = np.flatnonzero(told)
    for r in found:  # what does not tell is let go; the fit has the other slots only
        i, v = r["vector"]
        r["vector"] = np.searchsorted(kept, i[told[i]]), v[told[i]]
    rows = lambda keep: Rows([r["vector"] for r, k in zip(found, keep) if k], len(kept))
    fold = np.arange(len(found)) % 3 != 0
    classifier = fit_logistic(rows(fold), target[fold], np.ones(int(fold.sum())), l2=1e-3)
    model = calibrate(classifier, rows(~fold), labels_[~fold], prior_weights(found)[~fold])
    weights = np.zeros(1 << BITS)
    weights[kept] = model.weights
    return LogisticModel(weights, model.bias, model.scale, model.shift)


def _learned_labels(found: list[dict], votes_by_id: dict[int, np.ndarray]) -> np.ndarray:
    votes = np.array([votes_by_id[r["doc_id"]] for r in found], dtype=float)
    return LabelModel(votes, votes.any(axis=1).astype(float)).posterior(votes)


def _telling_slots(vectors: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Slots that occur in far more or fewer rows of one class than chance explains; the others get no weight."""
    toxic, every = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for (index, _), p in zip(vectors, target):
        toxic[index] += p
        every[index] += 1
    n1 = max(target.sum(), 1.0)
    n0 = max(len(target) - n1, 1.0)
    share = np.clip(every / len(target), 1e-9, 1 - 1e-9)
    z = (toxic / n1 - (every - toxic) / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    return np.abs(z) >= TELLING


def _score(model, columns: list[str]):
    def run(batches):
        learned = model.value
        for batch in batches:
            scores = [learned.score(*vector(t)) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(scores, pa.float64())], names=[*columns, "score"]
            )

    return run


def score_texts(documents: DataFrame, model: LogisticModel, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row with its columns in ``row`` and ``score`` (0 to 1) beside it.

    Null and empty texts score as a text without words. Repeated rows are answered each, an empty table gives
    an empty result.
    """
    bound_batches(documents.sparkSession)
    carried = Carried(documents, text_col, carry)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return carried.restored(carried.frame.mapInArrow(_score(shared, carried.columns), f"{carried.schema}, score double"))


def score_toxicity(documents: DataFrame, learn_from: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Scores with a model that never sees labels of rows whose crc32 of the id, as text, is 2 modulo 4."""
    allowed = F.crc32(F.col("doc_id").cast("long").cast("string")) % 4 != 2
    return score_texts(documents, train_toxicity(learn_from, labels, allowed), carry=carry)
