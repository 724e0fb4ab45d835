"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

An Aho-Corasick automaton yields, at each position, the vocabulary pieces that end there, longest first. The
dynamic program keeps the best score and the number of pieces of the best path, no back pointers. Ties follow
the exact tokenizer: the path whose last piece starts earliest stays, as a later one must be strictly better.
A character without a single-character piece costs the lowest score minus 10 and becomes its UTF-8 bytes.

Words (a space and what follows up to the next one) are encoded apart, so a count is kept per distinct word.
"""

from __future__ import annotations

import math
from pathlib import Path

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .rows import row_type, rows_and_text

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words remembered in each Python worker; longer words are counted anew each time.
CACHED_WORDS = 500_000
CACHED_LENGTH = 64


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Normal pieces and scores of a SentencePiece model file."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(Path(path).read_bytes())
    return [(p.piece, p.score) for p in model.pieces if p.type == pb.ModelProto.SentencePiece.NORMAL]


class _Known(dict):
    """Counts by word; one that is asked for and not there is counted."""

    def __init__(self, count):
        self._count = count

    def __missing__(self, word: str) -> int:
        n = self._count(SPACE + word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = n
        return n


class UnigramCounter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        self._automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self._automaton.add_word(piece, (len(piece), score))
        self._automaton.make_automaton()
        self._unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self._longest = max(len(piece) for piece, _ in vocabulary)
        self._single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self._words = _Known(self._count_word)

    def count(self, text: str) -> int:
        """Pieces of the best segmentation of a whole text; an empty text has none."""
        if not text:
            return 0
        if SPACE in text:
            text = text.replace(SPACE, " ")
        return sum(map(self._words.__getitem__, text[text.startswith(" ") :].split(" ")))

    def _count_word(self, word: str) -> int:
        if len(word) > 2 * CACHED_LENGTH or not self._single.issuperset(word):
            return self._count_any(word)
        # Every character is a piece, so each position is reached, and matches come by end, longest first.
        score, pieces = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
        for end, (length, gain) in self._automaton.iter(word):
            end += 1
            gain += score[end - length]
            if gain > score[end]:
                score[end] = gain
                pieces[end] = pieces[end - length] + 1
        return pieces[-1]

    def _count_any(self, word: str) -> int:
        """Only the last ``longest`` positions are kept, so a word of any length needs constant memory."""
        keep = self._longest + 1
        score, pieces = [0.0] * keep, [0] * keep
        done = 0

        def unknown_up_to(end: int) -> None:
            nonlocal done
            while done < end:
                self._step(word, done, score, pieces, keep, ())
                done += 1

        matches: list[tuple[int, float]] = []
        at = -1
        for end, match in self._automaton.iter(word):
            if end != at:
                if at >= 0:
                    unknown_up_to(at)
                    self._step(word, at, score, pieces, keep, matches)
                    done = at + 1
                at, matches = end, []
            matches.append(match)
        if at >= 0:
            unknown_up_to(at)
            self._step(word, at, score, pieces, keep, matches)
            done = at + 1
        unknown_up_to(len(word))
        return pieces[len(word) % keep]

    def _step(self, word, last, score, pieces, keep, matches) -> None:
        best, count = None, 0
        for length, gain in matches:
            start = last + 1 - length
            if best is None or score[start % keep] + gain > best:
                best, count = score[start % keep] + gain, pieces[start % keep] + 1
        if word[last] not in self._single:
            alone = score[last % keep] + self._unknown
            if best is None or alone > best:
                best, count = alone, pieces[last % keep] + len(word[last].encode("utf-8", "surrogatepass"))
        score[(last + 1) % keep], pieces[(last + 1) % keep] = best, count


_WORKER: dict[int, UnigramCounter] = {}


def _counts(vocabulary, key: int):
    def run(batches):
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = UnigramCounter(vocabulary.value)
        counter = _WORKER[key]
        for batch in batches:
            n = [counter.count(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n, pa.int64())], names=["row", "n_tokens"]
            )

    return run


def count_tokens(
    documents: DataFrame, vocabulary: list[tuple[str, float]], text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Every row with its columns in ``row`` and ``n_tokens`` beside it; null and empty texts have none.

    ``vocabulary`` is a public tokenizer's list of pieces and scores (tens of thousands; broadcast); an
    empty one is refused. Repeated rows are counted each, an empty table gives an empty result.
    """
    if not vocabulary:
        raise ValueError("the vocabulary has no pieces")
    spark = documents.sparkSession
    pieces = spark.sparkContext.broadcast(vocabulary)
    df = rows_and_text(documents, text_col, carry)
    return df.mapInArrow(_counts(pieces, id(pieces)), f"row {row_type(df)}, n_tokens long")
