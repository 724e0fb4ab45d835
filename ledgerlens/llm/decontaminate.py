"""Benchmark decontamination: one Aho-Corasick automaton over all item windows, each text scanned once.

Normalising maps every byte to one byte (A-Z to a-z, separators to a space), so a word of the normal form is
the same byte range of the original and offsets need no table. The automaton holds whole windows between two
spaces; so a match begins and ends at word ends.
"""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .rows import row_type, rows_and_text
from .textkernel import PUNCTUATION, inside_table, spans, utf8

#: Pattern bytes of one automaton (about 100 MB of nodes); larger benchmarks take several passes.
PATTERN_BYTES = 2_000_000

_SEPARATOR = frozenset(PUNCTUATION - {*range(0x41, 0x5B)})
_NORMAL = bytes(32 if b in _SEPARATOR else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_IN_WORD = inside_table(_SEPARATOR)
_BUILT: dict[int, ahocorasick.Automaton] = {}


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def item_windows(text: bytes, width: int) -> list[bytes]:
    """All runs of ``width`` words, each between spaces; a shorter item is one run, one without words none."""
    words = normal_words(text)
    if not words:
        return []
    runs = range(max(1, len(words) - width + 1))
    return list(dict.fromkeys(b" " + b" ".join(words[i : i + width]) + b" " for i in runs))


def _blocks(benchmark: DataFrame, width: int, limit: int):
    """Windows with the items that hold them, in blocks of bounded size; one block is in memory at a time."""
    block: dict[bytes, list] = defaultdict(list)
    size = 0
    for row in benchmark.toLocalIterator():
        for window in item_windows((row["text"] or "").encode(), width):
            size += len(window) * (window not in block) + 16
            block[window].append(row["item_id"])
        if size > limit:
            yield dict(block)
            block, size = defaultdict(list), 0
    yield dict(block)


def _automaton(windows) -> ahocorasick.Automaton:
    """Built once in each Python worker."""
    if windows.id not in _BUILT:
        _BUILT.clear()
        automaton = ahocorasick.Automaton()
        for window, items in windows.value.items():
            automaton.add_word(window.decode("latin-1"), (window.count(b" ") - 1, items))
        if len(automaton):
            automaton.make_automaton()
        _BUILT[windows.id] = automaton
    return _BUILT[windows.id]


class _Windows:
    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast.id if hasattr(broadcast, "id") else id(broadcast)

    @property
    def value(self):
        return self.broadcast.value


def _squeezed(text: bytes) -> bytes:
    """The normal form with one space before, between and after the words."""
    codes = np.frombuffer(b" " + text.translate(_NORMAL) + b" ", dtype=np.uint8)
    blank = codes == 32
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return codes[keep].tobytes()


def _scan(automaton, text: bytes) -> tuple[int, np.ndarray, set]:
    """Number of words, indices of the hit words, items met."""
    squeezed = _squeezed(text)
    words = max(0, squeezed.count(b" ") - 1)
    if not words or not len(automaton):
        return words, np.empty(0, np.int64), set()
    ends, widths, items = [], [], set()
    for end, (width, owners) in automaton.iter(squeezed.decode("latin-1")):
        ends.append(end)
        widths.append(width)
        items.update(owners)
    if not ends:
        return words, np.empty(0, np.int64), items
    blanks = np.cumsum(np.frombuffer(squeezed, dtype=np.uint8) == 32)
    after = blanks[np.array(ends)] - 1
    cover = np.zeros(words + 1, dtype=np.int64)
    np.add.at(cover, after - np.array(widths), 1)
    np.add.at(cover, after, -1)
    return words, np.flatnonzero(np.cumsum(cover)[:-1] > 0), items


def _original_spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Code point ranges of runs of hit words in the original text."""
    starts, ends = spans(np.frombuffer(text, dtype=np.uint8), _IN_WORD)
    point = np.zeros(len(text) + 1, dtype=np.int64)
    np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80, out=point[1:])
    breaks = np.flatnonzero(np.diff(hit) > 1)
    first, last = np.concatenate(([hit[0]], hit[breaks + 1])), np.concatenate((hit[breaks], [hit[-1]]))
    return [{"start": int(a), "end": int(b)} for a, b in zip(point[starts[first]], point[ends[last]])]


_FOUND = "struct<n_words: bigint, hit: array<bigint>, item_ids: array<bigint>>"


def _pass(windows: _Windows, last: bool):
    out = pa.struct(
        [("n_words", pa.int64()), ("hit", pa.list_(pa.int64())), ("item_ids", pa.list_(pa.int64()))]
        + [("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
    )

    def run(batches):
        automaton = _automaton(windows)
        for batch in batches:
            before = batch.column("found").to_pylist()
            rows = []
            for text, earlier in zip(utf8(batch.column("text")), before):
                words, hit, items = _scan(automaton, text)
                if earlier:
                    hit = np.union1d(hit, np.array(earlier["hit"] or [], dtype=np.int64))
                    items |= set(earlier["item_ids"] or [])
                where = _original_spans(text, hit) if last and len(hit) else []
                rows.append({"n_words": words, "hit": hit.tolist(), "item_ids": [i for i in items if i is not None], "spans": where})
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(rows, out)], names=["row", "text", "found"]
            )

    return run


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = 10, pattern_bytes: int = PATTERN_BYTES,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row with its columns in ``row`` and ``n_words``, ``n_hit``, ``item_ids``, ``spans`` beside it.

    A word is hit if it lies inside any occurrence of ``width`` consecutive words of an item (of all its words,
    if it has fewer). ``item_ids`` are the items with such occurrences, ascending, ``spans`` the code point
    ranges of hit runs in the original text. Null and empty texts have no words; an item with a null id counts
    for hits and is not listed; repeated items and rows count as they stand. An empty benchmark hits nothing.
    The benchmark is taken in blocks of ``pattern_bytes``; each block is one scan of the texts.
    """
    spark = documents.sparkSession
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")
    )
    kind = _FOUND[:-1] + ", spans: array<struct<start: bigint, end: bigint>>>"
    df = rows_and_text(documents, text_col, carry)
    df = df.select("row", "text", F.lit(None).cast(kind).alias("found"))
    schema = f"row {row_type(df)}, text string, found {kind}"
    blocks = list_ahead(_blocks(items, width, pattern_bytes))
    for block, last in blocks:
        windows = _Windows(spark.sparkContext.broadcast(block))
        df = df.mapInArrow(_pass(windows, last), schema)
        if not last:
            df = materialize(df, "decontaminate")
    return df.select(
        "row",
        "found.n_words",
        F.size("found.hit").cast("long").alias("n_hit"),
        F.array_sort("found.item_ids").alias("item_ids"),
        "found.spans",
    )


def list_ahead(blocks):
    """Each block, and whether it is the last."""
    held = None
    for block in blocks:
        if held is not None:
            yield held, False
        held = block
    yield held, True
