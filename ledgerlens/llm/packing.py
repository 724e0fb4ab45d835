"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed capacity.

Documents longer than a sequence are cut into pieces. Only a piece's length decides where it goes, and there are no
more lengths than tokens in a sequence. So the packing is found on the histogram of lengths: longest first, every run
of pieces of one length goes to the tightest open bins, which a segment tree over the remaining capacities finds in
logarithmic time. What it decides for a run is what it would decide for the run's pieces one by one. The plan's size is
bounded by the capacity, not by the data; every piece finds its own place in it by its length and its rank among the
pieces of that length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .hashed_features import pieces
from .numbering import numbered
from .rows import row_type, rows_and_text
from .textkernel import grouped, utf8

#: The id that ends every document.
END_ID = 0
#: Words whose ids a Python worker remembers; beyond, it starts over.
KNOWN_WORDS = 600_000
#: Longer words that are not plain ASCII are cut, too, where the tokenizer cuts in any case.
LONG_WORD = 1 << 16
#: Bytes of texts whose words are looked up together.
GROUP_BYTES = 4 << 20
#: Words are encoded in groups of about so many, in one string.
TOGETHER = 200
_CERTAIN_CUT = re.compile(rb"(?<=[0-9])(?=[!-~])|(?<=[A-Za-z])(?=[!-@\[-`{-~])")
#: The same where letters of Latin-1 (U+00C0 to U+00FF) may stand: whole code points, composed, each with one lower case.
_LATIN = re.compile(rb"(?:[\x00-\x7f]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_LATIN_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_LATIN_CUT = re.compile(
    rb"(?<=[0-9])(?=[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
    rb"|(?:(?<=[A-Za-z])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))(?=[!-@\[-`{-~])"
)
#: A byte-level vocabulary writes bytes of these letters as Latin-1, but for three.
_BYTE_LEVEL = (("\x9f", "\u0141"), ("\xa0", "\u0142"), ("\xad", "\u0143"))


# tokens ------------------------------------------------------------------------------------------------------


def _case_goes(text: bytes) -> bool:
    """Whether ASCII letters may be lower-cased at once: no reserved token, and no mark (U+0300 to U+037F) that joins a letter."""
    return b"<|" not in text and b"\xcc" not in text and b"\xcd" not in text


class WordEncoder:
    """Token ids of texts by a word tokenizer: lower case, white space dropped, no piece across white space, word ends marked.

    Each word between ASCII blanks is encoded once and remembered. Where letters or digits meet ASCII punctuation the
    tokenizer's rule cuts in any case; lower-case words of ASCII and Latin-1 letters need nothing but its merges.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        suffix = parts["model"]["end_of_word_suffix"]
        self.byte_level = '"ByteLevel"' in json.dumps(parts["pre_tokenizer"])
        merges_only = {**parts, "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.plain = Tokenizer.from_str(json.dumps(merges_only))
        vocabulary = parts["model"]["vocab"]
        self.ends_word = np.zeros(1 + max(vocabulary.values()), bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}

    def _remember(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        data = ids.astype("<u4").tobytes()
        cuts = (4 * ends).tolist()
        self.known.update(zip(words, [data[a:b] for a, b in zip([0, *cuts], cuts)]))

    def _encode_plain(self, words: list[bytes]) -> None:
        groups = [b" ".join(words[i : i + TOGETHER]).decode("latin-1") for i in range(0, len(words), TOGETHER)]
        for byte, written in _BYTE_LEVEL:
            groups = [g.replace(byte, written) for g in groups]
        found = self.plain.encode_batch_fast(groups, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found] or [np.empty(0, np.uint32)])
        self._remember(words, ids, np.flatnonzero(self.ends_word[ids]) + 1)

    def _encode_any(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        for i in range(0, len(texts), TOGETHER):
            part = texts[i : i + TOGETHER]
            found = self.whole.encode(" ".join(part), add_special_tokens=False)
            # Where the next word starts, in characters; a token belongs to the word that it starts in.
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            at = np.array([a for a, _ in found.offsets], np.int64)
            self._remember(words[i : i + TOGETHER], np.array(found.ids, np.uint32), np.searchsorted(at, ends))

    def _learn(self, new: set[bytes]) -> None:
        latin = _LATIN_LETTERS.fullmatch if self.byte_level else lambda word: False
        letters = [w for w in new if w.isalpha() and w.islower() or latin(w)]
        new = new.difference(letters)
        # A reserved token is told from plain text by its case and its punctuation.
        plain = [w for w in new if b"<|" not in w and (w.isascii() or (self.byte_level and _LATIN.fullmatch(w)))]
        other = list(new.difference(plain))
        together = _LATIN_CUT.sub(b" ", b"\n".join(plain).decode().lower().encode())
        need = set(together.split()).difference(self.known, letters)
        more = [p for p in need if p.isalpha() or latin(p)]
        self._encode_plain(letters + more)
        self._encode_any(list(need.difference(more)))
        known, long = self.known, [w for w in other if len(w) > LONG_WORD and b"<|" not in w]
        for word, parts in zip(plain, together.split(b"\n")):
            ids = known.get(parts)
            known[word] = b"".join([known[p] for p in parts.split(b" ")]) if ids is None else ids
        if long:
            parts = {w: _CERTAIN_CUT.split(w) for w in long}
            self._encode_any(list({p for x in parts.values() for p in x}.difference(known)))
            known.update({w: b"".join([known[p] for p in x]) for w, x in parts.items()})
            other = [w for w in other if w not in parts]
        self._encode_any(other)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of every text of a group, as little-endian 32-bit numbers."""
        words = [(t.lower() if _case_goes(t) else t).split() for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        self._learn(set().union(*words).difference(self.known))
        return [b"".join(map(self.known.__getitem__, x)) for x in words]


_WORKER: dict[str, WordEncoder] = {}


def _encoder(definition: str) -> WordEncoder:
    """The worker's encoder, with the words that its earlier tasks have met."""
    if definition not in _WORKER:
        _WORKER.clear()
        _WORKER[definition] = WordEncoder(definition)
    return _WORKER[definition]


def _token_pieces(definition, capacity: int, keep_ids: bool):
    def run(batches):
        encoder = _encoder(definition.value)
        for batch in batches:
            texts = utf8(batch.column("text"))
            for lo, hi in grouped(texts, GROUP_BYTES):
                # A text of its own group may be long.
                ids = encoder.encode(texts[lo:hi]) if hi - lo > 1 else [b"".join(encoder.encode([p])[0] for p in pieces(texts[lo]))]
                yield _cut(batch.column("row").slice(lo, hi - lo), ids, capacity, keep_ids)

    return run


def _cut(rows: pa.Array, ids: list[bytes], capacity: int, keep_ids: bool) -> pa.RecordBatch:
    end = END_ID.to_bytes(4, "little")
    owner, number, start, length, crc, kept = [], [], [], [], [], []
    for i, x in enumerate(ids):
        whole = x + end
        for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
            part = whole[at : at + 4 * capacity]
            owner.append(i)
            number.append(piece)
            start.append(at // 4)
            length.append(len(part) // 4)
            crc.append(zlib.crc32(part))
            kept.append(part if keep_ids else None)
    arrays = [
        rows.take(pa.array(owner, pa.int64())),
        pa.array(number, pa.int32()),
        *[pa.array(x, pa.int64()) for x in (start, length, crc)],
        pa.array(kept, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["row", "piece", "start", "length", "ids_crc32", "ids"])


# packing -----------------------------------------------------------------------------------------------------


class OpenBins:
    """Runs of bins by remaining capacity, under a segment tree that tells which capacities have any."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.runs: list[deque] = [deque() for _ in range(capacity + 1)]
        self.some = bytearray(2 * self.leaves)

    def _set(self, room: int, value: int) -> None:
        node = self.leaves + room
        while node and self.some[node] != value:
            self.some[node] = value
            node //= 2
            value = value or self.some[2 * node] | self.some[2 * node + 1]

    def add(self, room: int, first: int, count: int) -> None:
        if room:
            self.runs[room].append((first, count))
            self._set(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].popleft()
        if not self.runs[room]:
            self._set(room, 0)
        return run

    def tightest(self, length: int) -> int | None:
        """The least capacity of ``length`` or more that some bin has left."""
        node = self.leaves + length
        if self.some[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.some[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.some[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, first bin, pieces per bin, offset)`` of every run of pieces, by length and rank.

    Each round of a run at least halves the room of the bins it fills, and a length leaves at most three new runs of
    bins, so that the plan has fewer than ``3 * capacity * log2(capacity)`` rows whatever the counts.
    """
    bins, opened, plan = OpenBins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                room = capacity
                first, count = opened, -(-left // (capacity // length))
                opened += count
            else:
                first, count = bins.take(room)
            each = room // length
            full = min(count, left // each)
            if full:
                plan.append((length, rank, first, each, capacity - room))
                bins.add(room - each * length, first, full)
                rank, left, first, count = rank + full * each, left - full * each, first + full, count - full
            if left and count:  # a last bin that the rest of the run does not fill
                plan.append((length, rank, first, left, capacity - room))
                bins.add(room - left * length, first, 1)
                left, first, count = 0, first + 1, count - 1
            if count:
                bins.add(room, first, count)
    return sorted(plan)


def _places(plan):
    def run(batches):
        table = np.array(plan.value, np.int64).reshape(-1, 5)
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.empty(len(rank), np.int64)
            for one in np.unique(length):
                lo, hi = np.searchsorted(table[:, 0], [one, one + 1])
                mine = length == one
                at[mine] = lo + np.searchsorted(table[lo:hi, 1], rank[mine], side="right") - 1
            _, first_rank, first_bin, per_bin, offset = table[at].T
            nth = rank - first_rank
            columns = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [pa.array(first_bin + nth // per_bin), pa.array(offset + nth % per_bin * length)],
                names=[*columns, "sequence_id", "offset"],
            )

    return run


def pack_documents(
    documents: DataFrame,
    definition: str,
    capacity: int = 2048,
    text_col: str = "text",
    carry: list[str] | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Per piece: the document's columns in ``row``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids``, ``sequence_id``, ``offset``.

    ``definition`` is the JSON of a tokenizer that drops white space; it is sent to the tasks by broadcast. A document is
    its ids and ``END_ID``; only one longer than ``capacity`` is cut. ``ids`` (little-endian 32-bit) is null unless
    ``keep_ids``. Sequences are numbered from 0 and are gapless from offset 0; ``sequences`` puts them together.

    A null or empty text is the end id alone. Repeated rows are packed each. An empty table gives an empty result. Long
    texts are encoded in parts; an unbroken run of letters is one word for the tokenizer and is encoded at once.
    """
    df = rows_and_text(documents, text_col, carry)
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(definition)
    kind = f"row {row_type(df)}, piece int, start long, length long, ids_crc32 long, ids binary"
    cut = df.mapInArrow(_token_pieces(shared, capacity, keep_ids), kind)
    cut = materialize(cut.withColumn("number", F.monotonically_increasing_id()), "pieces")
    shared.destroy()
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = spark.sparkContext.broadcast(best_fit_decreasing(counts, capacity))
    ranked = numbered(cut, "length", ["number"], "ranked-pieces", place="rank").drop("number", "size")
    return ranked.mapInArrow(_places(plan), f"{kind}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``n_tokens`` and ``ids`` of each sequence of documents packed with ``keep_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    tokens = F.aggregate("parts", F.lit(0).cast("long"), lambda n, part: n + part["length"])
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", tokens.alias("n_tokens"), joined.alias("ids"))
