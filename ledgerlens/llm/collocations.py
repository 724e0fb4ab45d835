"""Collocations by stripes: every prefix keys a counter of the words that follow it.

Tasks count stripes locally and stripes of one prefix are merged elementwise. The merged stripes give the counts of all
extensions, the total of a prefix (as an entry of the stripe of the prefix without its last word; that of the empty
prefix is the sum of its stripe) and the largest extension, which is what may subsume the prefix. Three scans:

1. the stripe of the empty prefix: words, counted by their text;
2. the stripes of single words, for words that scan 1 found frequent;
3. the stripes of all longer prefixes, along bigrams that scan 2 found frequent.

A phrase is never more frequent than its parts, so nothing frequent is missed. "Found frequent" is asked of a bit table
of bounded size, which may say yes too often and never no: that costs time and changes no result. From scan 2 on, words
are 64-bit hashes of language and text. Stripes of hot prefixes, of which there can be only ``HOT`` by arithmetic, are
cut into segments by next word, so that no task merges what a third of the corpus has left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .textkernel import CHUNK_BYTES, grouped, inside_table, mix, utf8, windows, word_hashes

#: What ends a piece, and what separates words inside a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

#: A prefix with more than one in so many of all words is hot.
HOT = 4096
#: The stripe of the empty prefix is cut into so many segments.
WORD_SEGMENTS = 4096
#: Words, or entries of stripes, that a task holds before it passes them on.
HELD_WORDS = 400_000
HELD_ENTRIES = 2_000_000
#: Bits of the tables that tell frequent words and bigrams, at most.
TABLE_BITS = 28
UNKNOWN = "und"

_IN_WORD = inside_table(frozenset(PIECE_ENDS + BLANKS))
_ENDS_PIECE = ~inside_table(frozenset(PIECE_ENDS))
_TO_BLANK = bytes(0x20 if b in PIECE_ENDS else b for b in range(256))
_STRIPES = "lang string, prefix array<long>, segment int, next array<long>, n array<long>"
_ORDER = np.random.default_rng(7).integers(0, 2**64, 16, dtype=np.uint64) | np.uint64(1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _by_language(batches):
    """``(language, joined lower-case texts)`` of about a megabyte, a long text alone."""
    for batch in batches:
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text"))):
            if text:
                texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            for lo, hi in grouped(own, CHUNK_BYTES):
                yield lang, b"\n".join(own[lo:hi]).lower()


def _language_seed(lang: str) -> np.uint64:
    return word_hashes(b"/" + lang.encode("utf-8", "replace").replace(b" ", b"_"))[0][:1].sum(dtype=np.uint64)


def _words_and_pieces(lang: str, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of language and word for every word, and the number of the piece that it is in."""
    h, s, _ = word_hashes(data, _IN_WORD)
    ends = np.cumsum(_ENDS_PIECE[np.frombuffer(data, np.uint8)], dtype=np.int32)
    return mix(h + _language_seed(lang)), ends[s]


# the empty prefix --------------------------------------------------------------------------------------------


def _word_stripes(batches):
    from collections import Counter

    held: dict[str, Counter] = {}
    for lang, data in _by_language(batches):
        held.setdefault(lang, Counter()).update(data.translate(_TO_BLANK).split())
        if sum(map(len, held.values())) > HELD_WORDS:
            yield from _emit_words(held)
            held = {}
    yield from _emit_words(held)


def _emit_words(held):
    for lang, counts in held.items():
        words = list(counts)
        if not words:
            continue
        joined = b" ".join(words)
        key = mix(word_hashes(joined, _IN_WORD)[0] + _language_seed(lang))
        segment = (key % np.uint64(WORD_SEGMENTS)).astype(np.int32)
        order = np.argsort(segment, kind="stable")
        first = np.flatnonzero(np.diff(segment[order], prepend=-1))
        offsets = pa.array(np.append(first, len(order)), pa.int32())
        n = np.fromiter(counts.values(), np.int64, len(words))[order]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(first)),
                pa.array(segment[order][first]),
                pa.ListArray.from_arrays(offsets, pa.array([words[i] for i in order], pa.binary())),
                pa.ListArray.from_arrays(offsets, pa.array(_signed(key[order]))),
                pa.ListArray.from_arrays(offsets, pa.array(n)),
            ],
            names=["lang", "segment", "word", "key", "n"],
        )


def _merge_words(least: int):
    """One merged segment at a time; rows come sorted by language and segment."""

    def emit(lang, segment, counts, keys):
        frequent = [w for w, n in counts.items() if n >= least]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang]),
                pa.array([sum(counts.values())], pa.int64()),
                pa.array([frequent], pa.list_(pa.binary())),
                pa.array([[keys[w] for w in frequent]], pa.list_(pa.int64())),
                pa.array([[counts[w] for w in frequent]], pa.list_(pa.int64())),
            ],
            names=["lang", "total", "word", "key", "f"],
        )

    def run(batches):
        at, counts, keys = None, {}, {}
        for batch in batches:
            for lang, segment, words, key, n in zip(*[batch.column(c) for c in ("lang", "segment", "word", "key", "n")]):
                here = (lang.as_py(), segment.as_py())
                if here != at:
                    if counts:
                        yield emit(*at, counts, keys)
                    at, counts, keys = here, {}, {}
                for w, k, x in zip(words.values.to_pylist(), key.values.to_pylist(), n.values.to_pylist()):
                    counts[w] = counts.get(w, 0) + x
                    keys[w] = k
        if counts:
            yield emit(*at, counts, keys)

    return run


# longer prefixes ---------------------------------------------------------------------------------------------


class BitTable:
    """Keys that may be frequent: two bits per key in a table of a power of two."""

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.mask = bits, np.uint64(size - 1)

    def has(self, key: np.ndarray) -> np.ndarray:
        found = np.ones(len(key), bool)
        for at in (key & self.mask, (key >> np.uint64(32)) & self.mask):
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def bit_table(keys: DataFrame) -> BitTable:
    """The table of a column ``key`` of well-mixed numbers: 16 bits a key, at most ``2 ** TABLE_BITS`` in all."""
    size = 1 << min(TABLE_BITS, max(15, (16 * keys.count()).bit_length()))
    places = F.array(F.col("key"), F.shiftright("key", 32))
    slots = keys.select(F.explode(places).alias("at")).select(F.col("at").bitwiseAND(F.lit(size - 1)).alias("at"))
    blocks = slots.groupBy(F.shiftright("at", 15).alias("block")).agg(
        F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(32767))).alias("bits")
    )
    bits = np.zeros(size // 8, np.uint8)
    for r in blocks.collect():  # size / 32768 rows of 4 KB
        bits[r["block"] * 4096 : (r["block"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return BitTable(bits, size)


def _bigram_entries(w, piece, table):
    """``(prefix columns, next)`` for prefixes of one word, where both words may be frequent."""
    known = table.has(w)
    at = np.flatnonzero(known[:-1] & known[1:] & (piece[1:] == piece[:-1]))
    return [([w[at]], w[at + 1])]


def _longer_entries(w, piece, table, longest):
    """The same for prefixes of two words and more, all along frequent bigrams."""
    pair = (piece[1:] == piece[:-1]) & table.has(windows(w, 2))
    along, found = pair, []
    for size in range(2, longest):
        # Bigrams at i, ..., i + size - 1.
        along = along[:-1] & pair[size - 1 :]
        at = np.flatnonzero(along)
        found.append(([w[at + i] for i in range(size)], w[at + size]))
    return found


class _Stripes:
    """Counts of ``(prefix, next)`` of one language and prefix length, pre-aggregated."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, columns: list[np.ndarray], n: np.ndarray | None = None) -> None:
        if not len(columns[0]):
            return
        key = np.zeros(len(columns[0]), np.uint64)
        for i, c in enumerate(columns):
            key += c * _ORDER[i]
        key = mix(key)
        _, first, owner, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        if n is not None:
            counts = np.bincount(owner, n).astype(np.int64)
        self.parts.append((*[c[first] for c in columns], counts))
        self.size += len(first)

    def compact(self) -> None:
        *columns, n = [np.concatenate(x) for x in zip(*self.parts)]
        self.parts, self.size = [], 0
        self.add(columns, n)

    def emit(self, lang: str, hot: tuple[np.ndarray, np.ndarray]):
        if not self.parts:
            return
        self.compact()
        *prefix, following, n = self.parts[0]
        key = prefix_key(prefix)
        segment = (mix(following) & _segments(prefix, hot)).astype(np.int32)
        order = np.lexsort((segment, key))
        new = np.append(True, (np.diff(key[order]) != 0) | (np.diff(segment[order]) != 0))
        first = np.flatnonzero(new)
        for lo in range(0, len(first), 20_000):
            some = first[lo : lo + 20_000]
            end = first[lo + 20_000] if lo + 20_000 < len(first) else len(order)
            rows, entries = order[some], order[some[0] : end]
            offsets = pa.array(np.append(some, end) - some[0], pa.int32())
            flat = np.stack([p[rows] for p in prefix], axis=1).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(rows)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(prefix), pa.int32()), pa.array(_signed(flat))),
                    pa.array(segment[rows]),
                    pa.ListArray.from_arrays(offsets, pa.array(_signed(following[entries]))),
                    pa.ListArray.from_arrays(offsets, pa.array(n[entries])),
                ],
                names=["lang", "prefix", "segment", "next", "n"],
            )


def prefix_key(prefix: list[np.ndarray]) -> np.ndarray:
    total = np.full(len(prefix[0]), len(prefix), np.uint64)
    for i, p in enumerate(prefix):
        total += p * _ORDER[8 + i % 8]
    return mix(total)


def _segments(prefix: list[np.ndarray], hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A mask for the hash of the next word: one bit less than the number of segments of the prefix's stripe."""
    keys, masks = hot
    # A longer prefix is at most as frequent as the bigram it begins with.
    own = prefix[0] if len(prefix) == 1 else windows_of(prefix[:2])
    if not len(keys):
        return np.zeros(len(own), np.uint64)
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    return np.where(keys[at] == own, masks[at], np.uint64(0))


def windows_of(columns: list[np.ndarray]) -> np.ndarray:
    """The key of a phrase from columns of its words, as ``windows`` has it for neighbouring words."""
    flat = np.stack(columns, axis=1).ravel()
    return windows(flat, len(columns))[:: len(columns)]


def _phrase_stripes(table, hot, longest: int | None):
    """Scan 2 (``longest`` None) or scan 3."""

    def run(batches):
        held: dict[tuple[str, int], _Stripes] = {}
        for lang, data in _by_language(batches):
            w, piece = _words_and_pieces(lang, data)
            if len(w) < 2:
                continue
            found = _bigram_entries(w, piece, table.value) if longest is None else _longer_entries(w, piece, table.value, longest)
            for prefix, following in found:
                held.setdefault((lang, len(prefix)), _Stripes()).add([*prefix, following])
            if sum(s.size for s in held.values()) > HELD_ENTRIES:
                for s in held.values():
                    s.compact()
                if sum(s.size for s in held.values()) > HELD_ENTRIES // 2:
                    for (own, _), s in held.items():
                        yield from s.emit(own, hot.value)
                    held = {}
        for (own, _), s in held.items():
            yield from s.emit(own, hot.value)

    return run


def _merge_stripes(least: int):
    """Rows come sorted by language, prefix and segment; a stripe with frequent extensions gives a row."""

    def groups_of(batch) -> np.ndarray:
        """The number of each row's stripe."""
        prefix, key = batch.column("prefix"), np.zeros(batch.num_rows, np.uint64)
        size, flat = prefix.value_lengths().to_numpy(), prefix.flatten().to_numpy().view(np.uint64)
        start = np.cumsum(size) - size
        for n in np.unique(size):
            rows = np.flatnonzero(size == n)
            key[rows] = prefix_key([flat[start[rows] + i] for i in range(n)])
        lang = batch.column("lang").dictionary_encode().indices.to_numpy()
        change = (np.diff(lang) != 0) | (key[1:] != key[:-1]) | (np.diff(batch.column("segment").to_numpy()) != 0)
        return np.cumsum(np.append(0, change))

    def merged(batch, group):
        following, n = batch.column("next"), batch.column("n")
        owner = np.repeat(group, following.value_lengths().to_numpy())
        values, counts = following.flatten().to_numpy().view(np.uint64), n.flatten().to_numpy()
        _, first, inverse = np.unique(mix(values + owner.astype(np.uint64) * _ORDER[0]), return_index=True, return_inverse=True)
        f = np.zeros(len(first), np.int64)
        np.add.at(f, inverse, counts)
        place, f = first[f >= least], f[f >= least]
        order = np.argsort(owner[place], kind="stable")
        place, f = place[order], f[order]
        groups, starts = np.unique(owner[place], return_index=True)
        rows = pa.array(np.searchsorted(group, groups))
        offsets = pa.array(np.append(starts, len(place)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("lang").take(rows),
                batch.column("prefix").take(rows),
                pa.ListArray.from_arrays(offsets, pa.array(_signed(values[place]))),
                pa.ListArray.from_arrays(offsets, pa.array(f)),
            ],
            names=["lang", "prefix", "next", "f"],
        )

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            group = groups_of(whole)
            cut = int(np.searchsorted(group, group[-1]))  # the last stripe may go on
            if cut:
                yield merged(whole.slice(0, cut), group[:cut])
            held = whole.slice(cut)
        if held is not None:
            yield merged(held, groups_of(held))

    return run


def _stripes_of(texts: DataFrame, table: BitTable, hot: DataFrame, words: int, least: int, longest: int | None, name: str) -> DataFrame:
    """Merged stripes: ``(lang, prefix, next, f)`` with the extensions that occur ``least`` times or more."""
    context = texts.sparkSession.sparkContext
    rows = hot.where(F.col("f") * HOT > words).select("key", "f").collect()  # fewer than HOT
    keys = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
    masks = np.array([(1 << (r["f"] * HOT // max(words, 1)).bit_length()) - 1 for r in rows], np.uint64)
    order = np.argsort(keys)
    shared = [context.broadcast(table), context.broadcast((keys[order], masks[order]))]
    stripes = texts.mapInArrow(_phrase_stripes(*shared, longest), _STRIPES)
    spread = stripes.repartition("lang", "prefix", "segment")
    placed = spread.sortWithinPartitions("lang", F.xxhash64("prefix"), "prefix", "segment")
    merged = placed.mapInArrow(_merge_stripes(least), "lang string, prefix array<long>, next array<long>, f array<long>")
    merged = materialize(merged, name)
    for s in shared:
        s.destroy()
    return merged


# phrases -----------------------------------------------------------------------------------------------------


def _extensions(stripes: DataFrame) -> DataFrame:
    """``(lang, words, f)``: every frequent extension."""
    entry = F.explode(F.arrays_zip("next", "f")).alias("entry")
    return stripes.select("lang", "prefix", entry).select(
        "lang", F.concat("prefix", F.array("entry.next")).alias("words"), F.col("entry.f").alias("f")
    )


def _phrase_keys(phrases: DataFrame) -> DataFrame:
    """``key``: the hash by which scan 3 asks for a bigram."""

    def run(batches):
        for batch in batches:
            words = batch.column("words").flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
            key = windows_of(list(words.T)) if batch.num_rows else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(key)), batch.column("f")], names=["key", "f"])

    return phrases.select("words", "f").mapInArrow(run, "key long, f long")


def score(a: Column, l: Column, r: Column, scale: int) -> Column:  # noqa: E741
    """``floor(scale * a / (l + r))``, exactly."""
    product = a.cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)")
    sum_ = l.cast("decimal(20,0)") + r.cast("decimal(20,0)")
    remainder = product % sum_
    return ((product - remainder) / sum_).cast("decimal(20,0)").cast("long")


def mine_collocations(
    documents: DataFrame,
    longest: int = 4,
    least: int = 30,
    top: int = 2000,
    subsumed_percent: int = 80,
    scale: int = 2_000_000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """Per language the best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased in A-Z, cut into pieces at ``PIECE_ENDS`` and those into words at ``BLANKS``. A candidate is a
    phrase of 2 to ``longest`` words inside a piece that occurs ``a >= least`` times. Cut after its first k words, its
    parts occur l and r times; the cut with the lowest ``floor(scale * a / (l + r))`` counts, of equal ones the first.
    Candidates inside a longer one with at least ``subsumed_percent`` of their occurrences go. The rest are ranked by
    score, then a, then phrase in byte order. ``n`` is the number of words of the language.

    A null language is ``und``, and joins documents that say so themselves. Null and empty texts have no words, repeated
    rows count each, a text of any length is worked off in parts. Empty tables and languages without candidates give no
    rows. Other columns are ignored, whatever their names.
    """
    texts = documents.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    counted = texts.mapInArrow(_word_stripes, "lang string, segment int, word array<binary>, key array<long>, n array<long>")
    counted = counted.repartition("lang", "segment").sortWithinPartitions("lang", "segment")
    kinds = "lang string, total long, word array<binary>, key array<long>, f array<long>"
    empty_prefix = materialize(counted.mapInArrow(_merge_words(least), kinds), "word-stripes")
    sizes = empty_prefix.groupBy("lang").agg(F.sum("total").alias("n"))
    words = empty_prefix.select("lang", F.explode(F.arrays_zip("word", "key", "f")).alias("x")).select("lang", "x.*")
    total = sizes.agg(F.sum("n")).first()[0] or 0

    two = _stripes_of(texts, bit_table(words.select("key")), words, total, least, None, "stripes-1")
    bigrams = materialize(_phrase_keys(_extensions(two)), "bigrams")
    more = _stripes_of(texts, bit_table(bigrams.select("key")), bigrams, total, least, longest, "stripes-2")
    stripes = two.unionByName(more)
    found = materialize(_extensions(stripes), "candidates")
    counts = found.where(F.size("words") < longest).unionByName(words.select("lang", F.array("key").alias("words"), "f"))
    scored = _scored(found, counts, scale)

    suffixes = found.where(F.size("words") > 2).select("lang", F.expr("slice(words, 2, size(words) - 1)").alias("words"), "f")
    largest = stripes.where(F.size("prefix") > 1).select("lang", F.col("prefix").alias("words"), F.array_max("f").alias("f"))
    longer = suffixes.unionByName(largest).groupBy("lang", "words").agg(F.max("f").alias("longer"))
    subsumed = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * subsumed_percent
    kept = scored.join(longer, ["lang", "words"], "left").where(~F.coalesce(subsumed, F.lit(False)))

    named = _named(kept, words)
    best = [F.desc("score"), F.desc("a"), "phrase"]
    # First within shares of a language, so that no task ranks all of its phrases.
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*best)
    few = named.withColumn("_place", F.row_number().over(share)).where(F.col("_place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _scored(found: DataFrame, counts: DataFrame, scale: int) -> DataFrame:
    """``(lang, words, a, l, r, score)`` by the cut that counts."""
    cuts = found.select("lang", "words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k")).select(
        "*", F.expr("slice(words, 1, k)").alias("first"), F.expr("slice(words, k + 1, size(words) - k)").alias("rest")
    )
    left = counts.select("lang", F.col("words").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("words").alias("rest"), F.col("f").alias("r"))
    parts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    cut = F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r"), scale).alias("score"), "k", "l", "r")).alias("cut")
    return parts.groupBy("lang", "words").agg(F.first("a").alias("a"), cut).select("lang", "words", "a", "cut.l", "cut.r", "cut.score")


def _named(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with their text in place of hashes."""
    texts = words.select("lang", "key", F.col("word").cast("string").alias("word"))
    spelled = phrases.select("*", F.posexplode("words").alias("at", "key")).join(texts, ["lang", "key"])
    grouped_ = spelled.groupBy("lang", "words", "a", "l", "r", "score").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"))
    return grouped_.select("lang", F.array_join("spelled.word", " ").alias("phrase"), "a", "l", "r", "score")
