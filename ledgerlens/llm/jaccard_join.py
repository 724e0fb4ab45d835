"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

Plan, with S the distinct shingles of all texts:

1. One pass over the texts gives a row per document (set size, 128-bit set signature, a 32-slot histogram)
   and, per task, counts of shingles in a table of fixed size. The summed table ranks shingles from rare to
   frequent; any fixed order gives the same result, so its resolution only decides how many candidates arise.
2. Documents with equal sets form a class, found by a partially aggregated group; the smallest id stands for it.
3. Representatives emit the shingles of their prefix (n - ceil(t n) + 1 rarest). One window per shingle ties each
   member to the member where that shingle stands earliest. Shingles of a single member drop out there.
4. Such pairs pass the length, positional and suffix filters and are verified once; links give components.
5. Only shingles that still meet several components are joined with themselves, on pairs of different
   components, under the same filters, and verified. So a group of near copies costs about one
   verification a member, and no link between components is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bound_batches, materialize
from .components import components
from .textkernel import documents_words, mix, short_window, utf8, windows

RANK_BITS = 20
RANK_PARTS = 16
HISTOGRAM = 32
#: A shingle counted more often than this is dealt to several groups.
HOT_POSTINGS = 50_000
#: Of a shingle that meets several components, so many members meet the others in one group.
MEETING = 5_000
#: Size of the table that tells most texts that are not verified before they are shuffled: 2 MB.
SIEVE_BITS = 24

_PASS1 = (
    "doc_id long, n long, sig1 long, sig2 long, histogram array<int>, part int, counts binary"
)


def shingle_sets(texts: list[bytes], k: int):
    """Sorted distinct shingle hashes of each text, in order: lower-cased A-Z, words split at blanks."""
    for _, _, h, _, _, _, at in documents_words([t.lower() for t in texts]):
        every = windows(h, k)
        for lo, hi in zip(at[:-1], at[1:]):
            if hi - lo >= k:
                yield np.unique(every[lo : hi - k + 1])
            elif hi > lo:
                yield short_window(h[lo:hi])
            else:
                yield np.empty(0, np.uint64)


def _signature(s: np.ndarray) -> tuple[int, int]:
    one = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = mix(s ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def _profile(k: int):
    """Document rows, then this task's shingle counts."""

    def run(batches):
        counts = np.zeros(1 << RANK_BITS, dtype=np.int64)
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n", pa.int64()), ("sig1", pa.int64()), ("sig2", pa.int64())]
            + [("histogram", pa.list_(pa.int32())), ("part", pa.int32()), ("counts", pa.binary())]
        )
        for batch in batches:
            n, one, two, hist, waiting, held = [], [], [], [], [], 0
            for s in shingle_sets(utf8(batch.column("text")), k):
                n.append(len(s))
                a, b = _signature(s)
                one.append(a)
                two.append(b)
                hist.append(np.bincount((s & np.uint64(HISTOGRAM - 1)).astype(np.int64), minlength=HISTOGRAM))
                waiting.append(s)
                held += len(s)
                if held > 1 << 20:
                    counts += _counted(waiting)
                    waiting, held = [], 0
            if waiting:
                counts += _counted(waiting)
            none = pa.nulls(len(n))
            columns = [batch.column("doc_id"), n, one, two, [x.tolist() for x in hist], none, none]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
                schema=schema,
            )
        yield _parts(counts, schema)

    return run


def _counted(sets: list[np.ndarray]) -> np.ndarray:
    slots = (np.concatenate(sets) >> np.uint64(64 - RANK_BITS)).astype(np.int64)
    return np.bincount(slots, minlength=1 << RANK_BITS)


def _parts(counts: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    cut = np.minimum(counts, 2**32 - 1).astype(np.uint32).reshape(RANK_PARTS, -1)
    rows = {"part": pa.array(range(RANK_PARTS), pa.int32()), "counts": pa.array([p.tobytes() for p in cut])}
    return pa.RecordBatch.from_arrays(
        [rows[f.name].cast(f.type) if f.name in rows else pa.nulls(RANK_PARTS, f.type) for f in schema], schema=schema
    )


def _add_counts(batches):
    """Sums tables part by part; holds one table at most."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            got = np.frombuffer(blob, dtype=np.uint32).astype(np.int64)
            total[part] = total[part] + got if part in total else got
    if total:
        blobs = [np.minimum(x, 2**32 - 1).astype(np.uint32).tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array(blobs)], names=["part", "counts"])


def _shingle_counts(profile: DataFrame) -> np.ndarray:
    """The summed count table: 2^20 numbers however large the corpus."""
    parts = profile.where("part is not null").select("part", "counts")
    kinds = "part int, counts binary"
    # Two steps, so that no task sums the tables of all others.
    summed = parts.mapInArrow(_add_counts, kinds).withColumn("salt", F.spark_partition_id() % 64)
    summed = summed.repartition(64, "part", "salt").drop("salt").mapInArrow(_add_counts, kinds).repartition(RANK_PARTS, "part")
    counts = np.zeros((RANK_PARTS, (1 << RANK_BITS) // RANK_PARTS), dtype=np.uint32)
    for row in summed.mapInArrow(_add_counts, kinds).collect():
        counts[row["part"]] = np.frombuffer(row["counts"], dtype=np.uint32)
    return counts.reshape(-1)


def _prefixes(k: int, percent: int, ranks, hot: int):
    """Prefix shingles of each representative, rarest first."""

    def run(batches):
        count = ranks.value
        level = np.minimum(65535, 2048 * np.log2(1.0 + count)).astype(np.uint16)
        names = ["token", "salt", "salts", "rep", "n", "pos"]
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            expected = batch.column("sig1").to_pylist()
            token, rep, size, pos = [], [], [], []
            for i, s in enumerate(shingle_sets(utf8(batch.column("text")), k)):
                if len(s) and _signature(s)[0] == expected[i]:
                    m = len(s) - -(-percent * len(s) // 100) + 1
                    order = np.argsort(level[(s >> np.uint64(64 - RANK_BITS)).astype(np.int64)], kind="stable")[:m]
                    token.append(s[order])
                    rep.append(np.full(m, ids[i], dtype=np.int64))
                    size.append(np.full(m, len(s), dtype=np.int32))
                    pos.append(np.arange(m, dtype=np.int32))
            if token:
                t, r = np.concatenate(token), np.concatenate(rep)
                salts = (count[(t >> np.uint64(64 - RANK_BITS)).astype(np.int64)] // hot + 1).astype(np.int32)
                salt = (mix(r.view(np.uint64)) % salts.astype(np.uint64)).astype(np.int32)
                columns = [t.view(np.int64), salt, salts, r, np.concatenate(size), np.concatenate(pos)]
                whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
                for start in range(0, whole.num_rows, 100_000):
                    yield whole.slice(start, 100_000)

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            ids, expected = batch.column("doc_id").to_pylist(), batch.column("sig1").to_pylist()
            rows = [
                (ids[i], s.view(np.int64))
                for i, s in enumerate(shingle_sets(utf8(batch.column("text")), k))
                if len(s) and _signature(s)[0] == expected[i]
            ]
            for r, s in rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r], pa.int64()), pa.array([len(s)], pa.int32()), pa.array([s], pa.list_(pa.int64()))],
                    names=["rep", "n", "shingles"],
                )

    return run


class _Join:
    def __init__(self, texts: DataFrame, k: int, percent: int, hot: int, meeting: int):
        self.texts, self.k, self.percent, self.hot, self.meeting = texts, k, percent, hot, meeting

    # filters ---------------------------------------------------------------------------------------------
    def _needed(self, na: Column, nb: Column) -> Column:
        """100 * overlap >= percent * union, as 'overlap * (100 + percent) >= percent * (na + nb)'."""
        return F.lit(self.percent) * (na + nb)

    def _long_enough(self, na: Column, nb: Column) -> Column:
        return F.lit(100) * F.least(na, nb) >= F.lit(self.percent) * F.greatest(na, nb)

    def _place_allows(self, na: Column, pa_: Column, nb: Column, pb: Column) -> Column:
        """At their first common shingle, what follows in both still holds enough."""
        return F.lit(100 + self.percent) * F.least(na - pa_, nb - pb) >= self._needed(na, nb)

    def run(self) -> DataFrame:
        k = self.k
        profile = materialize(self.texts.mapInArrow(_profile(k), _PASS1), "shingle-profile")
        docs = profile.where("part is null").select("doc_id", "n", "sig1", "sig2", "histogram")
        classes = materialize(
            docs.where("n > 0 and doc_id is not null").groupBy("n", "sig1", "sig2").agg(
                F.min("doc_id").alias("rep"), F.first("histogram").alias("histogram")
            ),
            "shingle-classes",
        )
        ranks = self.texts.sparkSession.sparkContext.broadcast(_shingle_counts(profile))
        postings = self._postings(classes, ranks)
        ranks.destroy()  # the postings are written
        links = self._verified(self._star_pairs(postings), classes)
        first = components(links, "a", "b")
        rest = self._verified(self._cross_pairs(postings, first), classes)
        # The components found say what the links said, and are stars already.
        stars = first.selectExpr("node as a", "component as b")
        every = stars.union(rest.select("a", "b")).union(self._shared_ids(docs, classes))
        found = components(every, "a", "b")
        joined = classes.drop("histogram").join(found.withColumnRenamed("node", "rep"), "rep", "left")
        joined = joined.select("n", "sig1", "sig2", F.coalesce("component", "rep").alias("component_id"))
        rows = docs.select("doc_id", "n", "sig1", "sig2")
        of_texts = rows.where("n > 0").join(joined, ["n", "sig1", "sig2"], "left")
        # Rows without words have the links of other rows of their id only.
        of_ids = rows.where("n = 0").join(found.selectExpr("node as doc_id", "component as component_id"), "doc_id", "left")
        return of_texts.unionByName(of_ids).select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )

    def _shared_ids(self, docs: DataFrame, classes: DataFrame) -> DataFrame:
        """Links between an id and the classes of its texts, for ids with several; one narrow shuffle by id."""
        text = F.struct("n", "sig1", "sig2")
        several = docs.groupBy("doc_id").agg(F.min(text).alias("lo"), F.max(text).alias("hi")).where("lo <> hi")
        theirs = docs.select("doc_id", "n", "sig1", "sig2").join(several.select("doc_id"), "doc_id").distinct()
        return theirs.join(classes.drop("histogram"), ["n", "sig1", "sig2"]).selectExpr("doc_id as a", "rep as b")

    def _representatives(self, ids: DataFrame) -> DataFrame:
        """Texts of the given (doc_id, sig1); the ids are the hashed side, texts stream past unsorted."""
        return self.texts.join(ids.hint("shuffle_hash"), "doc_id").select("doc_id", "sig1", "text")

    def _sieved(self, ids: DataFrame) -> _Join:
        """The same join over a part of the texts: all of the given ids, and those that share a bit with one.

        The table has a fixed size. Of a corpus with far more ids than bits it lets everything pass, and the result is the same.
        """
        bit = f"pmod(xxhash64(doc_id), {1 << SIEVE_BITS}L)"
        words = ids.select(F.expr(bit).alias("bit")).groupBy(F.expr("bit div 64").alias("id")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("word")
        )
        every = ids.sparkSession.range(1 << (SIEVE_BITS - 6)).join(words, "id", "left")
        placed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word"))))
        table = materialize(every.agg(F.transform(placed, lambda x: x["word"]).alias("words")), "sieve")
        passes = F.expr(
            f"(shiftright(element_at(words, cast({bit} div 64 as int) + 1), cast({bit} % 64 as int)) & 1) = 1"
        )
        # One row beside each text.
        texts = self.texts.join(F.broadcast(table), passes, "left_semi")
        return _Join(texts, self.k, self.percent, self.hot, self.meeting)

    def _postings(self, classes: DataFrame, ranks) -> DataFrame:
        ids = classes.select(F.col("rep").alias("doc_id"), "sig1")
        prefix = self._representatives(ids).mapInArrow(
            _prefixes(self.k, self.percent, ranks, self.hot),
            "token long, salt int, salts int, rep long, n int, pos int",
        )
        group = Window.partitionBy("token", "salt").orderBy("pos", "n", "rep")
        so_far = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        starred = prefix.withColumns(
            {
                "hub": F.first("rep").over(so_far),
                "hub_n": F.first("n").over(so_far),
                "hub_pos": F.first("pos").over(so_far),
                "place": F.row_number().over(group),
                "next": F.lead("rep").over(group),
            }
        )
        return materialize(starred.where("place > 1 or next is not null or salts > 1").drop("next"), "postings")

    def _star_pairs(self, postings: DataFrame) -> DataFrame:
        spread = postings.where("salts > 1 and place = 1")
        group = Window.partitionBy("token").orderBy("pos", "n", "rep")
        so_far = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hubs = spread.withColumns({f"hub{x}": F.first(c).over(so_far) for x, c in (("", "rep"), ("_n", "n"), ("_pos", "pos"))})
        pairs = postings.unionByName(hubs).where("rep <> hub")
        return self._pairs(pairs, "rep", "n", "pos", "hub", "hub_n", "hub_pos")

    def _pairs(self, df: DataFrame, a, na, pa_, b, nb, pb) -> DataFrame:
        c = F.col
        kept = df.where(self._long_enough(c(na), c(nb)) & self._place_allows(c(na), c(pa_), c(nb), c(pb)))
        first = c(a) < c(b)
        return kept.select(
            F.when(first, c(a)).otherwise(c(b)).alias("a"),
            F.when(first, c(b)).otherwise(c(a)).alias("b"),
            F.when(first, c(na)).otherwise(c(nb)).alias("na"),
            F.when(first, c(nb)).otherwise(c(na)).alias("nb"),
        ).distinct()

    def _cross_pairs(self, postings: DataFrame, found: DataFrame) -> DataFrame:
        labelled = postings.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
            "token", "rep", "n", "pos", F.coalesce("component", "rep").alias("c")
        )
        # No partner in the group is shorter than its shortest member or than the length filter allows.
        shortest = labelled.groupBy("token").agg(F.min("n").alias("least_n"))
        n, pos = F.col("n"), F.col("pos")
        partner = F.greatest(F.col("least_n"), F.expr(f"cast((n * {self.percent} + 99) div 100 as int)"))
        able = labelled.join(shortest, "token").where(
            F.lit(100 + self.percent) * (n - pos) >= self._needed(n, partner)
        )
        able = materialize(able.drop("least_n"), "open-postings")
        mixed = able.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("members"))
        mixed = mixed.where("lo < hi").select("token", F.expr(f"cast(members div {self.meeting} + 1 as int)").alias("salts"))
        open_ = able.join(mixed, "token").withColumn("band", self._band(n))
        c = F.col
        names = ("token", "rep", "n", "pos", "c", "band", "salt")
        side = lambda df, i: df.select(*[c(name).alias(f"{name}{i}") for name in names])
        # The smaller of a pair stands in its band once; the larger looks there and one band below, in every group.
        small = side(open_.withColumn("salt", F.pmod(F.xxhash64("rep"), "salts").cast("int")), 1)
        large = open_.withColumn("salt", F.explode(F.sequence(F.lit(0), c("salts") - 1)))
        large = side(large.withColumn("band", F.explode(F.array(c("band"), c("band") - 1))), 2)
        meets = (
            (c("token1") == c("token2"))
            & (c("band1") == c("band2"))
            & (c("salt1") == c("salt2"))
            & ((c("n1") < c("n2")) | ((c("n1") == c("n2")) & (c("rep1") < c("rep2"))))
            & (c("c1") != c("c2"))
            & self._long_enough(c("n1"), c("n2"))
            & self._place_allows(c("n1"), c("pos1"), c("n2"), c("pos2"))
        )
        return self._pairs(small.join(large, meets), "rep1", "n1", "pos1", "rep2", "n2", "pos2")

    def _band(self, n: Column) -> Column:
        """Sizes that the length filter lets meet are in one band or in neighbouring ones; 1e-6 covers rounding."""
        width = max(math.log(100 / self.percent), 0.01) * (1 + 1e-6)
        return F.floor(F.log(n.cast("double")) / F.lit(width)).cast("int")

    def _verified(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """Suffix filter, then the exact overlap, once per pair."""
        c = F.col
        slots = classes.select("rep", c("n").cast("int").alias("n"), "histogram")
        named = lambda s: slots.select(c("rep").alias(s), c("n").alias(f"n{s}"), c("histogram").alias(f"h{s}"))
        apart = F.aggregate(
            F.zip_with("ha", "hb", lambda p, q: F.abs(p - q)), F.lit(0), lambda total, d: total + d
        )
        # |x - y| + |y - x| is at least the histograms' distance and at most na + nb - 2 * needed overlap.
        near = pairs.join(named("a"), ["a", "na"]).join(named("b"), ["b", "nb"]).where(
            F.lit(100 + self.percent) * (c("na") + c("nb") - apart) >= 2 * self._needed(c("na"), c("nb"))
        )
        near = materialize(near.select("a", "b", "na", "nb"), "candidates")
        if near.isEmpty():
            return near.select("a", "b")
        ids = near.select(c("a").alias("rep")).union(near.select(c("b").alias("rep"))).distinct()
        wanted = materialize(classes.join(ids, "rep").select(c("rep").alias("doc_id"), "sig1").distinct(), "wanted")
        sets = materialize(
            self._sieved(wanted)._representatives(wanted).mapInArrow(_sets(self.k), "rep long, n int, shingles array<long>"), "sets"
        )
        of = lambda s: sets.select(c("rep").alias(s), c("n").alias(f"n{s}"), c("shingles").alias(f"s{s}"))
        both = near.join(of("a"), ["a", "na"]).join(of("b"), ["b", "nb"])
        overlap = F.size(F.array_intersect("sa", "sb"))
        return materialize(
            both.where(F.lit(100 + self.percent) * overlap >= self._needed(c("na"), c("nb"))).select("a", "b"), "links"
        )


def jaccard_components(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75,
    hot_postings: int = HOT_POSTINGS, meeting: int = MEETING,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row; texts link when 100 * overlap >= percent * union.

    A set holds the distinct runs of ``k`` lower-cased (A-Z) words; fewer words are one run; no words (null,
    empty or blank text) give an empty set, linked with nothing and its own component. Rows that share an id
    share its links, also with different texts. A null id gets a null component. Other columns are ignored, whatever their names. An
    empty table gives an empty result. Sets are compared by 64-bit hashes of their runs.
    """
    if not 0 < percent <= 100 or not 0 < k < 15:
        raise ValueError("percent must be in 1..100 and k in 1..14")
    bound_batches(documents.sparkSession)  # a worker holds the hashes of a batch beside its texts
    texts = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return _Join(texts, k, percent, hot_postings, meeting).run()
