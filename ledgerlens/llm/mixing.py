"""Mixing sources to target weights: a budget passed down a domain - language - source tree.

Every level fills its nodes by weight up to what lies below them (``supply * max_epochs``): a shortage goes to
the siblings first, since the parent's budget stays, and to the parent's siblings only when the whole parent is
short. A leaf takes a prefix of its seeded epochs: whole epochs, then documents in seeded order as long as
their tokens fit.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import digest
from ..session import materialize

LEAF = ("domain", "language", "origin")
#: Leaves that may be broadcast (some 100 bytes each); more are joined by shuffle.
BROADCAST_LEAVES = 50_000
#: Words as runs of anything but blanks.
WORD = r"[^\x20\x09-\x0D]+"


def word_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(weights: Mapping[str, float], default: float, key: str) -> Column:
    out = F.lit(float(default))
    for name, weight in weights.items():
        out = F.when(F.col(key) == name, F.lit(float(weight))).otherwise(out)
    return out


def _fill(nodes: DataFrame, parents: list[str], key: str) -> DataFrame:
    """``share`` of each node: weight * level, at most its cap, with one level per parent.

    In order of cap / weight, the level is the greatest of (budget - caps before) / (weights from here on).
    """
    order = Window.partitionBy(*parents).orderBy(F.col("cap") / F.col("weight"), key)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    steps = nodes.where("weight > 0").withColumn("step", (F.col("budget") - before) / onward)
    level = F.max("step").over(Window.partitionBy(*parents))
    return steps.withColumn("share", F.least(F.col("cap"), F.col("weight") * F.greatest(level, F.lit(0.0)))).drop("step")


def leaf_budgets(
    leaves: DataFrame, budget: Column, domain_weights: Mapping[str, float], language_weights: Mapping[str, float],
    source_weights: Mapping[str, float], max_epochs: int, default_weight: float = 1.0,
) -> DataFrame:
    """Tokens to take from each leaf; ``leaves`` has the leaf columns, ``supply`` and ``docs``.

    ``budget`` is an expression over the total ``supply``. Leaves of weight 0 get nothing.
    """
    weighted = (
        leaves.withColumn("cap", (F.col("supply") * max_epochs).cast("double"))
        .withColumn("w1", _weight(domain_weights, default_weight, "domain"))
        .withColumn("w2", _weight(language_weights, default_weight, "language"))
        .withColumn("w3", _weight(source_weights, default_weight, "origin"))
        .where("w1 > 0 and w2 > 0 and w3 > 0")
    )
    total = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("supply")).select(budget.cast("double").alias("budget"))
    domains = weighted.groupBy("domain").agg(F.sum("cap").alias("cap"), F.first("w1").alias("weight"))
    # One row of totals beside a row per domain.
    domains = _fill(domains.join(F.broadcast(total), F.lit(True)), [], "domain")
    languages = weighted.groupBy("domain", "language").agg(F.sum("cap").alias("cap"), F.first("w2").alias("weight"))
    languages = languages.join(domains.select("domain", F.col("share").alias("budget")), "domain")
    languages = _fill(languages, ["domain"], "language")
    sources = weighted.withColumn("weight", F.col("w3")).join(
        languages.select("domain", "language", F.col("share").alias("budget")), ["domain", "language"]
    )
    filled = _fill(sources, ["domain", "language"], "origin")
    return filled.select(*LEAF, "supply", "docs", F.floor(F.col("share") + 1e-6).cast("long").alias("take"))


def mix(
    documents: DataFrame, domain: Column, budget: Column, domain_weights: Mapping[str, float],
    language_weights: Mapping[str, float], source_weights: Mapping[str, float], seed: int = 0, max_epochs: int = 4,
    default_weight: float = 1.0, tokens: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """The chosen rows: ``row`` (all columns), the leaf, ``n_tokens`` and ``epoch``; a row per epoch it is in.

    ``domain`` is an expression over the documents. A null domain, language or source is the leaf ``unknown``;
    names without a weight get ``default_weight``. Documents without tokens are never chosen. The order of an
    epoch is a digest of seed, epoch and id, then of the text; equal rows stand in any order. The prefix ends
    before the first document that does not fit. An empty table gives an empty result.
    """
    named = lambda c: F.coalesce(c.cast("string"), F.lit("unknown"))
    own = F.struct(*[F.col(f"`{c}`").alias(c) for c in documents.columns])
    df = documents.select(
        own.alias("row"),
        named(domain).alias("domain"),
        named(F.col(f"`{lang_col}`")).alias("language"),
        named(F.col(f"`{source_col}`")).alias("origin"),
        F.col(f"`{id_col}`").alias("key"),
        (F.lit(None) if tokens is None else tokens).cast("long").alias("given"),
    )

    def counted(rows: DataFrame) -> DataFrame:
        """Rows with tokens, and how many; the filter, which Spark moves ahead of joins, ends at the first word."""
        if tokens is not None:
            return rows.withColumn("n_tokens", F.col("given")).where("n_tokens > 0")
        text = F.col(f"row.`{text_col}`").cast("string")
        return rows.where(F.regexp_like(text, F.lit(WORD))).withColumn("n_tokens", word_tokens(text))

    # The budgets and cuts are found on this narrow table; then only texts that are taken are counted again.
    narrow = materialize(counted(df).select(*LEAF, "key", "n_tokens"), "counted")
    totals = narrow.groupBy(*LEAF).agg(F.sum("n_tokens").alias("supply"), F.count(F.lit(1)).alias("docs"))
    leaves = materialize(
        leaf_budgets(
            materialize(totals, "leaves"), budget, domain_weights, language_weights, source_weights, max_epochs, default_weight
        ).where("take > 0"),
        "budgets",
    )
    whole = F.expr("take div supply")
    leaves = leaves.select(
        *LEAF,
        whole.alias("epochs"),
        (F.col("take") - whole * F.col("supply")).alias("rest"),
        # About as many buckets as documents in a bucket.
        F.greatest(F.lit(0), F.ceil(F.log2(F.col("docs").cast("double")) / 2)).cast("int").alias("bits"),
    )
    if leaves.count() <= BROADCAST_LEAVES:
        leaves = F.broadcast(leaves)
    order = F.conv(F.substring(digest(F.lit(str(seed)), F.col("epochs"), F.coalesce(F.col("key").cast("string"), F.lit("null"))), 1, 8), 16, 10)

    def placed(rows: DataFrame) -> DataFrame:
        drawn = rows.join(leaves, list(LEAF)).withColumn("draw", order.cast("long"))
        return drawn.withColumn("bucket", F.expr("shiftright(draw, 32 - bits)"))

    sums = placed(narrow).groupBy(*LEAF, "bucket").agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("bucket"))
    ends = sums.withColumn("upto", upto)
    # The bucket in which the rest runs out, and what is left for it.
    cut = ends.where("upto > rest").groupBy(*LEAF).agg(
        F.min("bucket").alias("cut"), F.min_by(F.col("rest") - F.col("upto") + F.col("tokens"), "bucket").alias("left")
    )
    cut = materialize(cut, "cuts")
    cut = F.broadcast(cut) if cut.count() <= BROADCAST_LEAVES else cut
    judged = placed(df).join(cut, list(LEAF), "left")
    inside = judged.where("cut is null or bucket <> cut").withColumn(
        "copies", F.col("epochs") + F.when(F.col("cut").isNull() | (F.col("bucket") < F.col("cut")), 1).otherwise(0)
    )
    inside = inside.withColumn("copies", F.when(F.col("rest") == 0, F.col("epochs")).otherwise(F.col("copies")))
    inside = counted(inside.where("copies > 0"))
    line = Window.partitionBy(*LEAF).orderBy("draw", "key", F.md5(F.col(f"row.`{text_col}`").cast("string")))
    fits = F.sum("n_tokens").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) <= F.col("left")
    edge = counted(judged.where("bucket = cut")).withColumn("copies", F.col("epochs") + fits.cast("int"))
    chosen = inside.unionByName(edge).where("copies > 0")
    return chosen.select(
        "row", *LEAF, "n_tokens", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))).alias("epoch")
    )
