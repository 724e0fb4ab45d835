"""Repeatable splits and samples, drawn from a digest of the row's key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import digest, poisson_weight, uniform


def split_column(key: Column, train_fraction: float = 0.8, seed: int = 42) -> Column:
    """``train`` or ``test``."""
    return F.when(uniform(F.lit(seed), key) < train_fraction, "train").otherwise("test")


def split(
    df: DataFrame, train_fraction: float = 0.8, seed: int = 42, key: str = "transaction_id"
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows. Row-wise: no shuffle, the same rows on every run and partitioning."""
    part = split_column(F.col(key), train_fraction, seed)
    return df.filter(part == "train"), df.filter(part == "test")


def undersample(
    df: DataFrame,
    label: str = "tx_fraud",
    key: str = "transaction_id",
    seed: int = 42,
    classes: Sequence[int] = (0, 1),
    prefix_digits: int = 4,
    ranked_rows: int = 1_000_000,
) -> DataFrame:
    """As many rows of each class as the smallest class has: those with the smallest digests.

    A sort of a class in one task is avoided by a radix selection (``digest_cuts``): rows below the prefix at which a
    class reaches its quota are kept as they are, and only the rows that share it, at most ``ranked_rows``, are ranked.
    Rows of one key are told apart by a hash of all their columns, and equal rows are ranked as one row with its number.
    """
    whole_row = F.lpad(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), 16, "0")
    drawn = df.filter(F.col(label).isin(*classes)).withColumn("_digest", F.concat(digest(F.lit(seed), F.col(key)), whole_row))
    counts = {r[0]: r[1] for r in drawn.groupBy(label).agg(F.count(F.lit(1))).collect()}
    quota = min(counts.values(), default=0)
    cuts = digest_cuts(drawn, label, dict.fromkeys(counts, quota), prefix_digits, ranked_rows)
    if not cuts:
        return drawn.select(*df.columns)
    below = reduce(or_, [(F.col(label) == c) & (F.substring("_digest", 1, len(p)) < p) for c, (p, _) in cuts.items()])
    at_cut = drawn.filter(_at(cuts, label)).groupBy(*df.columns, "_digest").agg(F.count(F.lit(1)).alias("_copies"))
    before = Window.partitionBy(label).orderBy("_digest", key).rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.lit(0)
    for value, (_, left) in cuts.items():
        wanted = F.when(F.col(label) == value, F.lit(left)).otherwise(wanted)
    taken = F.least("_copies", wanted - F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    ranked = at_cut.withColumn("_taken", taken).filter("_taken > 0")
    chosen = ranked.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_taken").cast("int"))))
    return drawn.filter(below).select(*df.columns).unionByName(chosen.select(*df.columns))


def _at(cuts: dict[int, tuple[str, int]], label: str) -> Column:
    return reduce(or_, [(F.col(label) == c) & F.startswith("_digest", F.lit(p)) for c, (p, _) in cuts.items()])


def digest_cuts(
    drawn: DataFrame, label: str, quotas: dict[int, int], digits: int, ranked_rows: int, length: int = 48
) -> dict[int, tuple[str, int]]:
    """Per class, the prefix of ``_digest`` at which its quota is reached and how many of its rows are still wanted.

    Each round counts the rows at the cut by ``digits`` more digits, map-side, so that a task sees ``16**digits`` counts
    and never rows; a class is done when ``ranked_rows`` or fewer rows share its prefix, or no digit is left.
    """
    cuts = {c: ("", n) for c, n in quotas.items() if n > 0}
    unfinished = dict(cuts)
    while unfinished:
        depth = len(next(iter(unfinished.values()))[0]) + digits
        wanted = F.lit(0)
        for value, (_, left) in unfinished.items():
            wanted = F.when(F.col(label) == value, F.lit(left)).otherwise(wanted)
        by_prefix = Window.partitionBy(label).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
        reached = (
            drawn.filter(_at(unfinished, label))
            .groupBy(label, F.substring("_digest", 1, depth).alias("_prefix"))
            .agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_upto", F.sum("_n").over(by_prefix))
            .filter((F.col("_upto") >= wanted) & (F.col("_upto") - F.col("_n") < wanted))
        )
        rows = reached.select(label, "_prefix", (wanted - F.col("_upto") + F.col("_n")).alias("_left"), "_n").collect()
        unfinished = {r[0]: (r["_prefix"], r["_left"]) for r in rows if r["_n"] > ranked_rows and depth < length}
        cuts.update({r[0]: (r["_prefix"], r["_left"]) for r in rows})
    return cuts


def sample_classes(df: DataFrame, fractions: dict[int, float], label: str = "tx_fraud", seed: int = 42) -> DataFrame:
    """Approximate undersampling: each class at its own rate, in one pass."""
    return df.sampleBy(label, fractions, seed)


def bootstrap(
    df: DataFrame, replicates: int = 5, fraction: float = 0.1, seed: int = 42, key: str = "transaction_id"
) -> DataFrame:
    """Rows drawn with replacement: ``replicate`` 1..n and ``weight``, the number of times drawn.

    Rows of weight 0 are left out. Nothing is shuffled and no row is copied ``weight`` times.
    """
    numbers = F.sequence(F.lit(1), F.lit(replicates))
    weight = poisson_weight(uniform(F.lit(seed), F.col("replicate"), F.col(key)), fraction)
    return df.select("*", F.explode(numbers).alias("replicate")).withColumn("weight", weight).filter("weight > 0")
