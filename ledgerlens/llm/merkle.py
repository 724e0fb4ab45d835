"""Manifest of a dataset as a hash tree: a leaf per row, a tree per branch, a root over the branches' trees.

Every level is one aggregation by parent. Conditional aggregates spread the digests of a parent's children into as
many columns as the tree's fan-out; the concatenated columns are hashed to the parent, and without a child's own
column they are that child's siblings. Rows of one block of neighbouring leaves lie in one partition, so that all the
levels inside a block need no further shuffle; the tops of the blocks are the leaves of the next round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .numbering import numbered

#: A block holds at most so many leaves, and so many paths from its top are in one row.
BLOCK_LEAVES = 256
_PATH = "array<struct<left: string, right: string>>"


def tagged(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated inputs."""
    return F.sha2(F.concat(F.lit(""), *inputs), 256)


def _levels(fanout: int) -> int:
    levels = 1
    while fanout ** (levels + 1) <= BLOCK_LEAVES:
        levels += 1
    return levels


def _level(nodes: DataFrame, fanout: int) -> DataFrame:
    """The parents of nodes; a branch that has come down to one node keeps it."""
    # Not called size: inside a lambda, a name would mean the new column of that name.
    slot, more = F.pmod("node", F.lit(fanout)), F.col("before") > 1
    child = [F.coalesce(f"c{i}", F.lit("")) for i in range(fanout)]
    pivoted = nodes.groupBy("branch", "block", F.expr(f"node div {fanout}").alias("node")).agg(
        F.max("size").alias("before"),
        *[F.max(F.when(slot == i, F.col("digest"))).alias(f"c{i}") for i in range(fanout)],
        *[F.first(F.when(slot == i, F.col("members")), ignorenulls=True).alias(f"m{i}") for i in range(fanout)],
    )

    def climbed(i: int) -> Column:
        """The members below child i, with its siblings at the end of their paths."""
        left, right = F.concat(F.lit(""), *child[:i]), F.concat(F.lit(""), *child[i + 1 :])
        step = F.when(more, F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(F.array().cast(_PATH))
        longer = F.transform(f"m{i}", lambda m: F.struct(m["item"].alias("item"), F.concat(m["path"], step).alias("path")))
        return F.coalesce(longer, F.slice("m0", 1, 0))

    members = F.concat(*[climbed(i) for i in range(fanout)])
    return pivoted.select(
        "branch",
        "block",
        "node",
        F.expr(f"(before + {fanout - 1}) div {fanout}").alias("size"),
        F.when(more, digest(*child)).otherwise(F.col("c0")).alias("digest"),
        members.alias("members"),
    )


def _blocks(nodes: DataFrame, item: Column, fanout: int) -> DataFrame:
    """The top of each block of neighbouring ``(branch, place, size, digest)`` rows, with the path of each of them."""
    levels = _levels(fanout)
    member = F.struct(item.alias("item"), F.array().cast(_PATH).alias("path"))
    block = nodes.select(
        "branch",
        F.expr(f"place div {fanout**levels}").alias("block"),
        F.col("place").alias("node"),
        "size",
        "digest",
        F.array(member).alias("members"),
    ).repartition("branch", "block")
    for _ in range(levels):
        block = _level(block, fanout)
    return block.select("branch", F.col("block").alias("place"), "size", "digest", "members")


def _climb(nodes: DataFrame, item: Column, fanout: int, name: str) -> list[DataFrame]:
    """Blocks of blocks, until every branch has one node."""
    rounds = [materialize(_blocks(nodes, item, fanout), f"{name}-0")]
    while (rounds[-1].agg(F.max("size")).first()[0] or 1) > 1:
        below = rounds[-1].select("branch", "place", "size", "digest")
        rounds.append(materialize(_blocks(below, F.struct("place"), fanout), f"{name}-{len(rounds)}"))
    return rounds


def _descend(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """The items of the lowest round with their whole paths; ``top``: ``branch``, ``above`` and what else to carry down."""
    carried = [c for c in top.columns if c not in ("branch", "above")]
    upper = top.withColumn("place", F.lit(0).cast("long"))
    for i, blocks in reversed(list(enumerate(rounds))):
        upper = upper.withColumnsRenamed({"branch": "_branch", "place": "_place"})
        same = (F.col("branch") == F.col("_branch")) & (F.col("place") == F.col("_place"))
        opened = blocks.join(upper, same).select("branch", *carried, "above", F.explode("members").alias("member"))
        upper = opened.select(
            "branch", *carried, F.concat("member.path", "above").alias("above"), *(["member.item.place"] if i else ["member.item.*"])
        )
    return upper


def merkle_manifest(
    documents: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    branch: str = "lang",
    found: dict[str, Column] | None = None,
    fanout: int = 2,
) -> DataFrame:
    """Per row: ``key``, ``leaf``, ``subroot`` of its branch, ``root``, ``proof``, ``folded_root`` and ``verified``.

    A leaf is the digest of ``columns``. Leaves of a branch ascend by ``key``, ``fanout`` neighbours at a time become
    a node, a last group of fewer, too, until one is left: the subroot. Subroots, by branch in UTF-8 byte order, give
    the root likewise. ``proof`` holds the digests left and right of the path for each level from leaf to root.
    ``found`` gives columns as a later reader finds them (over the columns of ``documents``): the leaf of the found row
    is folded with the proof, and ``verified`` tells whether that gives the root.

    Nulls in any column are hashed as ``-``; a null branch is a branch of its own, before all others, and a null key
    sorts first. Rows that share a key are ordered by their leaves, equal rows get neighbouring places. A branch of one
    row has its leaf for a subroot. An empty table gives an empty manifest. Other columns of ``documents`` are ignored,
    whatever their names.
    """
    found = found or {}
    value = {c: F.col(f"`{c}`") for c in columns}
    leaf = digest(*[tagged(value[c]) for c in columns])
    later = digest(*[tagged(found.get(c, value[c])) for c in columns])
    changed = F.lit(False)
    for c, seen in found.items():
        changed = changed | ~seen.eqNullSafe(value[c])
    # '-' sorts before ':', so the null branch comes first.
    name = F.coalesce(F.concat(F.lit(":"), F.col(f"`{branch}`").cast("string")), F.lit("-"))
    leaves = documents.select(
        name.alias("branch"),
        F.col(f"`{key}`").alias("key"),
        leaf.alias("digest"),
        F.when(changed, later).alias("found"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = numbered(materialize(leaves, "leaves"), "branch", ["key", "digest", "row"], "ranked-leaves")
    rounds = _climb(placed, F.struct("key", F.col("digest").alias("leaf"), "found"), fanout, "tree")

    subroots = rounds[-1].select(F.lit("").alias("all"), F.col("branch").alias("name"), "digest")
    ranked = numbered(subroots, "all", ["name"], "ranked-subroots").withColumnRenamed("all", "branch")
    over = _climb(ranked, F.struct("name", F.col("digest").alias("subroot")), fanout, "top")
    top = over[-1].select("branch", F.array().cast(_PATH).alias("above"), F.col("digest").alias("root"))
    top = _descend(over, top).select(F.col("name").alias("branch"), "above", "root", "subroot")

    rows = _descend(rounds, top)
    folded = F.aggregate("above", F.coalesce("found", "leaf"), lambda below, step: digest(step["left"], below, step["right"]))
    return rows.select(
        F.col("key").alias(key), "leaf", "subroot", "root", F.col("above").alias("proof"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_text(proof: Column) -> Column:
    """The siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")
