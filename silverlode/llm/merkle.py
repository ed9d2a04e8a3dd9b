"""A Merkle manifest of a dataset, with the proof of every row, built by a butterfly exchange.

Each row is a leaf; the leaves of a group, in order, form a tree in which `ARITY` consecutive
nodes become their hash (the last ones of a level may be fewer, even one) until one remains, the
group's root. The groups' roots, in order of the groups, form the tree of the dataset.

1. *Leaves* are numbered inside their group by a parallel sort, and dealt into partitions of
   `BLOCK` consecutive places, an aligned power of the arity, so each partition is one subtree.
   Its levels are hashed there, which gives the lower part of every proof.
2. *Butterfly.* Each partition now holds the root of its subtree. In round r, partitions whose
   numbers differ in digit r alone (base `FANOUT`) form a group and swap their roots. Every one
   of them hashes the same ancestors from what the group swapped, and keeps the siblings on its
   own way up. After the last round each partition holds the root and its whole upper proof: no
   pass leads back down. Where the last subtree of a round is short of partitions, its members
   also stand in for the missing ones, each for its share of them.
3. The same two steps over the groups' roots give the tops of the proofs.

A partition's rows and a swapped group have a fixed greatest size (`BLOCK` leaves, `FANOUT`
roots), so a group with all rows of the dataset is spread like any other. A round moves one
narrow row per partition, i.e. per `BLOCK` leaves, and the number of rounds is the logarithm of
the partitions to base `FANOUT`.

Hashes are lowercase hex SHA-256 of their concatenated inputs, digests as hex text. In a leaf a
null is `-`, any other value its UTF-8 byte count, `:` and the value, whole whatever its length.
A null group is a group of its own and comes first; null keys come first in a group. Rows with
equal keys are ordered by their leaf, so repeated rows get neighbouring places. No rows give no
tree. A single row of a group is its root. Other columns of a name of these results are not
returned; the result has the key, the group and what is listed at `manifest`.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.job import Job
from silverlode.operators import add_dense_key, balanced_join

ARITY = 2
# Leaves of a partition and roots swapped in a round: powers of the arity.
BLOCK = 4096
FANOUT = 16

_STEP = "struct<before:string,after:string>"


def value_text(column: Column) -> Column:
    """How a value stands in a leaf: `-` for null, else UTF-8 byte count, `:`, value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(value_text(column) for column in columns)), 256)


def manifest(
    spark: SparkSession, leaves: DataFrame, key: str = "doc_id", group: str = "lang",
    leaf: str = "leaf", keep: Sequence[str] = (), arity: int = ARITY, block: int = BLOCK,
    fanout: int = FANOUT,
) -> DataFrame:
    """(key, group, leaf, the columns of `keep`, subroot, root, path): one row per leaf.

    `path` holds a step per level, up to the root of the dataset: the siblings before and after
    the node, concatenated (both empty where it is alone). `fold` leads from a leaf to the root.
    """
    for size in (block, fanout):
        if arity < 2 or arity ** _levels(size, arity) != size or size < arity:
            raise ValueError("the arity is 2 at least, and block and fanout are powers of it")
    job = Job(spark).part("merkle")
    rows = leaves.select(
        F.col(f"`{group}`").alias("_group"), F.col(f"`{key}`").alias("_key"),
        F.col(f"`{leaf}`").alias("_leaf"),
        F.struct(*(F.col(f"`{name}`") for name in [key, group, leaf, *keep])).alias("_kept"),
    )
    ordered = job.stage(
        add_dense_key(job, rows, ["_group", "_key", "_leaf"], "_place"), "ordered"
    )
    # Each group's first place and size: one row per group, from partial sums.
    groups = ordered.groupBy("_group").agg(
        F.min("_place").alias("_first"), F.count("*").alias("_leaves")
    )
    tagged = groups.select(_tag(F.col("_group")).alias("_of"), "_first", "_leaves")
    tagged = job.stage(add_dense_key(job, tagged, ["_first"], "_number"), "groups")
    nodes = balanced_join(
        job, ordered.withColumn("_tag", _tag(F.col("_group"))), tagged, "_tag", "_of", "inner"
    ).select(
        F.col("_number").alias("tree"), (F.col("_place") - F.col("_first")).alias("place"),
        F.col("_leaves").alias("size"), F.col("_leaf").alias("node"), F.col("_kept").alias("kept"),
    )
    lower = _grow(job, nodes, arity, block, fanout, "lower")
    roots = lower.held.filter("part = 0")
    upper = _grow(job, roots.select(
        F.lit(1).cast("long").alias("tree"), (F.col("tree") - 1).alias("place"),
        F.lit(roots.count()).cast("long").alias("size"), "node",
        F.struct(F.col("tree").alias("number")).alias("kept"),
    ), arity, block, fanout, "upper")
    tops = job.stage(_proved(job, upper, arity).select(
        F.col("kept.number").alias("number"), F.col("path").alias("top"), "root"
    ), "tops")
    held = balanced_join(job, lower.held, tops, "tree", "number", "inner").select(
        "tree", "part", F.concat("up", "top").alias("up"),
        F.struct(F.col("node").alias("subroot"), "root").alias("node"),
    )
    proved = _proved(job, _Grown(lower.parts, job.stage(held, "proofs")), arity)
    return proved.select(
        *(F.col("kept").getField(name).alias(name) for name in [key, group, leaf, *keep]),
        "root.subroot", "root.root", "path",
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(
        path, leaf, lambda node, step: F.sha2(
            F.concat(step["before"], node, step["after"]), 256
        )
    )


def proof_hash(path: Column) -> Column:
    """Hash of all siblings, level by level up to the root, left to right."""
    siblings = F.transform(path, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(siblings, ""), 256)


class _Grown(NamedTuple):
    """The partitions of a forest with the levels inside them, and what the butterfly leaves each
    with: (tree, part, node, up), the tree's root and the way up to it."""

    parts: DataFrame
    held: DataFrame


def _proved(job: Job, grown: _Grown, arity: int) -> DataFrame:
    """(kept, path, root) of every leaf: each partition's levels meet its upper proof."""
    parts = grown.parts.select(F.struct("tree", "part").alias("here"), "below", "kept")
    proofs = grown.held.select(F.struct("tree", "part").alias("at"), "node", "up")
    return balanced_join(job, parts, proofs, "here", "at", "inner").select(
        F.col("node").alias("root"),
        F.explode(_paths(F.col("below"), F.col("kept"), F.col("up"), arity)).alias("leaf"),
    ).select("leaf.kept", "leaf.path", "root")


def _grow(
    job: Job, nodes: DataFrame, arity: int, block: int, fanout: int, name: str
) -> _Grown:
    """The trees over `nodes` (tree, place, size, node, kept)."""
    parts = (
        nodes.groupBy("tree", F.floor(F.col("place") / block).cast("long").alias("part"))
        .agg(
            F.first("size").alias("size"),
            F.sort_array(F.collect_list(F.struct("place", "node", "kept"))).alias("leaves"),
        )
        .select(
            "tree", "part", _shrunk(F.col("size"), block).alias("parts"),
            _climb(F.col("leaves.node"), F.col("size"), block, arity).alias("below"),
            F.col("leaves.kept").alias("kept"),
        )
    )
    parts = job.stage(parts, f"{name}_parts")
    held = parts.select("tree", "part", "parts", _top(F.col("below")).alias("node"))
    greatest = held.agg(F.max("parts")).first()[0] or 1
    held = held.withColumn("up", F.array().cast(f"array<{_STEP}>"))
    reach = 1
    while reach < greatest:
        held = job.stage(_swap(held, reach, arity, fanout), f"{name}_swapped")
        reach *= fanout
    return _Grown(parts, held)


def _swap(held: DataFrame, reach: int, arity: int, fanout: int) -> DataFrame:
    """One round: partitions that differ in one digit alone swap the roots of their subtrees of
    `reach` partitions, and each climbs from its own to that of `fanout` times as many."""
    digit = F.floor(F.col("part") / reach) % fanout
    # The last subtree of a tree lacks `reach - own` partitions; those it has stand in for them
    # where it has siblings, so that each group of this round finds the root of that subtree.
    own = F.col("parts") - F.floor((F.col("parts") - 1) / reach) * reach
    place = F.col("part") % reach
    short = (F.col("part") - place + reach > F.col("parts")) & (own < reach) & (digit > 0)
    stands = F.when(
        short & (place + own < reach), F.sequence(place + own, F.lit(reach - 1).cast("long"), own)
    ).otherwise(F.array().cast("array<bigint>"))
    mine = F.struct(place.alias("slot"), F.lit(True).alias("own"))
    others = F.transform(
        stands, lambda slot: F.struct(slot.alias("slot"), F.lit(False).alias("own"))
    )
    dealt = held.select(
        "*", digit.alias("digit"), F.explode(F.concat(F.array(mine), others)).alias("at")
    )
    met = dealt.groupBy(
        "tree", F.floor(F.col("part") / (reach * fanout)).alias("far"), F.col("at.slot")
    ).agg(
        F.first("parts").alias("parts"),
        F.sort_array(F.collect_list(F.struct(
            "digit", "node", F.col("at.own").alias("own"), "part", "up"
        ))).alias("members"),
    )
    climbed = met.withColumn(
        "levels", _climb(F.col("members.node"), _shrunk(F.col("parts"), reach), fanout, arity)
    )
    return climbed.select(
        "tree", "parts", _top(F.col("levels")).alias("node"), "levels",
        F.explode("members").alias("member"),
    ).filter("member.own").select(
        "tree", F.col("member.part").alias("part"), "parts", "node",
        F.concat(F.col("member.up"), _path(F.col("levels"), F.col("member.digit"), arity))
        .alias("up"),
    )


def _climb(nodes: Column, size: Column, most: int, arity: int) -> Column:
    """Levels of the subtree over `nodes`, the nodes first: as many as `most` nodes have, or as
    a whole level of `size` nodes still needs."""
    needed = sum((F.when(size > arity**k, 1).otherwise(0) for k in range(_levels(most, arity))),
                 F.lit(0))
    steps = F.slice(F.sequence(F.lit(1), F.lit(_levels(most, arity))), F.lit(1), needed)

    def above(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / arity).cast("int"))
        return F.transform(runs, lambda run: F.sha2(
            F.array_join(F.slice(level, run * arity + 1, F.lit(arity)), ""), 256
        ))

    return F.aggregate(
        steps, F.array(nodes),
        lambda levels, _: F.concat(levels, F.array(above(F.element_at(levels, -1)))),
    )


def _top(levels: Column) -> Column:
    """The node that a partition's subtree has come to."""
    return F.element_at(F.element_at(levels, -1), 1)


def _path(levels: Column, place: Column, arity: int) -> Column:
    """The steps of the node at `place` of the first level up to the last level."""
    def step(level: Column, k: Column) -> Column:
        own = F.floor(place / F.pow(F.lit(float(arity)), k)).cast("int")
        first = own - own % arity
        return F.struct(
            F.array_join(F.slice(level, first + 1, own - first), "").alias("before"),
            F.array_join(F.slice(level, own + 2, first + arity - own - 1), "").alias("after"),
        )

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), step)


def _paths(levels: Column, kept: Column, up: Column, arity: int) -> Column:
    """(kept, path) of every leaf of a partition."""
    return F.transform(kept, lambda own, place: F.struct(
        own.alias("kept"), F.concat(_path(levels, place, arity), up).alias("path")
    ))


def _shrunk(size: Column, by: int) -> Column:
    """Number of nodes that `size` nodes become when `by` of them make one."""
    return F.ceil(size / F.lit(by)).cast("long")


def _levels(size: int, arity: int) -> int:
    levels = 0
    while arity**levels < size:
        levels += 1
    return levels


def _tag(group: Column) -> Column:
    """A key that is not null for a null group and differs from any other."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))
