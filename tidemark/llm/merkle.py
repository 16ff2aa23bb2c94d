"""Merkle manifest of a dataset: a digest of every row, of every group and of the whole.

A group's rows are the leaves of a tree in which runs of three nodes become one, until one is
left; the groups' digests are the leaves of another such tree, whose last node is the root.

Leaves are cut into superblocks of 3^8 consecutive ones.  A superblock is aligned with the tree,
so it can be reduced by itself; its digest is a node of the next layer, which is cut into
superblocks again, until every group has one node.  On the way down each
superblock of a layer meets the *outer nodes* it needs: the siblings on the path from its digest to the
root.  Nodes and outer nodes are cogrouped by superblock; one call finishes the
local reduction, joins local and outer siblings to a proof, and folds it.
A group with most of all rows is many superblocks; no task sees more than one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidemark.llm.common import sized, table

ARITY = 3
DEPTH = 8  # levels in a superblock
HEX = 64  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value: Column) -> Column:
    """A field as ``-`` if null, else its number of bytes, a colon and the field."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*(encoded(x) for x in fields)), 256)


def levels(nodes: list[str], whole: bool, depth: int = DEPTH) -> list[list[str]]:
    """The nodes of a superblock, level by level.

    A group's only superblock (``whole``) ends where one node is left, any other after ``depth`` levels.
    """
    out = [nodes]
    while len(out[-1]) > 1 if whole else len(out) <= depth:
        last = out[-1]
        out.append([digest("".join(last[i : i + ARITY])) for i in range(0, len(last), ARITY)])
    return out


def paths(tree: list[list[str]]) -> Iterator[tuple[list[int], list[str]]]:
    """For each node of the lowest level its places in its runs, and the other nodes of these, joined."""
    for i in range(len(tree[0])):
        places, siblings = [], []
        for level in tree[:-1]:
            run, place = level[i - i % ARITY : i - i % ARITY + ARITY], i % ARITY
            places.append(place)
            siblings.append("".join(run[:place] + run[place + 1 :]))
            i //= ARITY
        yield places, siblings


def folded(node: str, places: list[int], siblings: list[str]) -> str:
    """The digest at the end of a path that starts at ``node``."""
    for place, others in zip(places, siblings):
        node = digest(others[: HEX * place] + node + others[HEX * place :])
    return node


class Manifest(NamedTuple):
    """Stored tables of a dataset's tree.

    ``leaves``: (id, claim, group, place, size, digest), ``groups``: (group, place, size, digest),
    ``root``: the digest of all, None for an empty dataset.  ``layers`` and ``group_layers`` hold
    the nodes in between, lowest first.
    """

    leaves: DataFrame
    groups: DataFrame
    root: str | None
    layers: list[DataFrame]
    group_layers: list[DataFrame]


def placed(rows: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """``rows`` (stored) with ``place`` (from 0) and ``size`` (how many) within their group, stored.

    Rows are dealt out by ranges of group and order, so a large group is in many tasks.  A task numbers its
    own; one row per task and group tells how many stand in the tasks before.
    """
    ranged = rows.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
    ranged = table(ranged.withColumn("__id", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("__id", 33)
    counts = ranged.groupBy(*groups, part.alias("__part")).agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    every = Window.partitionBy(*groups)
    before = every.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "__part", "__first", *(F.col(x).alias(f"__{x}") for x in groups),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(every).alias("size"),
    )
    counts = table(counts, "counts")
    same = part == F.col("__part")
    for x in groups:
        same = same & (F.col(x) == F.col(f"__{x}"))
    numbers = (F.col("__before") + F.col("__id") - F.col("__first")).alias("place")
    return table(ranged.join(sized(counts), same).select(*rows.columns, numbers, "size"), "placed")


def block(depth: int) -> Column:
    return F.floor(F.col("place") / ARITY**depth).cast("long")


KEYS = ["named", "group", "block"]


def keyed(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("block", block(depth)).groupBy(*KEYS)


def reduced(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """The layers of nodes above (and with) ``nodes``; in the last one each group has one."""

    def reduce(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        named, group, at = key
        size = int(frame["size"].iloc[0])
        tree = levels(frame.sort_values("place")["digest"].tolist(), size <= ARITY**depth, depth)
        row = (bool(named), group, int(at), -(-size // ARITY**depth), tree[-1][0])
        return pd.DataFrame([row], columns=["named", "group", "place", "size", "digest"])

    layers = [nodes]
    while (layers[-1].agg(F.max("size")).first()[0] or 0) > 1:
        above = keyed(layers[-1].select("named", "group", "place", "size", "digest"), depth)
        schema = "named boolean, group string, place long, size long, digest string"
        layers.append(table(above.applyInPandas(reduce, schema), "layer"))
    return layers


def build(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    claim: Column | None = None,
    depth: int = DEPTH,
) -> Manifest:
    """The tree over the rows of ``docs``.

    A leaf is the digest of ``fields``.  Leaves of a ``group`` ascend by ``order``, nulls first, then by
    digest; rows that are equal in all of that are alike, whichever comes first.  Groups ascend bytewise, a
    null group first.  ``claim`` is another digest for each row, to be checked by ``prove``; by default the
    leaf's own.  An empty table has no root.
    """
    named = F.col(group).isNotNull()
    leaves = docs.select(
        F.col(order).alias("id"),
        named.alias("named"),
        F.coalesce(F.col(group).cast("string"), F.lit("")).alias("group"),
        leaf_digest([F.col(x) for x in fields]).alias("digest"),
        (F.lit(None).cast("string") if claim is None else claim).alias("claim"),
        F.rand(7).alias("tie"),  # lets many equal rows be dealt out to several tasks
    )
    leaves = placed(table(leaves, "leaves"), ["named", "group"], ["id", "digest", "tie"]).drop("tie")
    layers = reduced(leaves, depth)
    # the groups are leaves of one more tree
    tops = layers[-1].select(F.lit(True).alias("whole"), "named", "group", "digest")
    tops = placed(tops, ["whole"], ["named", "group"])
    group_layers = reduced(tops.select(F.lit(True).alias("named"), F.lit("").alias("group"), "place", "size", "digest"), depth)
    root = group_layers[-1].select("digest").first()
    return Manifest(leaves, tops, root and root[0], layers, group_layers)


OUTER = "named boolean, group string, block long, top string, places array<int>, siblings array<string>"


def _outer(layer: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """The outer nodes of the superblocks below ``layer``, whose nodes stand for them."""

    def join(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        named, group, _ = key
        nodes = nodes.sort_values("place")
        tree = levels(nodes["digest"].tolist(), int(nodes["size"].iloc[0]) <= ARITY**depth, depth)
        places, siblings, top = list(above["places"].iloc[0]), list(above["siblings"].iloc[0]), above["top"].iloc[0]
        rows = [(bool(named), group, int(at), top, a + places, b + siblings) for at, (a, b) in zip(nodes["place"], paths(tree))]
        return pd.DataFrame(rows, columns=[x.split()[0] for x in OUTER.split(", ")])

    nodes = layer.select("named", "group", "place", "size", "digest")
    return table(keyed(nodes, depth).cogroup(outer.groupBy(*KEYS)).applyInPandas(join, OUTER), "outer")


def outer_nodes(tree: Manifest, depth: int = DEPTH) -> DataFrame:
    """(named, group, block, top, places, siblings) for each superblock of leaves, stored.

    ``siblings`` are the nodes beside the path from the superblock's digest to the root, joined run by run, and
    ``places`` the path's places in these runs; ``top`` is the digest of the group.
    """
    nothing = F.array().cast("array<int>"), F.array().cast("array<string>")
    first = F.lit(0).cast("long")
    outer = tree.group_layers[-1].select(
        "named", "group", first.alias("block"), F.lit("").alias("top"), nothing[0].alias("places"), nothing[1].alias("siblings")
    )
    for layer in reversed(tree.group_layers[1:]):
        outer = _outer(layer, outer, depth)
    # from the tree of groups to the groups' own trees
    numbers = tree.groups.select(F.lit(True).alias("named"), F.lit("").alias("group"), "place", "size", "digest")
    below = _outer(numbers, outer, depth).select(F.col("block").alias("place"), "places", "siblings")
    outer = below.join(tree.groups, "place").select("named", "group", first.alias("block"), F.col("digest").alias("top"), "places", "siblings")
    outer = table(outer, "outer")
    for layer in reversed(tree.layers[1:]):
        outer = _outer(layer, outer, depth)
    return outer


def prove(tree: Manifest, depth: int = DEPTH, with_paths: bool = False) -> DataFrame:
    """A proof for each leaf: (id, digest, top, proof_sha256, folded_root, verified).

    ``proof_sha256`` is the digest of all siblings on the way to the root, joined.  ``folded_root`` is what they
    give with the row's claim, or with the leaf itself where there is none; it is ``verified`` if that is the root.
    ``with_paths`` adds the proof itself: ``places`` and ``siblings`` run by run.
    """
    root = tree.root
    id_type = tree.leaves.schema["id"].dataType.simpleString()
    schema = "id string, digest string, top string, proof_sha256 string, folded_root string, verified boolean"
    if with_paths:
        schema += ", places array<int>, siblings array<string>"
    names = StructType.fromDDL(schema).names

    def finish(key: tuple, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("place")
        whole = int(leaves["size"].iloc[0]) <= ARITY**depth
        local = levels(leaves["digest"].tolist(), whole, depth)
        places, siblings, top = list(outer["places"].iloc[0]), list(outer["siblings"].iloc[0]), outer["top"].iloc[0]
        rows = []
        for name, leaf, claim, (a, b) in zip(leaves["id"], leaves["digest"], leaves["claim"], paths(local)):
            found = folded(leaf if claim is None else claim, a + places, b + siblings)
            row = (name, leaf, top, digest("".join(b + siblings)), found, found == root)
            rows.append((*row, a + places, b + siblings) if with_paths else row)
        return pd.DataFrame(rows, columns=names)

    leaves = tree.leaves.select(F.col("id").cast("string"), "named", "group", "place", "size", "digest", "claim")
    proofs = keyed(leaves, depth).cogroup(outer_nodes(tree, depth).groupBy(*KEYS)).applyInPandas(finish, schema)
    return proofs.withColumn("id", F.col("id").cast(id_type))


def verify_documents(docs: DataFrame) -> DataFrame:
    """Leaf, group digest, root and proof of each row of ``docs``, and what is left of it after tampering.

    Where 2 divides the CRC of the decimal doc_id, line feeds are deleted from the text before the proof is checked; null
    ids and null texts stay as they are.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(F.contains("text", F.lit("\n")), F.translate("text", "\n", ""))
    others = [F.col(x) for x in FIELDS if x != "text"]
    tampered = F.when(hit & text.isNotNull(), leaf_digest([*others, text]))
    tree = build(docs, claim=tampered)
    return prove(tree).select(
        F.col("id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"),
        F.lit(tree.root).cast("string").alias("root"),
        "proof_sha256",
        "folded_root",
        "verified",
    )
