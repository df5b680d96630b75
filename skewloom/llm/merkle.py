"""A Merkle manifest of a table: one hash tree per group, one over the groups' roots, and a proof for every row.

Trees are cut into superblocks of `fanout` ** `levels` neighbouring nodes. Going up, each superblock is reduced to its
top, the tops of 4,096 leaves being the nodes of the next round, so a tree of any size takes few rounds and no task ever
holds more than a superblock. Going down, the nodes of a superblock are cogrouped with the one row that says which outer
nodes complete their proofs; in the last round these are the leaves, and reduction, proof and folding happen together.

Digests are 32 bytes in tables and lowercase hex where they are hashed again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .ranking import numbered

FANOUT = 8
LEVELS = 4
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PATH = "tree string, block long, at array<int>, others array<string>, subroot binary, root binary"


def field(value: Column) -> Column:
    """`-` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


def run_digest(parts: Sequence[bytes]) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


def reduced(nodes: list[bytes], height: int, fanout: int) -> list[list[bytes]]:
    """The nodes and each level above them; a last run that is shorter is hashed alike."""
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([run_digest(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def siblings(levels: list[list[bytes]], fanout: int) -> list[list[bytes]]:
    """For each level but the top, what else stands in the run of each node."""
    found = []
    for nodes in levels[:-1]:
        found.append([])
        for start in range(0, len(nodes), fanout):
            run = nodes[start : start + fanout]
            found[-1] += [b"".join(run[:i] + run[i + 1 :]) for i in range(len(run))]
    return found


def folded(digest: bytes, path: Sequence[tuple[int, bytes]]) -> bytes:
    """The root that a node and its siblings give; at each level `at` siblings stand before the node."""
    for at, others in path:
        digest = run_digest((others[: 64 * at], digest, others[64 * at :]))
    return digest


def with_height(nodes: DataFrame, fanout: int) -> DataFrame:
    """`height`: how often a tree of `size` nodes is reduced until one remains."""
    steps, reach = [], 1
    while reach < 1 << 62:
        steps.append((F.col("size") > reach).cast("int"))
        reach *= fanout
    return nodes.withColumn("height", sum(steps[1:], steps[0]))


def superblock(fanout: int, levels: int) -> Column:
    return F.expr(f"position div {fanout**levels}").alias("block")


def hex_bytes(digests: pd.Series) -> list[bytes]:
    return [bytes(x).hex().encode() for x in digests]


def tops(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, position, height, node): the superblocks of `nodes`, each reduced to its top."""

    def reduce(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("position")
        height = int(group["height"].iloc[0])
        top = reduced(hex_bytes(group["node"]), min(height, levels), fanout)[-1][0]
        row = {"tree": key[0], "position": key[1], "height": max(0, height - levels), "node": bytes.fromhex(top.decode())}
        return pd.DataFrame([row])

    grouped = nodes.select("tree", superblock(fanout, levels), "position", "height", "node").groupBy("tree", "block")
    return grouped.applyInPandas(reduce, "tree string, position long, height int, node binary")


def climb(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """`nodes` and the stored table of each round above it; the last has one row for each tree."""
    rounds = [nodes]
    highest = nodes.agg(F.max("height")).first()[0] or 0
    for _ in range(-(-highest // levels)):
        rounds.append(store(tops(rounds[-1], fanout, levels), "superblocks"))
    return rounds


def cogrouped(nodes: DataFrame, paths: DataFrame, finish: Callable, schema: str, fanout: int, levels: int) -> DataFrame:
    """`finish(nodes, path, outer)` of each superblock and its one row of `paths`.

    path(i): (place in its run, digests of the others) at each level from the superblock's i-th node up to the root.
    """

    def run(key: tuple, group: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("position").reset_index(drop=True)
        height = min(int(group["height"].iloc[0]), levels)
        inner = siblings(reduced(hex_bytes(group["node"]), height, fanout), fanout)
        rest = [(int(a), o.encode()) for a, o in zip(outer["at"].iloc[0], outer["others"].iloc[0])]

        def path(i: int) -> list[tuple[int, bytes]]:
            return [(i // fanout**level % fanout, others[i // fanout**level]) for level, others in enumerate(inner)] + rest

        return finish(group, path, outer.iloc[0])

    left = nodes.withColumn("block", superblock(fanout, levels)).groupBy("tree", "block")
    return left.cogroup(paths.groupBy("tree", "block")).applyInPandas(run, schema)


def passed_on(group: pd.DataFrame, path: Callable, outer: pd.Series) -> pd.DataFrame:
    """Paths of the superblocks whose tops these nodes are, or, for subroots, of the trees they are the roots of."""
    subroots, n = "of" in group, len(group)
    steps = [path(i) for i in range(n)]
    return pd.DataFrame({
        "tree": group["of"] if subroots else group["tree"],
        "block": [0] * n if subroots else group["position"],
        "at": [[at for at, _ in s] for s in steps],
        "others": [[others.decode() for _, others in s] for s in steps],
        "subroot": group["node"] if subroots else [outer["subroot"]] * n,
        "root": [outer["root"]] * n,
    })


def proved(group: pd.DataFrame, path: Callable, outer: pd.Series) -> pd.DataFrame:
    """What is known of each leaf in the end; a leaf that is presented as another is folded as that."""
    proofs, roots = [], []
    for i, (own, other) in enumerate(zip(group["node"], group["presented"])):
        steps = path(i)
        proofs.append(sha256(b"".join(others for _, others in steps)).hexdigest())
        roots.append(folded(bytes(own if other is None else other).hex().encode(), steps).decode())
    root = bytes(outer["root"]).hex()
    return pd.DataFrame({
        "key": group["key"],
        "leaf": [x.decode() for x in hex_bytes(group["node"])],
        "subroot": bytes(outer["subroot"]).hex(),
        "root": root,
        "proof_sha256": proofs,
        "folded_root": roots,
        "verified": [r == root for r in roots],
    })


def prove(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of each of `leaves` (tree, key, node, presented).

    tree: a `field`; trees ascend by its value, null first. A tree's leaves ascend by key (null first), equal keys by
    digest; rows that repeat are leaves of their own, with proofs in some order. presented: a digest to fold in place of
    the leaf's own, or null. An empty table has no root and gives no row.
    """
    kind = leaves.schema["key"].dataType.simpleString()
    placed = with_height(numbered(store(leaves, "leaves"), "tree", ["key", "node"], "sorted-leaves"), fanout).drop("size")
    placed = store(placed, "placed-leaves")
    rounds = climb(placed, fanout, levels)
    value = F.when(F.col("tree") != "-", F.expr("substring(tree, instr(tree, ':') + 1)")).alias("value")
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), value, "node")
    upper = with_height(numbered(store(subroots, "subroots"), "tree", ["value"], "sorted-subroots"), fanout)
    upper_rounds = climb(store(upper.drop("size", "value"), "placed-subroots"), fanout, levels)
    empty = [F.array().cast("array<int>").alias("at"), F.array().cast("array<string>").alias("others")]
    paths = upper_rounds[-1].select(
        "tree", F.lit(0).cast("long").alias("block"), *empty, F.col("node").alias("subroot"), F.col("node").alias("root")
    )
    for nodes in [*reversed(upper_rounds[1:-1]), upper_rounds[0], *reversed(rounds[1:-1])]:
        paths = store(cogrouped(nodes, paths, passed_on, PATH, fanout, levels), "paths")
    schema = f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return cogrouped(placed, paths, proved, schema, fanout, levels)


def document_leaves(documents: DataFrame) -> DataFrame:
    """Leaves of documents (doc_id, source, lang, n_chars, text), one tree for each lang.

    Where 3 divides the crc32 of the id, a tampered leaf is presented: that of the text with A-Z in lower case. A null id
    is not tampered with; a null text stays null. Other columns are no part of a leaf.
    """
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = leaf_digest([*columns[:4], F.translate("text", UPPER, UPPER.lower())])
    return documents.select(
        field(F.col("lang")).alias("tree"),
        F.col("doc_id").alias("key"),
        leaf_digest(columns).alias("node"),
        F.when(chosen, tampered).alias("presented"),
    )


def merkle_manifest(documents: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each document; see `prove`."""
    return prove(document_leaves(documents), fanout, levels).withColumnRenamed("key", "doc_id")
