"""Conversations from reply trees.

Messages form trees by their parents. Every root-to-leaf path is one possible conversation; each tree's best ones by score
are written with a template. Self-joins find the paths:

1. Ancestors are found by doubling: round k joins each message with its 2**k-th ancestor, so a path of a thousand messages
   takes ten rounds. Depths and sums of scores are added up on the way.
2. Leaves are ranked in their tree by the mean score of their path.
3. The chosen leaves are expanded by the joins of step 1 in reverse: each round doubles the known part of the paths, and
   each message of a path is met once. Paths that are not chosen are never made.

Only ids and scores take part in that. Texts are moved once: they and the paths are dealt out by tree, and grouped there.

Template: `[INST] ... [/INST]` for user, ` ... </s>` for assistant, `<<SYS>> ... <</SYS>>` for system, and
`[ROLE] name [/ROLE] ... [/TURN]` for all other roles, after one `<s>`. A control string inside a text or a name gets a
backslash behind its first character, and one more if it has some already, so no text can end or begin a turn.
"""

from __future__ import annotations

import re
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store
from .ranking import numbered
from .shared import map_batches

BEGIN = "<s>"
TURNS = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n")}
OTHER = ("[ROLE] ", " [/ROLE] ", " [/TURN]")
CONTROLS = ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[/TURN]")
_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
PLAIN = re.compile(rf"[<\[](?=\\*(?:{_REST}))")
ESCAPED = re.compile(rf"([<\[])\\(?=\\*(?:{_REST}))")


def escaped(text: str) -> str:
    return PLAIN.sub(lambda m: m.group() + "\\", text)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def written(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(role, text) turns in the template, and the loss mask: where assistant texts start and end, in code points."""
    parts, mask, at = [BEGIN], [], len(BEGIN)
    for role, text in turns:
        before, after = TURNS.get(role) or (f"{OTHER[0]}{escaped(role)}{OTHER[1]}", OTHER[2])
        text = escaped(text)
        start = at + len(before)
        if role == "assistant":
            mask.append((start, start + len(text)))
        parts += [before, text, after]
        at = start + len(text) + len(after)
    return "".join(parts), mask


def read(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], len(BEGIN)

    def until(mark: str) -> str:
        nonlocal at
        start, at = at, formatted.index(mark, at)
        found = unescaped(formatted[start:at])
        at += len(mark)
        return found

    while at < len(formatted):
        for role, (before, after) in [*((r, TURNS[r]) for r in ("user", "system")), ("", OTHER[::2]), ("assistant", TURNS["assistant"])]:
            if formatted.startswith(before, at):
                at += len(before)
                turns.append((role or until(OTHER[1]), until(after)))
                break
        else:
            raise ValueError(f"no turn begins at {at}")
    return turns


def jumps(links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, depth, total) of each message that a root is above, and tables (tree, node, up) of 2**k-th ancestors.

    links: (tree, node, up, total) of single messages. A message whose parent does not exist is a root. Messages on a
    circle, or below one, have no root and are left out. A message that has reached its root takes part in no further
    round, so the work follows the messages times the logarithm of their own depths.
    """
    bound = links.count()
    there = links.select("tree", F.col("node").alias("up"), F.lit(True).alias("there"))
    known = links.join(there, ["tree", "up"], "left").withColumn("up", F.when(F.col("there"), F.col("up")))
    known = store(known.select("tree", "node", "up", F.lit(1).cast("long").alias("depth"), "total"), "ancestors")
    done, rising, tables = [known.filter("up IS NULL")], known.filter("up IS NOT NULL"), []
    while rising.limit(1).take(1) and 1 << len(tables) <= 2 * bound:
        tables.append(rising.select("tree", "node", "up"))
        reached = reduce(DataFrame.unionByName, [*done, rising])
        reached = reached.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("add"))
        risen = rising.join(reached, ["tree", "up"])
        risen = risen.select("tree", "node", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("add")).alias("total"))
        risen = store(risen, "ancestors")
        done.append(risen.filter("up IS NULL"))
        rising = risen.filter("up IS NOT NULL")
    return reduce(DataFrame.unionByName, done).drop("up"), tables


def chosen_paths(links: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, height): the messages of the `branches` best root-to-leaf paths of each tree.

    links: (tree, node, parent, score); tree is not null, a null score counts as 0, rows of one node are one. A path's
    score is the mean of its messages'; equal ones go to the longer path, then to the lesser leaf. height: distance from
    the leaf.
    """
    nodes = links.groupBy("tree", "node").agg(F.min("parent").alias("up"), F.coalesce(F.max("score"), F.lit(0.0)).alias("total"))
    nodes = store(nodes, "links")
    summed, tables = jumps(nodes)
    leaves = summed.join(nodes.select("tree", F.col("up").alias("node")), ["tree", "node"], "left_anti")
    order = [(F.col("total") / F.col("depth")).desc(), F.col("depth").desc(), F.col("node")]
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(*order))
    best = leaves.withColumn("rank", rank).filter(F.col("rank") <= branches)
    parts = [store(best.select("tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("height")), "paths")]
    for k, table in reversed(list(enumerate(tables))):
        above = reduce(DataFrame.unionByName, parts).join(table, ["tree", "node"])
        above = above.select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("height") + (1 << k)).alias("height"))
        parts.append(store(above, "paths"))
    return reduce(DataFrame.unionByName, parts)


def formatted_paths(paths: DataFrame, texts: DataFrame) -> DataFrame:
    """(tree, leaf, rank, formatted, mask): each path of `paths` in the template, from `texts` (tree, node, role, text).

    A null role or text is empty. Messages with one node follow one another, by role and text. A path is one value, made
    in one task; everything before it is spread out.
    """
    of = f"struct<leaf: {paths.schema['leaf'].dataType.simpleString()}, rank: int, height: bigint>"
    text = F.when(F.col("of").isNull(), F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    nothing = {c: F.lit(None).cast(kind).alias(c) for c, kind in (("role", "string"), ("text", "string"), ("of", of))}
    ours = texts.select("tree", "node", "role", "text", nothing["of"])
    theirs = paths.select("tree", "node", nothing["role"], nothing["text"], F.struct("leaf", "rank", "height").cast(of).alias("of"))
    # Dealt out by tree once; both groupings find the rows where they need them.
    rows = ours.unionByName(theirs).repartition("tree")
    met = rows.groupBy("tree", "node").agg(F.collect_list("of").alias("ofs"), F.collect_list(text).alias("said"))
    turns = met.select("tree", "said", F.explode("ofs").alias("of")).select("tree", "of", F.explode("said").alias("said"))
    turn = F.struct((-F.col("of.height")).alias("place"), "said.role", "said.text")
    turns = turns.select("tree", F.col("of.leaf").alias("leaf"), F.col("of.rank").alias("rank"), turn.alias("turn"))
    grouped = turns.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    kind = paths.schema["leaf"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        made = [written([(t["role"], t["text"]) for t in batch.column(3)[i].as_py()]) for i in range(batch.num_rows)]
        masks = [[{"start": a, "end": b} for a, b in mask] for _, mask in made]
        return {"tree": batch.column(0), "leaf": batch.column(1), "rank": batch.column(2), "formatted": [f for f, _ in made], "mask": masks}

    schema = f"tree string, leaf {kind}, rank int, formatted string, mask array<struct<start: long, end: long>>"
    return map_batches(grouped, run, schema, rows=500)


def tree_key(column: str) -> Column:
    """A text for each value, other than null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def of_key(kind: str) -> Column:
    return F.when(F.col("tree") != "-", F.expr("substring(tree, 2)")).cast(kind)


def format_reply_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """conv_id, rank, leaf, formatted, mask: the best paths of each tree of `messages` (conv_id, node, parent, score, role, text)."""
    rows = messages.withColumn("tree", tree_key("conv_id"))
    made = formatted_paths(chosen_paths(rows.select("tree", "node", "parent", "score"), branches), rows)
    return made.withColumn("conv_id", of_key(messages.schema["conv_id"].dataType.simpleString())).drop("tree")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, rank, leaf, formatted, mask of each conversation (conv_id, turn, role, text): a tree with one path.

    A turn replies to the one before it; turns go by number, null first, equal ones by role and a hash of the text. Rows
    that repeat are turns of their own, next to each other. Rows without a conv_id are one conversation.
    """
    marks = [F.col(c).isNull() for c in ("turn", "role", "text")]
    rows = conversations.select(tree_key("conv_id").alias("tree"), "turn", "role", "text")
    rows = rows.withColumn("node", F.xxhash64("turn", "role", "text", *marks))
    ids = store(rows.select("tree", "turn", "role", "node").distinct(), "turns")
    placed = store(numbered(ids, "tree", ["turn", "role", "node"], "ranked-turns").select("tree", "node", "position"), "placed-turns")
    before = placed.select("tree", F.col("node").alias("parent"), (F.col("position") + 1).alias("position"))
    links = placed.join(before, ["tree", "position"], "left").select("tree", "node", "parent", F.lit(None).cast("double").alias("score"))
    made = formatted_paths(chosen_paths(links), rows)
    return made.withColumn("conv_id", of_key(conversations.schema["conv_id"].dataType.simpleString())).drop("tree")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from what was written."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        found = []
        for i in range(batch.num_rows):
            text = batch.column(1)[i].as_py()
            turns = read(text)
            loss = "".join(unescaped(text[m["start"] : m["end"]]) for m in batch.column(2)[i].as_py())
            told = "".join(f"{role}\n{said}\n" for role, said in turns)
            digests = [sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (told, loss)]
            found.append((len(turns), digests[0], len(loss), digests[1], len(text)))
        names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        return {"conv_id": batch.column(0), **{name: [x[k] for x in found] for k, name in enumerate(names)}}

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_batches(formatted.select("conv_id", "formatted", "mask"), run, schema, rows=500)
