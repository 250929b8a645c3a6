"""Merkle manifest of a dataset as a persistent tree (operator 11).

Every row is a leaf. Per source the leaves ascend by doc_id; runs of ARITY consecutive nodes get a parent until one node is left,
the source's subroot (a lone leaf is its own). The subroots, ordered by source, get a tree of the same kind; its top is the root.
A node is the hexadecimal SHA-256 of its children's texts one after another.

A tree is built in aligned blocks of ARITY**DEPTH nodes. A block is one row: its members in order and the nodes of all its levels.
The tops of a source's blocks are the members of the next round's blocks, until every source has one block; so a source of any size
is spread over tasks, and the rounds are as many as its size has digits in base ARITY**DEPTH.

A change of one leaf makes a version of the tree that shares all untouched nodes: only the leaf's ancestors are copied. Inside the
first block the copies lie next to the block's own nodes; above it they go on from the leaf's own path through the upper blocks,
which is brought to each lower block by a join of block with block. So no task sees more versions of a node than a block has leaves,
though every version copies the root.

Rows of one source and doc_id are ordered by their leaf. A row without source comes before all others; one without doc_id comes first
in its source and is never tampered with. Null fields count as `-`. An empty table has no rows, no nodes and no root. Other columns
of any name are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.session import materialize

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
ARITY, DEPTH = 3, 6


def field(value: Column) -> Column:
    """`-` for a null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column, fields: list[str]) -> Column:
    """The leaf of a row whose text is `text`."""
    return F.sha2(F.concat(*(field(text if f == "text" else F.col(f)) for f in fields)), 256)


def tampered(every: int = 2) -> Column:
    """Rows whose doc_id has a CRC-32 that `every` divides."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))


def leaves(docs: DataFrame, changed: Column, text: Column, fields: list[str] = FIELDS) -> DataFrame:
    """(tree, doc_id, leaf, changed): one row each; `changed` is the leaf with the new text where it is to change, else null.

    Texts are read here once; all that follows works on digests. `tree` is the source in a form without nulls, in the same order.
    """
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    return docs.select(tree.alias("tree"), "doc_id", leaf_of(F.col("text"), fields).alias("leaf"), F.when(changed, leaf_of(text, fields)).alias("changed"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with `at`, their place from 0 within their tree, and `size`, the number of its rows. Rows are dealt out by ranges of
    (tree, order), so a tree may lie in many tasks; each (task, tree) needs only the number of its tree's rows in earlier tasks."""
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = materialize(ranged.withColumn("row", F.monotonically_increasing_id()), "merkle-order").withColumn("part", F.shiftright("row", 33))
    runs = ranged.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    earlier = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select("tree", "part", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("size"))
    return ranged.join(starts, ["tree", "part"]).withColumn("at", F.col("row") + F.col("shift")).drop("part", "row", "shift")


def parents(nodes: Column, arity: int) -> Column:
    """The parents of consecutive nodes: one for each run of `arity`, the last of which may be shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / arity).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.concat_ws("", F.slice(nodes, i * arity + 1, F.lit(arity))), 256))


def blocks(members: DataFrame, arity: int, depth: int) -> DataFrame:
    """(tree, block, members, levels, blocks): a row for each aligned block, from rows (tree, at, size, digest and others, which go
    along). levels[0] holds the members' digests, the last level one node; `blocks` is their number in the tree. In a tree of several
    blocks all have full depth, since the last one is as deep as the others; a tree of one block ends where one node is left."""
    width = arity**depth
    carried = F.struct("at", "digest", *(c for c in members.columns if c not in ("tree", "at", "size", "digest")))
    made = members.groupBy("tree", F.floor(F.col("at") / width).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(carried)).alias("members"), F.ceil(F.first("size") / width).cast("long").alias("blocks")
    )
    made = made.withColumn("level0", F.col("members.digest"))
    for k in range(depth):
        grows = (F.col("blocks") > 1) | (F.size(f"level{k}") > 1)
        made = made.withColumn(f"level{k + 1}", F.when(grows, parents(F.col(f"level{k}"), arity)))
    levels = F.array_compact(F.array(*(f"level{k}" for k in range(depth + 1))))
    return materialize(made.select("tree", "block", "members", levels.alias("levels"), "blocks"), "merkle-blocks")


def top() -> Column:
    """The one node of a block's last level."""
    return F.element_at(F.element_at("levels", -1), 1)


def grown(members: DataFrame, arity: int, depth: int) -> list[DataFrame]:
    """The blocks of all rounds: those of a round's trees that have several blocks are the members of the next."""
    rounds = [blocks(members, arity, depth)]
    while (rounds[-1].agg(F.max("blocks")).first()[0] or 0) > 1:
        rest = rounds[-1].where("blocks > 1").select("tree", F.col("block").alias("at"), F.col("blocks").alias("size"), top().alias("digest"))
        rounds.append(blocks(rest, arity, depth))
    return rounds


def tops(rounds: list[DataFrame]) -> DataFrame:
    """(tree, top): the one node left of each tree."""
    ended = [r.where("blocks = 1").select("tree", top().alias("top")) for r in rounds]
    made = ended[0]
    for more in ended[1:]:
        made = made.unionByName(more)
    return made


def path(levels: Column, i: Column, arity: int) -> Column:
    """Level by level, the siblings left and right of the i-th member's ancestor, as texts: what a proof shows and a copy keeps."""

    def beside(nodes: Column, k: Column) -> Column:
        own = F.floor(i / F.pow(F.lit(arity), k)).cast("int")
        start = own - own % arity
        left, right = F.slice(nodes, start + 1, own - start), F.slice(nodes, own + 2, start + (arity - 1) - own)
        return F.struct(F.concat_ws("", left).alias("left"), F.concat_ws("", right).alias("right"))

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), beside)


def copied(start: Column, steps: Column) -> Column:
    """`start`, whose last node is changed, and after it the copies of that node's ancestors along the steps."""
    step = lambda made, s: F.concat(made, F.array(F.sha2(F.concat(s["left"], F.element_at(made, -1), s["right"]), 256)))
    return F.aggregate(steps, start, step)


def paths(table: DataFrame, arity: int) -> DataFrame:
    """(tree, block, the members' columns, steps): each member of each block, with its path inside the block."""
    names = table.schema["members"].dataType.elementType.names
    rows = F.transform("members", lambda m, i: F.struct(*(m[n].alias(n) for n in names), path(F.col("levels"), i, arity).alias("steps")))
    rest = [c for c in table.columns if c not in ("members", "levels")]
    return table.select(*rest, F.inline(rows))


def upward(rounds: list[DataFrame], ends: DataFrame, arity: int) -> DataFrame:
    """(tree, block, above and the columns of `ends`): for the first round's blocks, the steps from their top to the top of the tree,
    handed down round by round. `ends` has a row for each tree."""
    above = None
    none = F.array().cast("array<struct<left:string,right:string>>")
    for r in reversed(range(len(rounds))):
        here = rounds[r].where("blocks = 1").select("tree", "block").join(ends, "tree").withColumn("above", none)
        if above is not None:
            inner = paths(rounds[r + 1].join(above, ["tree", "block"]), arity).drop("block", "blocks", "digest").withColumnRenamed("at", "block")
            here = here.unionByName(inner.withColumn("above", F.concat("steps", "above")).drop("steps"))
        above = here
    return above


@dataclass
class Manifest:
    """rows: a row for each leaf: tree, at, doc_id, leaf, changed, steps (the path to the subroot), source_steps (from there to the
    root), subroot, root, and copies: for a changed leaf the nodes of its version that are not shared, from the leaf to the root.
    rounds and source_rounds: the blocks of the sources' trees and of the tree over them."""

    rows: DataFrame
    rounds: list[DataFrame]
    source_rounds: list[DataFrame]
    arity: int
    depth: int

    def nodes(self) -> DataFrame:
        """(tree, level, at, digest): every node of the sources' trees once, the untouched state that all versions share."""
        made = None
        for r, table in enumerate(self.rounds):
            # a level's first node of a block, then the others in order; a top is the next round's member and comes from there
            last = (F.col("blocks") == 1).cast("int")
            shown = table.select("tree", "block", F.posexplode(F.slice("levels", 1, F.size("levels") - 1 + last)).alias("k", "level_nodes"))
            each = shown.select("tree", "block", "k", F.posexplode("level_nodes").alias("i", "digest"))
            at = F.col("block") * F.pow(F.lit(self.arity), F.lit(self.depth) - F.col("k")).cast("long") + F.col("i")
            each = each.select("tree", (F.col("k") + r * self.depth).cast("int").alias("level"), at.alias("at"), "digest")
            made = each if made is None else made.unionByName(each)
        return made

    def versions(self) -> DataFrame:
        """(tree, version, level, at, digest): the nodes copied for each changed leaf, which is named by its place; the source's tree
        ends with the level of its subroot."""
        own = self.rows.where("changed IS NOT NULL").select("tree", F.col("at").alias("version"), F.posexplode(F.slice("copies", F.lit(1), F.size("steps") + 1)).alias("level", "digest"))
        return own.select("tree", "version", "level", F.floor(F.col("version") / F.pow(F.lit(self.arity), F.col("level"))).cast("long").alias("at"), "digest")

    def view(self, tree: str, version: int) -> DataFrame:
        """(level, at, digest): all nodes of one version: its copies, and the shared nodes in all other places."""
        copies = self.versions().where((F.col("tree") == tree) & (F.col("version") == version)).select("level", "at", "digest")
        return self.nodes().where(F.col("tree") == tree).drop("tree").join(copies, ["level", "at"], "left_anti").unionByName(copies)


def manifest(docs: DataFrame, changed: Column, text: Column, fields: list[str] = FIELDS, arity: int = ARITY, depth: int = DEPTH) -> Manifest:
    """The trees over a table, and a version for each row for which `changed` holds, with `text` in the place of its text."""
    table = materialize(leaves(docs, changed, text, fields), "merkle-leaves").withColumnRenamed("leaf", "digest")
    rounds = grown(placed(table, ["doc_id", "digest", "changed"]), arity, depth)
    sources = tops(rounds).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest"))
    source_rounds = grown(placed(sources, ["name"]), arity, depth)
    root = tops(source_rounds).select("tree", F.col("top").alias("root"))
    over = paths(source_rounds[0].join(upward(source_rounds, root, arity), ["tree", "block"]), arity)
    ends = over.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.concat("steps", "above").alias("source_steps"), "root")
    rows = paths(rounds[0].join(upward(rounds, ends, arity), ["tree", "block"]), arity)
    inner = F.when(F.col("changed").isNotNull(), copied(F.array("changed"), F.col("steps")))  # the block's part of a version
    rows = rows.withColumn("copies", inner).withColumn("copies", copied(F.col("copies"), F.concat("above", "source_steps")))
    rows = rows.select("tree", "at", "doc_id", F.col("digest").alias("leaf"), "changed", F.concat("steps", "above").alias("steps"), "source_steps", "subroot", "root", "copies")
    return Manifest(rows, rounds, source_rounds, arity, depth)


def digest(made: Manifest) -> DataFrame:
    """Per document: leaf, subroot, root, the SHA-256 of its proof (all siblings from the leaf to the root), the root of its version,
    or what the proof makes of an unchanged leaf, and whether that is the root."""
    steps = F.concat("steps", "source_steps")
    shown = F.sha2(F.aggregate(steps, F.lit(""), lambda made, s: F.concat(made, s["left"], s["right"])), 256)
    plain = F.aggregate(steps, F.col("leaf"), lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
    rows = made.rows.withColumn("folded_root", F.coalesce(F.element_at("copies", -1), plain))
    return rows.select("doc_id", "leaf", "subroot", "root", shown.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def audited(docs: DataFrame) -> DataFrame:
    """The digest of a table with every second document (by the CRC-32 of its doc_id) without its line feeds."""
    return digest(manifest(docs, tampered(), F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))))
