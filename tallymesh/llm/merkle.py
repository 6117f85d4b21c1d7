"""Merkle manifest of a table: a digest, a proof and a check for every row.

Rows become leaves; the leaves of a language, by doc_id, are numbered over the whole table and cut
into aligned blocks of 2^BITS. A task goes through one block as a fractal traversal: for every band
of BAND levels it keeps the existing subtree, which holds the siblings of the present leaf, and
grows the desired one, which the leaves after it need, by one leaf a step. So it emits one
authentication path after another and never holds a block's whole tree. The tops of the blocks are
the leaves of the next tier, which is numbered and traversed alike, up to the root of each language
and then over the languages; the path of a row is that of its block, then those of the tiers above.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

BITS = 10  # levels of a block, which has 1,024 nodes
BAND = 5  # levels of a subtree of the traversal
STEP = 33  # bytes of a path for each level: LONE, LEFT or RIGHT, and the sibling's digest
LONE, LEFT, RIGHT = 0, 1, 2


def join(left: bytes | None, right: bytes | None) -> bytes | None:
    """The node above two nodes, or above one that stands alone; nothing above nothing."""
    return left and sha256((left.hex() + (right.hex() if right else "")).encode()).digest()


class Subtree:
    """The nodes of levels low to high - 1 below one node, grown leaf by leaf from the left."""

    def __init__(self, low: int, high: int):
        self.low, self.high, self.top = low, high, None
        self.levels: list[list[bytes | None]] = [[] for _ in range(low, high)]
        self.stack: list[tuple[int, bytes | None]] = []

    def grow(self, node: bytes | None) -> None:
        level = 0
        while level < self.high:
            if level >= self.low:
                self.levels[level - self.low].append(node)
            if not self.stack or self.stack[-1][0] != level:
                self.stack.append((level, node))
                return
            node = join(self.stack.pop()[1], node)
            level += 1
        self.top = node

    def sibling(self, leaf: int, level: int) -> bytes | None:
        return self.levels[level - self.low][(leaf >> level ^ 1) & ((1 << self.high - level) - 1)]


def top_and_paths(leaves: list[bytes], height: int) -> tuple[bytes, Iterator[bytes]]:
    """The node height levels above the leaves of one aligned block, and the path of each leaf to it."""
    many = 1 << height
    leaf = [*leaves, *[None] * (many - len(leaves))].__getitem__
    bands = [(low, min(low + BAND, height)) for low in range(0, height, BAND)]
    existing = [Subtree(*b) for b in bands]
    for i in range(many):
        for s in existing:
            if not i >> s.high:
                s.grow(leaf(i))

    def paths() -> Iterator[bytes]:
        desired = [Subtree(*b) for b in bands]
        for i in range(len(leaves)):
            out = []
            for s in existing:
                for level in range(s.low, s.high):
                    other = s.sibling(i, level)
                    out.append(bytes([LEFT if i >> level & 1 else RIGHT]) + other if other else bytes(STEP))
            yield b"".join(out)
            for b, s in enumerate(existing):
                size = 1 << s.high
                if (at := i + size) < many:  # the same place in the next subtree
                    desired[b].grow(leaf(at))
                    if not (i + 1) % size:
                        existing[b], desired[b] = desired[b], Subtree(*bands[b])

    return existing[-1].top if bands else leaves[0], paths()


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with pos, the place among the rows of the same tree, and size, how many these are.

    Ranges of the whole order are sorted apart, then shifted by what the ranges before hold.
    """
    spread = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    spread = stage(spread.withColumn("at", F.monotonically_increasing_id()), "sorted").withColumn("part", F.shiftright("at", 33))
    runs = spread.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    runs = runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("size"))
    return spread.join(runs, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _climb(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """nodes (tree, pos, size, digest, ...) with path, up to the top of their tree; and (tree, digest): the tops."""
    columns = [f for f in nodes.schema.fields if f.name not in ("path", "top")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns) + ", path binary, top binary"
    names = [f.name for f in columns]

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        height = min(BITS, (int(block["size"].iloc[0]) - 1).bit_length())
        top, paths = top_and_paths([bytes(d) for d in block["digest"]], height)
        return block[names].assign(path=[*paths], top=[top, *[None] * (len(block) - 1)])

    block = F.shiftright("pos", BITS)
    here = stage(nodes.groupBy("tree", block).applyInPandas(run, schema), name)
    tops = here.where("top is not null")
    if (here.agg(F.max("size")).first()[0] or 0) <= 1 << BITS:
        return here.drop("top"), tops.select("tree", F.col("top").alias("digest"))
    above = tops.select("tree", block.alias("pos"), F.ceil(F.col("size") / (1 << BITS)).cast("long").alias("size"), F.col("top").alias("digest"))
    above, roots = _climb(above, f"{name}_above")
    above = above.select(F.col("tree").alias("t"), F.col("pos").alias("p"), F.col("path").alias("rest"))
    both = here.join(above, (F.col("tree") == F.col("t")) & (block == F.col("p")))
    return both.withColumn("path", F.concat("path", "rest")).select(*names, "path"), roots


def _hex(digest) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(*values: Column) -> Column:
    """Binary sha256 of the values: null as -, others as their byte count, a colon and their text."""
    said = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*said), 256))


def _steps(path: Column) -> Column:
    n = (F.length(path) / STEP).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(path, (i - 1) * STEP + 1, F.lit(STEP)))).otherwise(F.array().cast("array<binary>"))


def folded(leaf: Column, path: Column) -> Column:
    """The root (hex) that a leaf (hex) and the siblings of its path give."""

    def above(node, step):
        side, other = F.hex(F.substring(step, 1, 1)), _hex(F.substring(step, 2, 32))
        return F.sha2(F.when(side == f"{LEFT:02}", F.concat(other, node)).when(side == f"{RIGHT:02}", F.concat(node, other)).otherwise(node), 256)

    return F.aggregate(_steps(path), leaf, above)


def siblings(path: Column) -> Column:
    """The siblings of a path as hex text, level by level; a node that stands alone has none."""
    own = F.filter(_steps(path), lambda s: F.hex(F.substring(s, 1, 1)) != f"{LONE:02}")
    return F.array_join(F.transform(own, lambda s: _hex(F.substring(s, 2, 32))), "")


def manifest(rows: DataFrame, tree: Column, order: Column, leaf: Column, **extra: Column) -> DataFrame:
    """Per row: the extra columns, leaf, subroot, root (hex), path (binary): a manifest of rows in trees.

    tree: string that orders the trees, nulls not allowed; order: a column that orders the
    leaves of a tree (nulls first, ties by digest). Equal rows are leaves of their own.
    """
    own = [c.alias(f"x {k}") for k, c in extra.items()]
    flat = rows.select(tree.alias("tree"), order.alias("rank"), leaf.alias("digest"), *own)
    # equal leaves differ by tie, so that many copies of a row need not lie in one range
    flat = stage(flat.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    leaves, subroots = _climb(_numbered(flat, "rank", "digest", "tie").drop("tie", "rank"), "paths")
    named = _numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "name")
    tops, root = _climb(named, "tops")
    tops = tops.join(root.select("tree", F.col("digest").alias("root")), "tree").select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("path").alias("rest"))
    both = leaves.join(tops, "tree")
    return both.select(*[F.col(f"`x {k}`").alias(k) for k in extra], _hex("digest").alias("leaf"), _hex("subroot").alias("subroot"), _hex("root").alias("root"), F.concat("path", "rest").alias("path"))


def verify_documents(documents: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Trees are the languages (null first), leaves ascend by doc_id (null first; rows of one doc_id by
    their digest, so equal rows have places of their own). Where 7 divides the crc32 of doc_id and
    n_chars is not null, the leaf that is folded has an n_chars one too large; a null doc_id
    has no crc32, so its row stays. Columns other than doc_id, source, lang, n_chars and text are
    ignored. An empty table has no leaves and gives no rows.
    """
    n, parts = F.col("n_chars"), (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("text"))

    def digest(n_chars):
        return leaf_digest(*parts[:3], n_chars, parts[3])

    changed = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & n.isNotNull()
    tree = F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit(""))
    found = manifest(documents, tree, F.col("doc_id"), digest(n), doc_id=F.col("doc_id").cast("long"), forged=F.when(changed, digest(n.cast("decimal(20,0)") + 1)))
    found = found.withColumn("folded_root", folded(F.coalesce(_hex("forged"), "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
