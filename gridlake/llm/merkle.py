"""Merkle manifest of a dataset by slot pivots.

Every row is a leaf. Leaves of a source, in order, are the children of its tree; the roots of the
sources, in order, are the children of the tree of the dataset. A level is one grouping by (tree,
position / fanout): conditional aggregates spread the children of a parent into ``fanout`` columns,
whose concatenation is hashed. Going down again, a parent hands each child the columns of the others:
the siblings of that child, to the left and to the right of it.

Texts are read once and only digests move. Positions come from ranges that Spark's range partitioner
measures, so no task holds a source, however large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm import common
from gridlake.session import small_side

FANOUT = 3


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated texts."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """A value that cannot be mistaken for its neighbours: ``-`` for NULL, else size, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def ranked(rows: DataFrame, tree: str, order: list[str]) -> tuple[DataFrame, str, int]:
    """``rows`` with ``pos`` (from 0) in their tree and its size ``n``; the path of the table behind
    it; the largest ``n``. Equal rows are told apart by where they were read, so that no range has
    to hold all copies of one."""
    dealt = rows.withColumn("_read", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(tree, *order, "_read").sortWithinPartitions(tree, *order, "_read")
    dealt, path = common.written(dealt.drop("_read").withColumn("_at", F.monotonically_increasing_id()), "ranges")
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    sizes = dealt.groupBy(tree, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(F.col(tree))
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = small_side(sizes.select(
        F.col(tree).alias("_tree"), F.col("_range").alias("_r"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("n"),
    ))
    largest = offsets.agg(F.max("n")).first()[0] or 0
    placed = dealt.join(offsets, (F.col(tree) == F.col("_tree")) & (F.col("_range") == F.col("_r")))
    kept = [c for c in rows.columns if c != "n"]
    return placed.select(*kept, (F.col("_at") + F.col("_shift")).alias("pos"), "n"), path, largest


def pivoted(nodes: DataFrame, cell: Column, fanout: int) -> DataFrame:
    """(tree, pos, n, s0, s1, ..., node): one level up. ``cell`` is what a slot keeps of a child, its
    digest in the field ``node``. A tree of one node is passed on as it is."""
    slots = [F.max(F.when(F.col("pos") % fanout == i, cell)).alias(f"s{i}") for i in range(fanout)]
    up = nodes.groupBy("tree", F.expr(f"pos div {fanout}").alias("pos")).agg(F.max("n").alias("_n"), *slots)
    joined = F.concat(*[F.coalesce(F.col(f"s{i}.node"), F.lit("")) for i in range(fanout)])
    node = F.when(F.col("_n") == 1, F.col("s0.node")).otherwise(F.sha2(joined, 256))
    names = [f"s{i}" for i in range(fanout)]
    return up.select("tree", "pos", F.expr(f"(_n + {fanout - 1}) div {fanout}").alias("n"), *names, node.alias("node"))


def climbed(nodes: DataFrame, cell: Column, largest: int, fanout: int) -> tuple[list[DataFrame], list[str]]:
    """The levels above ``nodes``, lowest first, each a written table, and their paths. A level
    holds the trees that had more than one node below it (the lowest: all)."""
    levels, paths = [], []
    while not levels or largest > 1:
        below = nodes if not levels else levels[-1].where("n > 1").select("tree", "pos", "n", "node")
        level, path = common.written(pivoted(below, F.struct("node") if levels else cell, fanout), "level")
        levels, paths = [*levels, level], [*paths, path]
        largest = -(-largest // fanout)
    return levels, paths


def tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, node) of every tree: the node that was left alone."""
    found = None
    for level in levels:
        alone = level.where("n = 1").select("tree", "node")
        found = alone if found is None else found.union(alone)
    return found


def descended(levels: list[DataFrame], start: DataFrame, fanout: int) -> DataFrame:
    """Cells of the lowest level with ``path``, the siblings on each level up to the end of the path
    that ``start`` (tree, path, and columns that are handed down) gives their tree."""
    carried = [c for c in start.columns if c not in ("tree", "path")]
    known, none = None, F.lit("")
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        above = level.where("n = 1").select("tree", "pos").join(start, "tree")
        if known is not None:
            above = above.unionByName(known)
        rows = level.select("tree", "pos", *[f"s{i}" for i in range(fanout)]).join(above, ["tree", "pos"])
        children = []
        for i in range(fanout):
            left = F.concat(none, *[F.coalesce(F.col(f"s{j}.node"), none) for j in range(i)])
            right = F.concat(none, *[F.coalesce(F.col(f"s{j}.node"), none) for j in range(i + 1, fanout)])
            path = F.concat(F.array(F.struct(left.alias("l"), right.alias("r"))), "path")
            if not depth:  # a tree of one leaf has no level
                path = F.when((F.col("pos") == 0) & F.col("s1").isNull(), F.col("path")).otherwise(path)
            child = F.struct((F.col("pos") * fanout + i).alias("pos"), F.col(f"s{i}").alias("cell"), path.alias("path"))
            children.append(F.when(F.col(f"s{i}").isNotNull(), child))
        known = rows.select("tree", *carried, F.inline(F.array_compact(F.array(*children))))
        if depth:
            known = known.drop("cell")
    return known


def manifest(docs: DataFrame, leaf: Column, tree: str, order: str, altered: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """(order, leaf, subroot, root, path, altered) of every row of ``docs``: the tree of its value of
    ``tree`` and the tree of all. ``path`` lists the siblings (l, r) level by level up to the root;
    ``altered`` is handed through, NULL where it equals the leaf.

    Rows with a NULL ``tree`` are one tree of their own, the first. Rows are ordered by ``order``
    (NULL first), then by leaf; rows alike in both are leaves side by side, each with its own path.
    Other columns are ignored, and an empty table gives no rows."""
    key = F.when(F.col(tree).isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), tree)).alias("tree")
    seen = F.lit(None).cast("string") if altered is None else altered
    leaves, leaf_path, largest = ranked(docs.select(key, F.col(order).alias("id"), leaf.alias("node"), seen.alias("seen")), "tree", ["id", "node"])
    levels, paths = climbed(leaves, F.struct("id", "node", "seen"), largest, fanout)
    subroots = tops(levels).select(F.lit("").alias("tree"), F.col("tree").alias("id"), "node")
    trees, tree_path, count = ranked(subroots, "tree", ["id"])
    upper, upper_paths = climbed(trees, F.struct("id", "node"), count, fanout)
    whole = tops(upper).select("tree", F.col("node").alias("root"), F.expr("cast(array() as array<struct<l:string,r:string>>)").alias("path"))
    start = descended(upper, whole, fanout).select(F.col("cell.id").alias("tree"), "root", F.col("cell.node").alias("subroot"), "path")
    start, start_path = common.written(start, "roots")
    out, _ = common.written(descended(levels, start, fanout), "paths")
    common.dropped(docs.sparkSession, leaf_path, *paths, tree_path, *upper_paths, start_path)
    return out.select(F.col("cell.id").alias(order), F.col("cell.node").alias("leaf"), "subroot", "root", "path", F.col("cell.seen").alias("altered"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]), 256))


def proof(path: Column) -> Column:
    """All siblings of a path in one text, lowest level first, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), "")


def document_leaf(text: Column) -> Column:
    return digest(*[framed(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], framed(text))


def verified_documents(docs: DataFrame) -> DataFrame:
    """Manifest of ``documents`` by source and doc_id, and the check of rows whose text lost its line
    breaks (where the crc32 of the id is even): doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified.

    Any column may be NULL and any text empty or very long; each has a leaf of its own. A row with a
    NULL id is not altered."""
    lost = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    touched = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    altered = F.when(touched, document_leaf(lost))
    found = manifest(docs, document_leaf(F.col("text")), "source", "doc_id", altered)
    back = folded(F.coalesce("altered", "leaf"), F.col("path"))
    checked = found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), back.alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
