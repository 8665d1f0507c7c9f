"""Merkle manifest of a table, kept as a persistent tree: every changed row makes a
version of the tree that copies only the nodes on its way to the root and shares all
others with the first version.

A leaf is the digest of a row's fields. The leaves of a group (a language) are put in
order and cut into pages of 1,024 consecutive ones; a page is one row of the table of
pages and holds its leaves, the leaves of its changed rows, and the top of the subtree
above it. The tops of a level are the nodes of the next one, which is cut into pages
again, until one node of the group is left; the groups' nodes then form a tree in the
same way. So no task holds more than a page of nodes, whatever the size of a group.

``versions`` walks the pages once, each with the path from its top to the root (the
siblings in the pages above, which are joined from the root down). Inside the page
each changed leaf copies its ancestors; the version then goes on above the page along
the shared path, wherever the page lies, so versions of one tree never meet.

Defined results: a null field is told from every value; a null group is a group of its
own and comes first; null order values come first inside a group; rows with equal order
values lie in the order of their leaves, and equal rows of equal place are exchangeable;
a changed row whose leaf stays the same has a version equal to the first; an empty
table gives an empty result. Columns that are not named are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.llm.common import placed, stored

#: Levels of nodes in a page: it holds 1,024 leaves.
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A field as text that no other field equals: ``-``, or byte count, ``:`` and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*(field(c) for c in columns.values())), 256)


def subtree(nodes: list[str], height: int) -> list[list[str]]:
    """The levels above ``nodes``, themselves first: every two consecutive nodes become
    the digest of both, a last one without a partner the digest of itself."""
    levels = [nodes]
    for _ in range(height):
        nodes = [digest("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        levels.append(nodes)
    return levels


def steps(levels: list[list[str]], at: int) -> list[str]:
    """The way from a node to the top: at each level the sibling with its side (``l`` or
    ``r``), or ``-`` where there is none."""
    way = []
    for level in levels[:-1]:
        way.append("-" if at ^ 1 >= len(level) else ("l" if at & 1 else "r") + level[at ^ 1])
        at >>= 1
    return way


def fold(node: str, way: list[str]) -> list[str]:
    """The nodes above ``node`` along ``way``: the copies that a version needs."""
    made = []
    for step in way:
        node = digest(node if step == "-" else step[1:] + node if step[0] == "l" else node + step[1:])
        made.append(node)
    return made


def proof(way: list[str]) -> str:
    return digest("".join(step[1:] for step in way))


def _height(total: int, levels: int) -> int:
    """Levels that a page rises in a tree of ``total`` nodes."""
    return min(levels, (total - 1).bit_length())


_WAY_TYPE = "tree string, pos long, way array<string>"
_PAGE_TYPE = "tree string, page long, total long, top string, keys array<long>, nodes array<string>, changed array<string>"


def _page(table: pa.Table, levels: int) -> pa.Table:
    table = table.sort_by("pos")
    total, nodes = table["total"][0].as_py(), table["node"].to_pylist()
    top = subtree(nodes, _height(total, levels))[-1][0]
    strings = pa.list_(pa.string())
    return pa.table([table["tree"][:1], table["page"][:1], table["total"][:1], pa.array([top]), pa.array([table["key"].to_pylist()], pa.list_(pa.int64())), pa.array([nodes], strings), pa.array([table["changed"].to_pylist()], strings)], ["tree", "page", "total", "top", "keys", "nodes", "changed"])


def _paged(nodes: DataFrame, levels: int, name: str) -> DataFrame:
    """Pages of nodes (tree, pos, total, key, node, changed)."""
    paged = nodes.withColumn("page", F.shiftright("pos", levels))
    return stored(paged.groupBy("tree", "page").applyInArrow(lambda table: _page(table, levels), _PAGE_TYPE), name)


def _ways(batches, height: int):
    """tree, pos, way of the nodes of pages (tree, page, total, nodes, and the way of the page's top)."""
    for batch in batches:
        for tree, page, total, nodes, above in zip(*(batch.column(c).to_pylist() for c in ("tree", "page", "total", "nodes", "way")), strict=True):
            levels, start = subtree(nodes, _height(total, height)), page << height
            yield pa.RecordBatch.from_arrays([pa.array([tree] * len(nodes)), pa.array(range(start, start + len(nodes)), pa.int64()), pa.array([steps(levels, i) + above for i in range(len(nodes))], pa.list_(pa.string()))], ["tree", "pos", "way"])


def _above(pages: DataFrame, height: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(tree, top) of each tree, and (tree, page, way): the path from each page's top to
    the top of its tree. Each turn of the loop is a level of pages."""
    size, levels = 1 << height, [pages]
    while not (open_ := levels[-1].where(F.col("total") > size)).isEmpty():
        up = open_.select("tree", F.col("page").alias("pos"), F.ceil(F.col("total") / size).cast("long").alias("total"), F.col("page").alias("key"), F.col("top").alias("node"), F.lit(None).cast("string").alias("changed"))
        levels.append(_paged(up, height, f"{name}-level{len(levels)}"))
    ends = [level.where(F.col("total") <= size).select("tree", "page", "top") for level in levels]
    trees = ends[0]
    for end in ends[1:]:
        trees = trees.unionByName(end)
    here = F.array().cast("array<string>")
    way = ends[-1].select("tree", "page", here.alias("way"))
    for n in range(len(levels) - 1, 0, -1):
        within = levels[n].select("tree", "page", "total", "nodes").join(way, ["tree", "page"]).mapInArrow(lambda batches: _ways(batches, height), _WAY_TYPE)
        below = stored(within.select("tree", F.col("pos").alias("page"), "way"), f"{name}-ways{n}")
        way = below.unionByName(ends[n - 1].select("tree", "page", here.alias("way")))
    return stored(trees.select("tree", "top"), f"{name}-trees"), way


@dataclass
class Manifest:
    """``pages`` (tree, page, total, top, keys, nodes, changed), ``ways`` (tree, page,
    subroot, root, way: the siblings from a page's top to the root) and ``trees``
    (tree, subroot); ``tree`` is ``=`` and the group, or empty for the null group."""

    pages: DataFrame
    ways: DataFrame
    trees: DataFrame
    levels: int


def build(docs: DataFrame, changed: Column | None = None, change: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, group_col: str = "lang", key_col: str = "doc_id", levels: int = LEVELS) -> Manifest:
    """The manifest of ``docs``. Rows where ``changed`` holds also get the leaf that
    they have with the columns of ``change`` instead of their own. A page holds
    ``2 ** levels`` leaves."""
    columns = {name: F.col(name) for name in fields}
    forged = F.when(changed, leaf(columns | change)) if changed is not None else F.lit(None).cast("string")
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("tree"), F.col(key_col).cast("long").alias("key"), leaf(columns).alias("node"), forged.alias("changed"))
    leaves = placed(rows, "tree", [F.col("key").asc_nulls_first(), F.col("node"), F.col("changed")], "pos", "total", "merkle-leaves")
    pages = _paged(leaves, levels, "merkle-pages")
    trees, ways = _above(pages, levels, "merkle")
    # the trees' tops are the leaves of one more tree
    tops = placed(trees.withColumn("one", F.lit(1)), "one", [F.col("tree")], "pos", "total", "merkle-tops")
    forest = tops.select(F.lit("").alias("tree"), "pos", "total", F.lit(None).cast("long").alias("key"), F.col("top").alias("node"), F.lit(None).cast("string").alias("changed"))
    shelves = _paged(forest, levels, "merkle-shelves")
    roots, over = _above(shelves, levels, "merkle-forest")
    out = shelves.join(over, ["tree", "page"]).mapInArrow(lambda batches: _ways(batches, levels), _WAY_TYPE)
    out = out.join(F.broadcast(roots.select("tree", F.col("top").alias("root"))), "tree").select("pos", "root", F.col("way").alias("out"))  # the forest is one tree
    known = tops.select("tree", F.col("top").alias("subroot"), "pos").join(out, "pos").drop("pos")
    known = stored(known, "merkle-known")
    full = stored(ways.join(known, "tree").select("tree", "page", "subroot", "root", F.concat("way", "out").alias("way")), "merkle-ways")
    return Manifest(pages, full, known.select("tree", "subroot"), levels)


_VERSION_TYPE = "tree string, pos long, key long, leaf string, changed string, subroot string, root string, proof string, copies array<string>"


def _versions(batches, height: int):
    fields = ("tree", "page", "total", "keys", "nodes", "changed", "subroot", "root", "way")
    for batch in batches:
        for tree, page, total, keys, nodes, changed, subroot, root, above in zip(*(batch.column(c).to_pylist() for c in fields), strict=True):
            levels, n, start = subtree(nodes, _height(total, height)), len(nodes), page << height
            ways = [steps(levels, i) + above for i in range(n)]
            copies = [fold(new or old, way) for old, new, way in zip(nodes, changed, ways, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([tree] * n), pa.array(range(start, start + n), pa.int64()), pa.array(keys, pa.int64()), pa.array(nodes), pa.array(changed, pa.string()), pa.array([subroot] * n), pa.array([root] * n), pa.array([proof(way) for way in ways]), pa.array(copies, pa.list_(pa.string()))], ["tree", "pos", "key", "leaf", "changed", "subroot", "root", "proof", "copies"])


def versions(manifest: Manifest) -> DataFrame:
    """tree, pos, key, leaf, changed, subroot, root, proof, copies: a row for each leaf.
    ``copies`` are the nodes above it, lowest first, folded from the changed leaf, or
    else from the leaf itself, and its siblings; the last one (the leaf itself, where
    there is none) is the root of its version."""
    height = manifest.levels
    rows = manifest.pages.select("tree", "page", "total", "keys", "nodes", "changed").join(manifest.ways, ["tree", "page"])
    return rows.mapInArrow(lambda batches: _versions(batches, height), _VERSION_TYPE)


def verify(manifest: Manifest, key_col: str = "doc_id") -> DataFrame:
    """A row for each row of the table: its leaf, the roots, the digest of its proof, the
    root folded from its (changed) leaf, and whether that is the manifest's root."""
    top = F.coalesce(F.element_at("copies", -1), "changed", "leaf")
    rows = versions(manifest).select(F.col("key").alias(key_col), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), F.when(F.size("copies") > 0, top).otherwise(F.coalesce("changed", "leaf")).alias("folded_root"), F.when(F.col("changed").isNotNull(), F.size("copies")).alias("copied_nodes"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
