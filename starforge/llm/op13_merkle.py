"""Merkle manifest of a dataset as a persistent, path-copying tree.

A leaf is the digest of one row; per group (``lang``) the leaves ascend by id
and every ``FAN`` consecutive nodes become their parent until one is left, the
group's subroot; the subroots, ordered by group, become the root likewise.

The tree is built in stages. A stage cuts the nodes of a group into aligned
blocks of ``BLOCK`` = FAN**4 consecutive nodes, and one call per block computes
the levels inside it; only block roots go on, so a stage's table is 4096 times
smaller than the one before. Going back down, every block learns the siblings
between its root and the top, and every node inside it the siblings up to the
block's root.

Versions: a changed leaf makes a version of the tree that shares all nodes
with the first one but the changed leaf's ancestors. Inside its block a version
copies only those ancestors (four digests); above, it goes on from the block's
root through the siblings that the upper stages wrote.

Defined results: a null column counts as ``-``; a null group comes first and a
null id before all others of its group; rows with one id are ordered by leaf,
and repeated rows are leaves of their own; a null id is never changed; texts
are whole; an empty table gives an empty manifest; other columns, also clashing
names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ship_code

FAN = 8
BLOCK = FAN ** 4
#: Columns that make a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOCAL_BITS = 33


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(df: DataFrame, **other: Column) -> Column:
    """The digest of a row; ``other`` replaces columns by name."""
    return F.sha2(F.concat(*[framed(other.get(c, df[c])) for c in FIELDS]), 256)


def lower_every_third(df: DataFrame) -> Column:
    """The digest of a row whose text is tampered with, where 3 divides the
    crc32 of its id: A-Z become a-z. Null for other rows."""
    changed = F.crc32(df["doc_id"].cast("string").cast("binary")) % 3 == 0
    return F.when(changed, leaf_of(df, text=F.translate(df["text"], UPPER, LOWER)))


# ---- places

def placed(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``pos``, the place of each row in its group (columns
    ``known``, ``part``) by ``order``, from 0, and the group's ``size``. Rows are
    range-partitioned by group and order, so a large group spans partitions;
    one row per partition and group tells where each slice begins."""
    by = ["known", "part", *order]
    rows = materialize(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("slice", F.shiftright("at", _LOCAL_BITS))
    of_group = Window.partitionBy("known", "part")
    slices = (rows.groupBy("slice", "known", "part").agg(F.min("at").alias("from"), F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(of_group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("size", F.sum("n").over(of_group)).drop("n"))
    return (rows.join(slices, ["slice", "known", "part"])
            .withColumn("pos", F.col("at") - F.col("from") + F.col("before")).drop("slice", "at", "from", "before"))


# ---- inside a block

def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(leaves: list[str], whole: bool) -> list[list[str]]:
    """The levels of a block, leaves first. A block that is the ``whole`` group
    ends at its first single node, another one after FAN**4 nodes' levels."""
    levels, left = [leaves], BLOCK
    while (len(levels[-1]) > 1) if whole else left > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
        left //= FAN
    return levels


def siblings_of(levels: list[list[str]], k: int) -> Iterator[tuple[str, str]]:
    """The digests left and right of node ``k`` and its ancestors in their runs."""
    for level in levels[:-1]:
        first = k - k % FAN
        yield "".join(level[first:k]), "".join(level[k + 1:first + FAN])
        k //= FAN


def copied_path(leaf: str, siblings: list[tuple[str, str]]) -> list[str]:
    """The new nodes of a version whose leaf is ``leaf``, from there upwards."""
    path = [leaf]
    for left, right in siblings:
        path.append(digest(left + path[-1] + right))
    return path


def in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("pos")


def block_roots(nodes: DataFrame) -> DataFrame:
    """One node per block: known, part, pos, size, digest."""
    def root(table: pa.Table) -> pa.Table:
        table = in_order(table)
        size = table["size"][0].as_py()
        top = levels_of(table["digest"].to_pylist(), size <= BLOCK)[-1][0]
        return pa.table({"known": table["known"][:1], "part": table["part"][:1], "pos": pa.array([table["block"][0].as_py()], pa.int64()),
                         "size": pa.array([-(-size // BLOCK)], pa.int64()), "digest": [top]})

    narrow = nodes.select("known", "part", "pos", "size", "digest", block(F.col("pos")).alias("block"))
    return narrow.groupBy("known", "part", "block").applyInArrow(root, "known boolean, part string, pos long, size long, digest string")


def block(pos: Column) -> Column:
    return F.shiftright(pos, BLOCK.bit_length() - 1)


# ---- stages

PATH = "array<struct<left: string, right: string>>"


def stages_of(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The written node tables of the stages, the lowest first; the last one
    holds every group's top."""
    stages = [nodes]
    while not stages[-1].where("size > 1").isEmpty():
        below = stages[-1]
        above = block_roots(below.where("size > 1"))
        stages.append(materialize(above, f"{name}-stage-{len(stages)}"))
    return stages


def tops_of(stages: list[DataFrame]) -> DataFrame:
    """Each group's single top node: known, part, digest."""
    tops = [s.where("size = 1") for s in stages]
    out = tops[0].select("known", "part", "digest")
    for t in tops[1:]:
        out = out.unionByName(t.select("known", "part", "digest"))
    return out


def with_paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Every node of a stage with ``path``, its siblings up to the very top,
    given the same for the blocks (``above``: known, part, pos, path)."""
    def down(left: pa.Table, right: pa.Table) -> pa.Table:
        left = in_order(left)
        n = left.num_rows
        upper = right["path"][0].as_py() if right.num_rows else []
        levels = levels_of(left["digest"].to_pylist(), left["size"][0].as_py() <= BLOCK) if n else [[]]
        paths = [[{"left": a, "right": b} for a, b in siblings_of(levels, k)] + upper for k in range(n)]
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return pa.table({"known": left["known"], "part": left["part"], "pos": left["pos"], "path": pa.array(paths, kind)})

    a = nodes.select("known", "part", "pos", "size", "digest", block(F.col("pos")).alias("block")).groupBy("known", "part", "block")
    b = above.withColumnRenamed("pos", "block").groupBy("known", "part", "block")
    return a.cogroup(b).applyInArrow(down, f"known boolean, part string, pos long, path {PATH}")


def paths_down(stages: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """(known, part, pos, path) of the nodes of the second stage, the leaves'
    blocks, given each group's path above its top (``tops``)."""
    paths = None
    for k in range(len(stages) - 1, 0, -1):
        own = stages[k].where("size = 1").join(tops, ["known", "part"]).select("known", "part", "pos", "path")
        if paths is not None:
            own = own.unionByName(with_paths(stages[k].where("size > 1"), paths))
        paths = materialize(own, f"{name}-paths-{k}")
    return paths


def empty_paths(tops: DataFrame) -> DataFrame:
    return tops.select("known", "part", F.array().cast(PATH).alias("path"))


class Manifest:
    """A built tree: ``leaves`` (known, part, pos, size, the columns given to
    ``build``, digest), ``blocks`` (of each block's root the siblings up to the
    root, with subroot and root), ``subroots`` and ``root`` (one row, none if the
    table is empty)."""

    def __init__(self, leaves: DataFrame):
        self.leaves = leaves
        stages = stages_of(leaves, "merkle")
        single = leaves.where("size = 1").select("known", "part", F.lit(0).cast("long").alias("pos"), F.lit(1).cast("long").alias("size"), "digest")
        self.subroots = materialize(tops_of([single, *stages[1:]]), "merkle-subroots")
        # the groups are the leaves of one more tree
        groups = placed(self.subroots.select(F.lit(True).alias("known"), F.lit("").alias("part"), F.col("known").alias("of_known"), F.col("part").alias("of_part"), "digest"),
                        ["of_known", "of_part"], "merkle-groups")
        upper = stages_of(groups, "merkle-upper")
        self.root = tops_of(upper).select("known", "part", F.col("digest").alias("root"))
        one = groups.select("known", "part", "pos", "size", "digest")
        top_paths = with_paths(one.where("size > 1"), paths_down(upper, empty_paths(tops_of(upper)), "merkle-upper")) if len(upper) > 1 else None
        ends = one.where("size = 1").select("known", "part", "pos", F.array().cast(PATH).alias("path"))
        place = ends if top_paths is None else ends.unionByName(top_paths)
        self.tops = materialize(groups.join(place, ["known", "part", "pos"]).join(self.root, ["known", "part"])
                                .select(F.col("of_known").alias("known"), F.col("of_part").alias("part"), "path", F.col("digest").alias("subroot"), "root"), "merkle-tops")
        alone = single.join(self.tops, ["known", "part"]).select("known", "part", "pos", "path")
        below = paths_down(stages, self.tops.select("known", "part", "path"), "merkle")
        paths = alone if below is None else alone.unionByName(below)
        self.blocks = materialize(paths.join(self.tops.drop("path"), ["known", "part"]), "merkle-blocks")


def build(df: DataFrame, changed: Column | None = None) -> Manifest:
    """The manifest of ``df`` (columns ``FIELDS``). ``changed`` is the digest of
    a changed leaf, null where a row stays. Texts are read once; leaves are
    written as ids and digests."""
    ship_code(df.sparkSession)
    changed = F.lit(None).cast("string") if changed is None else changed
    narrow = materialize(df.select(df["doc_id"].alias("doc_id"), df["lang"].isNotNull().alias("known"), F.coalesce(df["lang"], F.lit("")).alias("part"),
                                   leaf_of(df).alias("digest"), changed.alias("changed")), "merkle-leaves")
    order = ["doc_id", "digest", "row"]
    leaves = placed(narrow.withColumn("row", F.monotonically_increasing_id()), order, "merkle-ordered").drop("row")
    return Manifest(materialize(leaves, "merkle-placed"))


def by_block(manifest: Manifest):
    """The leaves of each block together with the block's path."""
    key = ["known", "part", "block"]
    leaves = manifest.leaves.withColumn("block", block(F.col("pos")))
    return leaves.groupBy(*key).cogroup(manifest.blocks.withColumnRenamed("pos", "block").groupBy(*key))


def verify(manifest: Manifest) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root
    (the root of its own version, or of the first one if it did not change) and
    verified."""
    def fold(left: pa.Table, right: pa.Table) -> pa.Table:
        left = in_order(left)
        n = left.num_rows
        upper = [(x["left"], x["right"]) for x in right["path"][0].as_py()] if right.num_rows else []
        leaves, changed = left["digest"].to_pylist(), left["changed"].to_pylist()
        levels = levels_of(leaves, left["size"][0].as_py() <= BLOCK) if n else [[]]
        out: dict[str, list] = {"leaf": leaves, "subroot": right["subroot"].to_pylist() * n, "root": right["root"].to_pylist() * n, "proof_sha256": [], "folded_root": []}
        rest = "".join(a + b for a, b in upper)
        for k in range(n):
            own = list(siblings_of(levels, k))
            inside = copied_path(changed[k] or leaves[k], own)
            out["folded_root"].append(copied_path(inside[-1], upper)[-1])
            out["proof_sha256"].append(digest("".join(a + b for a, b in own) + rest))
        return pa.table({"doc_id": left["doc_id"], **{c: pa.array(v, pa.string()) for c, v in out.items()},
                         "verified": pa.array([a == b for a, b in zip(out["folded_root"], out["root"], strict=True)], pa.bool_())})

    return by_block(manifest).applyInArrow(
        fold, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def versions(manifest: Manifest) -> DataFrame:
    """The new nodes of every changed leaf's version: known, part, leaf_pos
    (the version), level (0 is the leaf) and digest. All other nodes are
    shared with the first version."""
    def copy(left: pa.Table, right: pa.Table) -> pa.Table:
        left = in_order(left)
        upper = [(x["left"], x["right"]) for x in right["path"][0].as_py()] if right.num_rows else []
        levels = levels_of(left["digest"].to_pylist(), left["size"][0].as_py() <= BLOCK) if left.num_rows else [[]]
        out: list[tuple] = []
        for k, new in enumerate(left["changed"].to_pylist()):
            if new is not None:
                path = copied_path(new, [*siblings_of(levels, k), *upper])
                out += [(left["pos"][k].as_py(), level, d) for level, d in enumerate(path)]
        names = [("leaf_pos", pa.int64()), ("level", pa.int32()), ("digest", pa.string())]
        cols = {name: pa.array([x[i] for x in out], kind) for i, (name, kind) in enumerate(names)}
        first = {c: pa.array(left[c][:1].to_pylist() * len(out), t) for c, t in (("known", pa.bool_()), ("part", pa.string()))}
        return pa.table(first | cols)

    return by_block(manifest).applyInArrow(copy, "known boolean, part string, leaf_pos long, level int, digest string")
