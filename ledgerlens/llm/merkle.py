"""Merkle manifest of a dataset, with an inclusion proof for every row.

Rows are leaves; per group (say, a language) they are numbered in order, and every
``fan`` consecutive nodes become their digest, level by level, until one node (the
subroot) remains; the subroots, ordered by group, make the tree of the root.

Numbers come from a range partitioning, counts per partition and a prefix sum over
the partitions' counts, so a group may hold any share of the rows.

Proofs by pointer jumping: at first every inner node knows its parent and the
sibling segment on the way there.  In each round the table is joined to itself: a
node takes over its ancestor's ancestor and appends that one's segments, which
doubles the distance, until all reach the root; log2(height) rounds.  Leaves are
kept in their runs of at most ``fan``, the parents of which jump for them: a leaf
adds the segment within its run to its parent's.  Only nodes above the distance
jumped can be reached, and where more than ``fan ** SPREAD`` nodes share an
ancestor, that ancestor's row is repeated under salts, so no key is hot.

Digests are lowercase hex sha256 where they are hashed or returned, and binary in
between.  Defined results: a null group is a group of its own and the first one;
null order values come first; equal ones are ordered by leaf digest; rows equal in
both have equal digests and take neighbouring places.  A lone leaf is its own
subroot, a lone subroot the root; their proofs have no segments.  An empty table
gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

FAN = 8
SPREAD = 4  # fan ** SPREAD nodes at most meet one ancestor's row in a jump
TOP = -1  # the tree over the subroots
SEGMENT = "array<struct<before:binary,after:binary>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(c: Column) -> Column:
    """'-' if null, else byte count, ':', value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(F.concat(*(field(v) for v in values)))


def _said(hashes: Column) -> Column:
    """Binary digests as one hex text."""
    return F.concat_ws("", F.transform(hashes, lambda h: F.lower(F.hex(h))))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``tree`` (a number of the group that ascends with it), ``pos``
    (place in the group, from 0) and ``size`` (of the group).  ``order`` must tell
    all rows apart that are not to be neighbours in any order."""
    keys = [group, *order]
    dealt = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_row", 33).alias("_part")
    own = Window.partitionBy("_group")  # one row per partition that holds the group
    starts = (dealt.groupBy(F.col(group).alias("_group"), part).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
              .select("_group", "_part", "_first", F.min("_first").over(own).alias("tree"), F.sum("_n").over(own).alias("size"),
                      (F.sum("_n").over(own.orderBy("_part")) - F.col("_n")).alias("_before")))
    starts = written(starts, "starts")
    return (dealt.withColumn("_part", part).join(starts.withColumnRenamed("_part", "_p"), F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_p")))
            .withColumn("pos", F.col("_row") - F.col("_first") + F.col("_before"))
            .drop("_row", "_part", "_p", "_group", "_first", "_n", "_before"))


def _runs(nodes: DataFrame, fan: int, *carried: str) -> DataFrame:
    """Every ``fan`` consecutive nodes of a tree as one row: the parent."""
    each = F.sort_array(F.collect_list(F.struct("pos", "hash", *carried)))
    return (nodes.groupBy("tree", "size", F.expr(f"pos div {fan}").alias("pos")).agg(each.alias("run"))
            .withColumn("children", F.transform("run", lambda x: x["hash"])))


def _levels(first: DataFrame, most: int, fan: int) -> list[DataFrame]:
    """Written nodes of every level, from the parents of the leaves (``first``) on."""
    levels, width = [first], fan
    while width < most:
        nodes = _runs(levels[-1].filter(F.col("size") > width), fan).drop("run")
        levels.append(written(nodes.withColumn("hash", F.unhex(digest(_said(F.col("children")))))
                              .withColumn("level", F.lit(len(levels) + 1)), "level"))
        width *= fan
    return levels


def _last(size: str, level: str, fan: int) -> Column:
    """Whether a node is the only one of its level."""
    return F.col(size) <= F.pow(F.lit(float(fan)), F.col(level))


def _node(tree, level, pos) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), pos.cast("long").alias("pos"))


def _segment(hashes: Column, at: Column) -> Column:
    def joined(c: Column) -> Column:
        return F.unhex(_said(c))
    return F.struct(joined(F.slice(hashes, F.lit(1), at)).alias("before"),
                    joined(F.slice(hashes, at + 2, F.greatest(F.size(hashes) - at - 1, F.lit(0)))).alias("after"))


def _first_steps(nodes: DataFrame, placed: DataFrame, trees: int, fan: int) -> DataFrame:
    """Of every inner node: its ancestor so far (the parent; null for the root), the
    segments on the way there, and the subroot and root digests met."""
    own = _node(F.col("tree"), F.col("level"), F.col("pos"))
    last, hash_, nothing = _last("size", "level", fan), F.col("hash"), F.lit(None).cast("binary")

    def step(rows: DataFrame, up: Column, at: str, subroot: Column, root: Column) -> DataFrame:
        return rows.select(own.alias("node"), up.alias("ancestor"), F.expr(f"cast({at} % {fan} as int)").alias("at"), subroot.alias("subroot"), root.alias("root"))

    above = _node(F.lit(TOP), F.lit(1), F.expr(f"place div {fan}"))
    none = F.lit(None).cast("struct<tree:bigint,level:int,pos:bigint>")
    subroots = nodes.filter(last & (F.col("tree") != TOP)).join(placed, "tree")
    steps = step(nodes.filter(~last), _node(F.col("tree"), F.col("level") + 1, F.expr(f"pos div {fan}")), "pos", nothing, nothing).unionByName(
        step(subroots, above if trees > 1 else none, "place", hash_, nothing if trees > 1 else hash_)).unionByName(
        step(nodes.filter(last & (F.col("tree") == TOP)), none, "pos", nothing, hash_))
    parents = nodes.select(own.alias("_parent"), "children")
    moved = steps.filter("ancestor IS NOT NULL").join(parents, F.col("ancestor") == F.col("_parent"))
    moved = moved.withColumn("path", F.array(_segment(F.col("children"), F.col("at")))).drop("_parent", "children", "at")
    ended = steps.filter("ancestor IS NULL").withColumn("path", F.array().cast(SEGMENT)).drop("at")
    return written(moved.unionByName(ended), "steps")


def _jump(steps: DataFrame, distance: int, fan: int) -> DataFrame:
    """Twice the distance: every node goes on from where its ancestor has got to."""
    salts = fan ** max(0, distance - SPREAD)
    reached = steps.filter((F.col("node.level") > distance) | (F.col("node.tree") == TOP)).select(
        F.col("node").alias("_node"), F.col("ancestor").alias("_ancestor"), F.col("path").alias("_path"),
        F.col("subroot").alias("_subroot"), F.col("root").alias("_root"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    under_way = steps.filter("ancestor IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int"))
    on = under_way.join(reached, (F.col("ancestor") == F.col("_node")) & (F.col("salt") == F.col("_salt"))).select(
        "node", F.col("_ancestor").alias("ancestor"), F.coalesce("subroot", "_subroot").alias("subroot"),
        F.col("_root").alias("root"), F.concat("path", "_path").alias("path"))
    return written(on.unionByName(steps.filter("ancestor IS NULL")), "steps")


def manifest(rows: DataFrame, keep: list[str], group: str, order: str, hash_col: str, fan: int = FAN) -> DataFrame:
    """``keep`` columns as the struct ``doc``, and of every row leaf, subroot, root
    (hex) and proof: the siblings before and after it (digests one after another),
    from its run up to the root.  ``hash_col``: the row's leaf digest (hex)."""
    slim = rows.select(F.col(f"`{group}`").alias("grp"), F.col(f"`{order}`").alias("ord"), F.unhex(hash_col).alias("hash"),
                       F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc"))
    slim = written(slim.withColumn("uid", F.monotonically_increasing_id()), "leaves")
    placed = numbered(slim, "grp", ["ord", "hash", "uid"]).drop("grp", "ord", "uid")
    runs = _runs(placed, fan, "doc")
    parent = F.when(F.col("size") > 1, F.unhex(digest(_said(F.col("children"))))).otherwise(F.col("children")[0])
    runs = written(runs.withColumn("hash", parent).withColumn("level", F.lit(1)), "runs")
    most = runs.agg(F.max("size")).first()[0] or 0
    levels = _levels(runs.drop("run"), most, fan)
    nodes = reduce(DataFrame.unionByName, levels)
    subroots = nodes.filter(_last("size", "level", fan)).select("hash", F.col("tree").alias("own"), F.lit(0).alias("all"))
    top = written(numbered(written(subroots, "subroots"), "all", ["own"]), "top")
    trees = top.count()
    if trees > 1:
        crown = _runs(top.withColumn("tree", F.lit(TOP).cast("long")).select("tree", "size", "pos", "hash"), fan).drop("run")
        crown = written(crown.withColumn("hash", F.unhex(digest(_said(F.col("children"))))).withColumn("level", F.lit(1)), "level")
        nodes = reduce(DataFrame.unionByName, _levels(crown, trees, fan), nodes)
    steps = _first_steps(nodes, top.select(F.col("own").alias("tree"), F.col("pos").alias("place")), trees, fan)
    distance = 1
    while not steps.filter("ancestor IS NOT NULL").isEmpty():
        steps = _jump(steps, distance, fan)
        distance *= 2
    ways = steps.filter((F.col("node.level") == 1) & (F.col("node.tree") != TOP)).select(
        F.col("node.tree").alias("_tree"), F.col("node.pos").alias("_pos"), "subroot", "root", "path")
    each = runs.join(ways, (F.col("tree") == F.col("_tree")) & (F.col("pos") == F.col("_pos"))).select(
        "size", "children", "subroot", "root", "path", F.posexplode("run").alias("at", "one"))
    own = F.when(F.col("size") > 1, F.array(_segment(F.col("children"), F.col("at")))).otherwise(F.array().cast(SEGMENT))

    def shown(c: str) -> Column:
        return F.lower(F.hex(c))
    return each.select("one.doc", shown("one.hash").alias("leaf"), shown("subroot").alias("subroot"), shown("root").alias("root"),
                       F.concat(own, "path").alias("proof"))


def folded(leaf_hash: Column, proof: Column) -> Column:
    """The root that a leaf digest and its proof give."""
    return F.aggregate(proof, leaf_hash, lambda h, s: digest(F.concat(F.lower(F.hex(s["before"])), h, F.lower(F.hex(s["after"])))))


def proof_digest(proof: Column) -> Column:
    return digest(F.concat_ws("", F.transform(proof, lambda s: F.lower(F.concat(F.hex(s["before"]), F.hex(s["after"]))))))
