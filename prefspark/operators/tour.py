"""Pre-order of reply trees by an Euler tour and list ranking (TR2, JN3), whatever the shape of a tree.

A tour enters a node before its replies and leaves it after them; a node without replies is one step. Steps form
one list a tree, each with one predecessor and one successor. Ranking the list by pointer jumping gives every step
the number of nodes entered and the depth so far: pre-order and depth. All joins are on step numbers, which are unique on
both sides, so no key is hot: a star of a million replies is a list like any other. Only the order of the replies of one
node takes a sort, over all nodes at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.operators.indexing import global_index
from prefspark.session import Scratch, materialize


def steps(nodes: DataFrame, key: str = "tree_id") -> tuple[DataFrame, DataFrame]:
    """The tour as ``(step, before, entered, deeper, node)``, and ``(u, k, id)`` of its nodes; ``before`` is NULL at a tree's first step.

    Node ``u`` (its place among all nodes ordered by key, parent, ord, id) has the steps ``2u`` (enter) and ``2u + 1``
    (leave), or ``2u`` only if it has no replies. Several roots of one key follow each other. A parent that is
    no node of the tree raises, as do repeated ids.
    """
    narrow = nodes.select(F.col(key).alias("k"), "id", F.col("parent_id").alias("p"), "ord")
    n = global_index(narrow, ["k", "p", "ord", "id"], "u")
    # the last reply of each parent: one row a parent, and its place right after which the next parent's replies start
    by_parent = n.where(F.col("p").isNotNull()).groupBy(F.col("k").alias("pk"), F.col("p").alias("pp")).agg(
        F.min("u").alias("first"), F.max("u").alias("last"))
    kin = n.join(by_parent, F.col("k").eqNullSafe(F.col("pk")) & (F.col("id") == F.col("pp")), "left").select(
        "k", "id", "p", "u", "first", "last")
    kin = materialize(kin)
    _checked(kin, by_parent)
    inner = F.col("first").isNotNull()
    # the node one place before is the reply before, if it has the same key and parent
    earlier = kin.select((F.col("u") + 1).alias("eu"), F.col("k").alias("ek"), F.col("p").alias("ep"), inner.alias("e_inner"))
    placed = kin.join(earlier, F.col("u") == F.col("eu"), "left").withColumn(
        "sibling", F.col("eu").isNotNull() & F.col("k").eqNullSafe(F.col("ek")) & F.col("p").eqNullSafe(F.col("ep")))
    # a first reply follows the step that enters its parent: its place is the parent's ``first``
    parents = kin.where(inner).select(F.col("first").alias("child"), F.col("u").alias("pu"))
    after = placed.join(parents, F.col("u") == F.col("child"), "left")
    leaving_sibling = F.col("u") * 2 - 2 + F.when(F.col("e_inner"), 1).otherwise(0)
    enter = after.select(
        (F.col("u") * 2).alias("step"),
        F.when(F.col("sibling"), leaving_sibling).when(F.col("pu").isNotNull(), F.col("pu") * 2).alias("before"),
        F.lit(1).cast("bigint").alias("entered"), F.when(inner, 1).otherwise(0).cast("bigint").alias("deeper"), F.col("u").alias("node"))
    # a node is left after its last reply is
    lasts = kin.select(F.col("u").alias("lu"), inner.alias("l_inner"))
    leave = kin.where(inner).join(lasts, F.col("last") == F.col("lu")).select(
        (F.col("u") * 2 + 1).alias("step"), (F.col("lu") * 2 + F.when(F.col("l_inner"), 1).otherwise(0)).alias("before"),
        F.lit(0).cast("bigint").alias("entered"), F.lit(-1).cast("bigint").alias("deeper"), F.lit(None).cast("bigint").alias("node"))
    return materialize(enter.unionByName(leave)), kin.select("u", "k", "id")


def _checked(kin: DataFrame, by_parent: DataFrame) -> None:
    if not kin.groupBy("k", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).isEmpty():
        raise ValueError("a tree holds the same node id twice")
    known = kin.where(F.col("first").isNotNull()).select(F.col("k").alias("nk"), F.col("id").alias("nid"))
    lost = by_parent.join(known, F.col("pk").eqNullSafe(F.col("nk")) & (F.col("pp") == F.col("nid")), "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"orphan node, parent not found: {lost[0]['pp']}")


def ranked(listed: DataFrame, sums: list[str]) -> DataFrame:
    """``(step, node, sums..)``: the sums of a list's values from its first step to each step, that step included.

    ``listed`` has ``(step, before, node, sums..)``. A round joins every unfinished step with the step it points
    to, which doubles the distance covered, so a list of m steps takes log2(m) rounds. Finished steps are not written again. Steps
    that still have a predecessor when any list must have ended lie on a cycle, which raises.
    """
    with Scratch(listed.sparkSession) as scratch:
        start = scratch.written(listed)
        finished = [start.where(F.col("before").isNull())]
        open_ = start.where(F.col("before").isNotNull())
        left, rounds = open_.count(), 0
        most = max(1, start.count()).bit_length() + 1
        while left:
            if rounds > most:
                raise RuntimeError("parent links do not reach a root (cycle?)")
            everything = reduce(DataFrame.unionByName, [open_, *finished])
            target = everything.select(F.col("step").alias("t"), F.col("before").alias("t_before"), *[F.col(c).alias(f"t_{c}") for c in sums])
            jumped = scratch.written(open_.join(target, F.col("before") == F.col("t")).select(
                "step", F.col("t_before").alias("before"), "node", *[(F.col(c) + F.col(f"t_{c}")).alias(c) for c in sums]))
            finished.append(jumped.where(F.col("before").isNull()))
            open_ = jumped.where(F.col("before").isNotNull())
            left = open_.count()
            rounds += 1
        return materialize(reduce(DataFrame.unionByName, finished).select("step", "node", *sums))


def preorder(nodes: DataFrame, key: str = "tree_id") -> DataFrame:
    """TR2: ``(key, id, preorder, depth)`` of adjacency rows ``(key, id, parent_id, ord)``; replies of equal ord go by id.

    Both numbers start at 0 in each tree. Orphans, cycles and repeated ids raise. Nodes without a
    parent are roots; further roots of a key come after the trees of the earlier ones.
    """
    listed, names = steps(nodes, key)
    sums = ranked(listed, ["entered", "deeper"]).where(F.col("node").isNotNull())
    inner = listed.where(F.col("node").isNotNull()).select(F.col("node").alias("own"), F.col("deeper").alias("own_deeper"))
    found = sums.join(inner, F.col("node") == F.col("own")).join(names, F.col("node") == F.col("u"))
    return found.select(F.col("k").alias(key), "id", (F.col("entered") - 1).alias("preorder"), (F.col("deeper") - F.col("own_deeper")).alias("depth"))
