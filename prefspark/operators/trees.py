"""Reply trees -> message rows in DFS pre-order (TR1, TR2, PR4).

A node's place is its ``path``: the ARRAY<INT> of sibling ordinals from the root (the
root's path is empty). Sorting by path is pre-order, because Spark (and DuckDB) compare
arrays element-wise with a prefix first. The adjacency form (TR2) is keyed by node, so one huge
tree is spread over many tasks. A nested tree (TR1) is one VARIANT row until its levels are exploded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.operators.logsumexp import let
from prefspark.operators.skew import HOT_ROWS, lookup
from prefspark.session import Scratch, materialize

# The role mapping of the tree format.
ROLE_MAPPING = {"prompter": "user", "assistant": "assistant"}


#: More levels than JSON text can have: its readers stop at 1,000 nested values, two a level.
DEEPEST = 1_000


def map_role(role: Column) -> Column:
    """PR4: prompter -> user, assistant -> assistant, anything else (or NULL) raises."""
    out = None
    for src, dst in ROLE_MAPPING.items():
        out = F.when(role == F.lit(src), F.lit(dst)) if out is None else out.when(role == F.lit(src), F.lit(dst))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown role: "), F.coalesce(role, F.lit("NULL")))))


def _node_fields(node: Column) -> list[Column]:
    role = F.variant_get(node, "$.role", "string")
    text = F.variant_get(node, "$.text", "string")
    return [
        F.when(role.isNull(), F.raise_error(F.lit("tree node without role"))).otherwise(role).alias("role"),
        F.when(text.isNull(), F.raise_error(F.lit("tree node without text"))).otherwise(text).alias("text"),
        # a list of child nodes; a missing or null ``replies`` gives NULL (no children, S17),
        # anything that is not a list fails the cast instead of being read as children
        F.variant_get(node, "$.replies", "array<variant>").alias("_replies"),
    ]


def _levels(tree: Column, max_depth: int) -> Column:
    """All nodes of one nested tree as ``array<struct<path, role, text>>``, level by level.

    A fold over levels: the state holds the nodes found so far and the open level, whose children are the next one.
    It runs as often as the tree can be deep (no deeper than it has lists of replies), and does nothing once a
    level is empty.
    """
    root = F.variant_get(tree, "$.prompt", "variant")
    path = F.array().cast("array<int>")
    # the state keeps its very type, or every round would convert all of it
    messages = "array<struct<path: array<int>, role: string, text: string>>"
    nodes = "array<struct<path: array<int>, node: variant>>"

    def message(x: Column) -> Column:
        role, text, _ = _node_fields(x["node"])
        return F.struct(x["path"].alias("path"), role.alias("role"), text.alias("text"))

    def children(x: Column) -> Column:
        replies = F.coalesce(_node_fields(x["node"])[2], F.array().cast("array<variant>"))
        return F.transform(replies, lambda child, i: F.struct(F.array_append(x["path"], i).alias("path"), child.alias("node")))

    def deeper(state: Column, _: Column) -> Column:
        return F.when(F.size(state["open"]) == 0, state).otherwise(let(
            F.flatten(F.transform(state["open"], children)).cast(nodes),
            lambda level: F.struct(F.concat(state["done"], F.transform(level, message).cast(messages)).alias("done"), level.alias("open"))))

    first = F.struct(path.alias("path"), root.alias("node"))
    start = F.struct(
        F.array(message(first)).cast(messages).alias("done"),
        F.array(first).cast(nodes).alias("open"))
    lists = F.regexp_count(F.to_json(tree), F.lit('"replies"\\s*:\\s*\\[\\s*\\{'))
    rounds = F.least(F.lit(min(max_depth, DEEPEST)), lists)
    unfinished = F.raise_error(F.lit(f"tree deeper than max_depth={min(max_depth, DEEPEST)}"))
    return F.aggregate(F.sequence(F.lit(0), rounds), start, deeper,
                       lambda state: F.when(F.size(state["open"]) > 0, unfinished).otherwise(state["done"]))


def explode_tree(trees: DataFrame, tree_col: str = "tree", key: str = "tree_id", max_depth: int = 100_000) -> DataFrame:
    """TR1: nested trees (one VARIANT per row, ``{prompt: node}``) -> ``(key, path, role, text)``.

    One pass over the rows, without a shuffle, a join or a checkpoint: each row's levels are folded into an array
    of its messages (``_levels``), which is then exploded. A row holds its whole tree anyway, so this needs no more than a
    few copies of it; a tree too large for a row comes in the adjacency form (TR2). A missing ``replies`` or ``replies: null``
    gives no children (S17, lenient); a ``replies`` that is not a list raises. The JSON reader's own nesting
    limit (1,000) allows some 400 levels.
    """
    return trees.select(F.col(key), F.inline(_levels(F.col(tree_col), max_depth))).select(key, "path", "role", "text")


def linearize_messages(nodes: DataFrame, key: str = "tree_id", max_rounds: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """TR2: adjacency rows ``(key, id, parent_id, ord, role, text)`` -> adds ``path`` and ``depth``.

    Pointer jumping: every node holds (ancestor, path segment from that ancestor); a
    round joins each unresolved node with its ancestor's row and concatenates segments,
    so the ancestor distance doubles per round and the loop ends after ceil(log2 depth)
    rounds. Each round is one lookup of the ancestors, in which a node that is the ancestor of
    more than ``hot_rows`` others is dealt over several tasks (``skew.lookup``); only nodes not yet resolved are
    joined and written. An orphan (parent id absent) or a cycle raises instead of being dropped.
    """
    # ids are only unique within their tree, so every step is keyed by both
    twice = nodes.groupBy(key, "id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(1)
    if not twice.isEmpty():
        raise ValueError("a tree holds the same node id twice")
    with Scratch(nodes.sparkSession) as scratch:
        # a tree key may be NULL: as a struct it is a value like any other
        state = scratch.written(
            nodes.select(
                F.struct(F.col(key)).alias("k"), F.col("id"),
                F.col("parent_id").alias("anc"),
                F.when(F.col("parent_id").isNull(), F.array().cast("array<int>"))
                .otherwise(F.array(F.col("ord").cast("int"))).alias("seg"),
            )
        )
        resolved, pending = [state.where(F.col("anc").isNull())], state.where(F.col("anc").isNotNull())
        # Each round doubles the resolved distance, so 64 rounds cover any depth a long can
        # count; running out means a parent chain that never reaches a root.
        rounds = 0
        limit = max_rounds or 64
        while not pending.isEmpty():
            rounds += 1
            if rounds > limit:
                raise RuntimeError("parent links do not reach a root (cycle?)")
            a = reduce(DataFrame.unionByName, [pending, *resolved]).select(
                F.col("k").alias("a_k"), F.col("id").alias("a_id"), F.col("anc").alias("a_anc"), F.col("seg").alias("a_seg"))
            step = scratch.written(lookup(pending, a, [("k", "a_k"), ("anc", "a_id")], ["id"], limit=hot_rows).select(
                F.col("k"), F.col("id"),
                F.when(F.col("a_id").isNull(), F.raise_error(F.concat(
                    F.lit("orphan node, parent not found: "), F.col("anc").cast("string"))))
                .otherwise(F.col("a_anc")).alias("anc"),
                F.concat(F.col("a_seg"), F.col("seg")).alias("seg"),
            ))
            resolved.append(step.where(F.col("anc").isNull()))
            pending = step.where(F.col("anc").isNotNull())
        paths = materialize(reduce(DataFrame.unionByName, resolved).select(
            F.col("k")[key].alias("_k"), F.col("id").alias("_id"), F.col("seg").alias("path")))
    found = nodes.join(paths, F.col(key).eqNullSafe(F.col("_k")) & (F.col("id") == F.col("_id")))
    return found.drop("_k", "_id").withColumn("depth", F.size("path"))
