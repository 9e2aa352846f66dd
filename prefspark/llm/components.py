"""Connected components of a link table, by rounds of minimum-priority labels.

Each round sends every node to the neighbour (or itself) with the smallest hashed priority,
renames the links accordingly and drops those whose ends meet. Priorities are random, so a
chain in id order shrinks by a constant factor a round, like any other graph: the number of
rounds is logarithmic. Minima are pre-aggregated in the map tasks, so a node with very many
links costs one row per task. Each round's tables are written to the shared folder; the driver
sees only row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import materialized


def connected_components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); component is its smallest node.

    Links with a null end and links of a node to itself say nothing and are left out. An empty
    table gives an empty result. More than ``max_rounds`` rounds raise; random priorities make
    that many impossible below astronomically many nodes.
    """
    edges = materialized(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    )
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        if len(rounds) == max_rounds:
            raise RuntimeError("links still remain after the last round")
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                              F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
        best = F.min(F.struct(F.xxhash64("v").alias("h"), F.col("v").alias("v")))
        parents = materialized(
            ends.groupBy("u").agg(best.alias("best"))
            .select("u", F.when(F.col("best.h") < F.xxhash64("u"), F.col("best.v")).otherwise(F.col("u")).alias("p"))
        )
        rounds.append(parents)
        ends_a = parents.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        ends_b = parents.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        renamed = edges.join(ends_a, "a").join(ends_b, "b")
        edges = materialized(
            renamed.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).where("a < b").distinct()
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = rounds[0].select(F.col("u").alias("node"), F.col("p").alias("label"))
    for parents in rounds[1:]:
        step = parents.select(F.col("u").alias("label"), F.col("p").alias("next"))
        labels = labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    labels = materialized(labels)
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")
