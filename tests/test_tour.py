"""Euler tours of reply trees, and lookups of hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from prefspark.operators import skew, tour, trees

NODES = "tree_id long, id long, parent_id long, ord int, role string, text string"


def nodes_of(spark, rows):
    return spark.createDataFrame([(*r, "prompter", "x") for r in rows], NODES)


def plain(rows):
    """(tree, id) -> (preorder, depth) by a depth-first walk."""
    kids = {}
    for tree, i, parent, ord_ in rows:
        kids.setdefault((tree, parent), []).append((ord_, i))
    out = {}
    for tree in {r[0] for r in rows}:
        stack, n = [(i, 0) for _, i in sorted(kids[tree, None], reverse=True)], 0
        while stack:
            i, depth = stack.pop()
            out[tree, i] = (n, depth)
            n += 1
            stack += [(c, depth + 1) for _, c in sorted(kids.get((tree, i), []), reverse=True)]
    return out


def got(df):
    return {(r["tree_id"], r["id"]): (r["preorder"], r["depth"]) for r in df.collect()}


def test_random_forests(spark):
    rng = random.Random(3)
    rows = []
    for tree in range(30):
        for i in range(rng.randint(1, 40)):
            rows.append((tree, i * 7, None if i == 0 else rng.randrange(i) * 7, rng.randint(0, 5)))
    rows += [(50, 1, None, 0), (50, 2, None, 1), (50, 3, 1, 0), (50, 4, 2, 0)]  # two roots
    rng.shuffle(rows)
    assert got(tour.preorder(nodes_of(spark, rows))) == plain(rows)


def test_chain_and_null_key(spark):
    rows = [(1, i, i - 1 if i else None, 0) for i in range(300)]
    assert got(tour.preorder(nodes_of(spark, rows))) == {(1, i): (i, i) for i in range(300)}
    lone = [(None, 5, None, 0), (None, 6, 5, 3)]
    assert got(tour.preorder(nodes_of(spark, lone))) == {(None, 5): (0, 0), (None, 6): (1, 1)}


def test_star_has_no_hot_key(spark):
    """Every step has one predecessor and every predecessor one successor, so no join key holds two rows."""
    n = 100_000
    replies = spark.range(1, n + 1).select(F.lit(1).cast("bigint").alias("tree_id"), "id", F.lit(0).cast("bigint").alias("parent_id"),
                                           (F.lit(n) - F.col("id")).cast("int").alias("ord"))
    star = replies.unionByName(spark.createDataFrame([(1, 0, None, 0)], "tree_id long, id long, parent_id long, ord int"))
    listed, _ = tour.steps(star)
    most = listed.where("before IS NOT NULL").groupBy("before").count().agg(F.max("count"), F.count("*")).first()
    assert tuple(most) == (1, n + 1) and listed.count() == n + 2
    wrong = tour.preorder(star).where(F.when(F.col("id") == 0, (F.col("preorder") != 0) | (F.col("depth") != 0)).otherwise(
        (F.col("preorder") != n + 1 - F.col("id")) | (F.col("depth") != 1)))
    assert wrong.count() == 0


@pytest.mark.parametrize("rows, error", [
    ([(1, 1, None, 0), (1, 2, 9, 0)], "orphan"),
    ([(1, 1, None, 0), (1, 2, 1, 0), (1, 2, 1, 1)], "twice"),
    ([(1, 1, None, 0), (1, 2, 3, 0), (1, 3, 2, 0)], "cycle"),
])
def test_broken_trees_raise(spark, rows, error):
    with pytest.raises(Exception, match=error):
        tour.preorder(nodes_of(spark, rows)).collect()


def test_paths_of_a_star_of_stars_with_hot_ancestors(spark):
    rows = [(1, 0, None, 0)] + [(1, i, 0, i) for i in range(1, 60)] + [(1, 1000 + i, 7, i) for i in range(200)]
    rows += [(1, 5000 + i, 1003, i) for i in range(300)]
    found = trees.linearize_messages(nodes_of(spark, rows), hot_rows=20)
    paths = {r["id"]: r["path"] for r in found.collect()}
    parent = {i: (p, o) for _, i, p, o in rows}

    def path(i):
        return [] if parent[i][0] is None else [*path(parent[i][0]), parent[i][1]]

    assert paths == {i: path(i) for i in parent}


def test_hot_and_null_keys_are_dealt_over_tasks(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None))
                                        .otherwise(F.col("id").cast("string")).alias("w"))
        table = spark.createDataFrame([("hot", 1), ("2", 2), ("5", 3)], "token string, v int")
        joined = skew.lookup(rows, table, [("w", "token")], ["id"], limit=100)
        share = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(share) == 8 and max(r["count"] for r in share) < 2 * 9000 / 8
        sums = joined.agg(F.count("*"), F.count("v"), F.sum("v")).first()
        assert tuple(sums) == (9000, 3002, 3000 + 2 + 3)
        inner = skew.lookup(rows, table, [("w", "token")], ["id"], how="inner", limit=100)
        assert inner.count() == 3002 and inner.columns == ["id", "w", "token", "v"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])


def test_no_intermediate_table_stays(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    before = set(folder.glob("scratch-*"))
    rows = [(1, i, i - 1 if i else None, 0) for i in range(20)]
    assert tour.preorder(nodes_of(spark, rows)).count() == trees.linearize_messages(nodes_of(spark, rows)).count() == 20
    with pytest.raises(Exception, match="orphan"):
        trees.linearize_messages(nodes_of(spark, [(1, 2, 9, 0)]))
    assert set(folder.glob("scratch-*")) == before
