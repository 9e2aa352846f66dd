"""Keyed permutations and the epochs built on them."""

import collections

import pytest
from pyspark.sql import functions as F

from prefspark.operators import batching, tokens
from prefspark.operators.permute import permuted
from prefspark.plans import fixtures as fx
from prefspark.plans import jobs
from tests.conftest import SF001


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 16, 17, 100, 1000, 10007])
def test_every_size_is_permuted(spark, n):
    got = spark.range(n).select(permuted("id", n, 42, 0).alias("a"), permuted("id", n, 42, 1).alias("b")).collect()
    assert sorted(r.a for r in got) == sorted(r.b for r in got) == list(range(n))
    if n >= 100:
        assert [r.a for r in got] != [r.b for r in got]
        assert sum(r.a == i for i, r in enumerate(got)) < 10


def test_groups_of_their_own_sizes(spark):
    df = spark.range(60).select(F.col("id"), F.when(F.col("id") < 7, 7).otherwise(53).alias("n"))
    df = df.withColumn("i", F.when(F.col("n") == 7, F.col("id")).otherwise(F.col("id") - 7))
    got = df.select("n", permuted("i", F.col("n").cast("bigint"), F.lit("seed"), F.col("n")).alias("p")).collect()
    assert sorted(r.p for r in got if r.n == 7) == list(range(7)) and sorted(r.p for r in got if r.n == 53) == list(range(53))


def test_places_are_spread_evenly(spark):
    """Over many epochs a row comes to every tenth of the order about equally often, and neighbours part."""
    rows = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(1999))).alias("e"))
    got = rows.select(permuted(7, 1000, 3, "e").alias("p"), permuted(8, 1000, 3, "e").alias("q")).collect()
    tenths = collections.Counter(r.p // 100 for r in got)
    assert len(tenths) == 10 and max(tenths.values()) < 270 and min(tenths.values()) > 140
    assert sum(abs(r.p - r.q) == 1 for r in got) < 20


@pytest.mark.parametrize("index", [-1, 5, None])
def test_index_outside_raises(spark, index):
    with pytest.raises(Exception, match="outside the permutation"):
        spark.createDataFrame([(index,)], "i long").select(permuted("i", 5, 1)).collect()


def test_epochs_are_whole_repeatable_and_need_one_exchange(spark):
    keys = spark.range(0, 1001, numPartitions=5).withColumnRenamed("id", "k")
    b = batching.epoch_batches(keys, 4, "k", num_epochs=10)
    assert "Exchange" not in b._jdf.queryExecution().executedPlan().toString()  # the index is the only one, and checkpointed
    rows = b.collect()
    by_epoch = collections.defaultdict(list)
    for r in rows:
        assert r.batch_id == r.idx // 4 and r.step == r.epoch * 251 + r.batch_id + 1
        by_epoch[r.epoch].append((r.k, r.idx))
    orders = set()
    for pairs in by_epoch.values():
        assert sorted(i for _, i in pairs) == sorted(k for k, _ in pairs) == list(range(1001))
        orders.add(tuple(k for k, _ in sorted(pairs, key=lambda p: p[1])))
    assert len(orders) == 10
    again = batching.epoch_batches(keys.repartition(3), 4, "k", num_epochs=10).collect()
    assert sorted(rows) == sorted(again)
    assert sorted(rows) != sorted(batching.epoch_batches(keys, 4, "k", num_epochs=10, seed=1).collect())


def test_prompts_in_permuted_epochs(spark):
    vocab = tokens.build_vocab(fx.table(spark, SF001, "conversations"), "text", min_count=2)
    bench = fx.table(spark, SF001, "benchmark").select(F.col("item_id").alias("prompt_id"), F.col("text").alias("prompt"))
    both = [jobs.prepare_prompts(bench, vocab, num_epochs=3, order=o).collect() for o in ("sorted", "permuted")]
    places = [sorted((r.epoch, r.idx, r.step) for r in rows) for rows in both]
    assert places[0] == places[1]
    strip = lambda rows: sorted({(r.prompt_id, tuple(x for x in r.input_ids if x)) for r in rows})
    assert strip(both[0]) == strip(both[1])
    with pytest.raises(ValueError, match="unknown order"):
        jobs.prepare_prompts(bench, vocab, order="other")


def test_wide_rows_meet_their_batches(spark):
    df = spark.createDataFrame([(i if i != 3 else None, [i] * i) for i in range(9)], "k long, input_ids array<int>")
    wide = batching.assign_batches(df, 4, "k", seed=7, step_col=None).collect()
    narrow = batching.with_batches(df, df, 4, "k", seed=7).select("k", "input_ids", "idx", "batch_id").collect()
    assert sorted(map(str, wide)) == sorted(map(str, narrow))
