"""Discounted sums over pieces against the recursion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefspark.operators import rollout, scan
from prefspark.plans import fixtures as fx
from tests.conftest import SF001


def recursion(x, g):
    out, acc = np.zeros(len(x)), 0.0
    for t in reversed(range(len(x))):
        acc = x[t] + g * acc
        out[t] = acc
    return out


@pytest.mark.parametrize("factor, piece", [(0.9405, 7), (0.9405, 1 << 16), (0.9999, 3), (1.0, 16), (1e-4, 1000), (1.01, 50)])
def test_sums_of_many_sequences(spark, factor, piece):
    rng = np.random.default_rng(1)
    seqs = {(b, s): rng.standard_normal(n) for b, s, n in [(0, 1, 1), (0, 2, 700), (1, 3, 701), (1, 4, 64), (None, 5, 100)]}
    rows = [(b, s, t, float(v)) for (b, s), x in seqs.items() for t, v in enumerate(x)]
    df = spark.createDataFrame(rows, "b long, s long, pos long, x double").repartition(5)
    got = {}
    for r in scan.discounted_sums(df, ["b", "s"], "pos", "x", factor, "y", piece).collect():
        got.setdefault((r["b"], r["s"]), {})[r["pos"]] = r["y"]
    for k, x in seqs.items():
        want = recursion(x, factor)
        assert len(got[k]) == len(x)
        assert np.allclose([got[k][t] for t in range(len(x))], want, rtol=1e-9, atol=1e-9)


def test_scan_of_scans(spark, monkeypatch):
    """Few numbers a fold, so that pieces are scanned over several levels."""
    monkeypatch.setattr(scan, "FOLD", 4)
    x = np.random.default_rng(2).standard_normal(1500)
    df = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate(x)], "s long, pos long, x double")
    for factor in (0.97, 0.9999):
        got = scan.discounted_sums(df, ["s"], "pos", "x", factor, "y", piece=5).orderBy("pos").collect()
        assert np.allclose([r["y"] for r in got], recursion(x, factor), rtol=1e-9, atol=1e-9)


def test_one_sequence_of_two_million_positions(spark):
    n, g = 2_000_000, 0.99 * 0.95
    df = spark.range(0, n, numPartitions=8).select(F.lit(1).alias("s"), F.col("id").alias("pos"), F.sin(F.col("id") * 0.37).alias("x"))
    out = scan.discounted_sums(df, ["s"], "pos", "x", g, "y")
    # y_t - g * y_{t+1} = x_t; a closed form of the infinite sum far from the end
    x = np.sin(np.arange(n) * 0.37)
    want = recursion(x, g)
    probe = {r["pos"]: r["y"] for r in out.where(F.col("pos").isin([0, 11111, 999_999, n - 2, n - 1])).collect()}
    assert all(abs(probe[t] - want[t]) < 1e-9 for t in probe) and len(probe) == 5
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart, as large ones do
    try:
        dealt = scan.discounted_sums(df, ["s"], "pos", "x", g, "y")
        share = dealt.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.count("*")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert share[0] <= n / 4 and share[1] == 8  # one sequence, all tasks
    total = out.agg(F.sum("y")).first()[0]
    assert abs(total - want.sum()) < 1e-4


def test_next_values_and_gap(spark):
    df = spark.createDataFrame([(s, t, float(10 * s + t)) for s in (1, 2) for t in range(9)], "s long, pos long, v double")
    got = {(r["s"], r["pos"]): r["n"] for r in scan.next_value(df, ["s"], "pos", "v", "n", piece=4).collect()}
    assert got == {(s, t): float(10 * s + t + 1) if t < 8 else 0.0 for s in (1, 2) for t in range(9)}
    with pytest.raises(ValueError, match="gap"):
        scan.discounted_sums(df.where("pos < 3 OR pos > 7"), ["s"], "pos", "v", 0.9, "y", piece=2)


@pytest.mark.parametrize("at", ["last_column", "last_token"])
@pytest.mark.parametrize("lam", [0.95, 0.0])
def test_long_chain_equals_the_window_chain(spark, at, lam):
    roll = fx.c4_rollouts(spark, SF001)
    key = lambda df: sorted((r["batch_id"], r["seq_id"], r["pos"], round(r["advantage"], 9), round(r["returns"], 9), r["mask"])
                            for r in df.collect())
    assert key(rollout.long_advantages(roll, lam=lam, reward_at=at, piece=16)) == key(rollout.advantages(roll, lam=lam, reward_at=at))


def test_metrics_mask_padding(spark):
    adv = rollout.advantages(fx.c4_rollouts(spark, SF001))
    masked = {r["batch_id"]: r for r in rollout.rollout_metrics(adv, mask_padding=True).collect()}
    for r in rollout.ppo_loss(adv, mask_padding=True).collect():
        assert masked[r["batch_id"]]["loss"] == pytest.approx(r["loss"]) and masked[r["batch_id"]]["value_loss"] == pytest.approx(r["value_loss"])
