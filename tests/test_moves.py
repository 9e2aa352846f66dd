"""How often a query works out and moves its rows."""

import numpy as np
from pyspark.sql import functions as F

from __spark_entry__ import queries
from prefspark.operators import logps, scan, skew
from tests.conftest import SF001


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.find("Initial Plan")] if "Initial Plan" in plan else plan


def test_padded_logps_moves_its_tokens_once_a_model(spark):
    """both flags come from one table, so each model's tokens meet once, not once a flag."""
    plan = final_plan(queries()["padded_logps"](spark, SF001))
    by_token = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(pair_id" in ln and ", pos#" in ln and "Reused" not in ln]
    by_batch = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(batch_id" in ln and "Reused" not in ln]
    assert len(by_token) == 2 and len(by_batch) <= 2


def test_both_means_of_one_aggregation(spark):
    rows = [(k, p, float(p) - 3.5 * k, 2 * k, 9, p > 5) for k in (0, 1, 5) for p in range(8)] + [(None, 0, 1.0, 0, 2, False)]
    lp = spark.createDataFrame(rows, "k long, pos long, lp double, prompt_len long, length long, pad boolean")
    read = lambda df: {r["k"]: (r["lp"], r["response_cut"]) for r in df.collect()}
    both = logps.response_mean(lp, ["k"], ["lp"], pad_col="pad", mask_padding=None)
    assert both.count() == 8
    for flag in (False, True):
        assert read(both.where(f"masked = {int(flag)}")) == read(logps.response_mean(lp, ["k"], ["lp"], pad_col="pad", mask_padding=flag))


def test_next_value_reads_its_rows_once(spark):
    """the first row of the next piece comes with the rows; it is not worked out again and joined."""
    df = spark.range(0, 900, numPartitions=3).select((F.col("id") % 3).alias("s"), F.floor(F.col("id") / 3).alias("pos"), (F.col("id") * 1.0).alias("v"))
    out = scan.next_value(df, ["s"], "pos", "v", "n", piece=64)
    plan = final_plan(out)
    assert "Join" not in plan and plan.count("Range (") == 1 and plan.count("Exchange hashpartitioning") == 1
    got = {(r["s"], r["pos"]): r["n"] for r in out.collect()}
    assert len(got) == out.count() == 900
    assert got == {(s, t): float(3 * (t + 1) + s) if t < 299 else 0.0 for s in range(3) for t in range(300)}


def test_next_value_of_odd_rows(spark):
    """Null keys are one sequence, null values count as missing, and rows that repeat meet each other's first values."""
    rows = [(None, t, float(t)) for t in range(9)] + [(1, t, None if t % 4 == 0 else float(t)) for t in range(9)] + [(2, t, 5.0) for t in range(6)] * 2
    got = {}
    for r in scan.next_value(spark.createDataFrame(rows, "s long, pos long, v double"), ["s"], "pos", "v", "n", piece=4).collect():
        got.setdefault((r["s"], r["pos"]), []).append(r["n"])
    assert [got[None, t] for t in range(9)] == [[float(t + 1)] for t in range(8)] + [[0.0]]
    assert [got[1, t] for t in range(9)] == [[1.0], [2.0], [3.0], [0.0], [5.0], [6.0], [7.0], [0.0], [0.0]]
    assert [len(got[2, t]) for t in range(6)] == [4, 4, 4, 4, 2, 2]  # as a join with both first rows gives


def test_lookup_with_known_counts(spark):
    """Hot keys known from the table's own counts deal the same rows as counting them again."""
    rows = spark.range(4000).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5 % 3).alias("k"), "id")
    table = rows.groupBy(F.col("k").alias("of")).agg(F.sum("id").alias("t"), F.count(F.lit(1)).alias("n"))
    known = skew.lookup(rows, table, [("k", "of")], ["id"], limit=100, counted="n")
    plain = skew.lookup(rows, table.drop("n"), [("k", "of")], ["id"], limit=100)
    key = lambda df: sorted((r["id"], r["k"] is None, r["k"] or 0, r["t"] or 0) for r in df.collect())
    assert known.columns == plain.columns and key(known) == key(plain)


def test_long_scan_works_its_rows_out_twice(spark):
    """heads are kept, so checking and scanning them read ``df`` once, and the result once more."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    x = np.random.default_rng(7).standard_normal(300)
    df = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate(x)], "s long, pos long, x double").mapInArrow(look, "s long, pos long, x double")
    got = [r["y"] for r in scan.discounted_sums(df, ["s"], "pos", "x", 0.97, "y", piece=16).orderBy("pos").collect()]
    want = [sum(x[s] * 0.97 ** (s - t) for s in range(t, 300)) for t in range(300)]
    assert np.allclose(got, want) and seen.value <= 600
