"""Frequent values by a sketch, lookups of hot tokens, and nuclei of whole rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefspark.operators import sampling, skew, tokens


def test_sketch_finds_what_holds_a_share(spark):
    df = spark.range(200_000).repartition(9).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit("warm")).when(F.col("id") % 7 == 2, F.lit(None))
        .otherwise(F.concat(F.lit("w"), F.col("id"))).alias("t"))
    got = [r["t"] for r in skew.frequent(df, "t", 2).collect()]
    assert sorted(got) == ["hot", "warm"]
    assert skew.frequent(df.where("false"), "t", 2).count() == 0
    numbers = spark.range(1000).select((F.col("id") % 10 * F.col("id") % 4).cast("int").alias("n"))
    assert [r["n"] for r in skew.frequent(numbers, "n", 1).collect()] == [0]


def test_unseen_token_that_is_a_third_of_all_ids(spark):
    """A token outside the vocabulary, a special and NULLs hold most rows; none meets in one task."""
    rows = spark.range(9000).select(F.col("id").alias("k"), F.lit(0).alias("pos"),
                                    F.when(F.col("id") % 3 == 0, F.lit("unseen")).when(F.col("id") % 3 == 1, F.lit("<pad>"))
                                    .when(F.col("id") % 9 == 2, F.lit(None)).otherwise(F.concat(F.lit("w"), F.col("id") % 100)).alias("token"))
    vocab = spark.createDataFrame([(f"w{i}", i, 1) for i in range(100)] + [("<pad>", 100, 0)], "token string, _id int, count long")
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(name, value)
    try:
        met = tokens._salted_lookup(rows, vocab, "token", ["k"], salt_buckets=64, hot_tokens=10)
        share = [r["count"] for r in met.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(share) == 8 and max(share) < 2 * 9000 / 8
        assert met.count() == 9000 and met.where("_id = 100").count() == 3000 and met.where("_id IS NULL").count() == 4000
        wide = tokens.with_table(rows, vocab.drop("count"), ["k"], max_rows=0)
        assert wide.count() == 9000 and wide.where("_id IS NULL").count() == 4000 and wide.columns == ["k", "pos", "token", "_id"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("top_p, top_k", [(0.9, None), (0.5, 3), (1.1, None), (0.99, 1)])
def test_nucleus_of_rows_equals_the_long_form(spark, top_p, top_k):
    rng = np.random.default_rng(4)
    rows = [(k, [float(x) for x in np.round(rng.standard_normal(30) * 3, 1)]) for k in range(20)]  # rounded, so there are ties
    df = spark.createDataFrame(rows, "seq_id long, logits array<double>")
    long = df.select("seq_id", F.posexplode("logits").alias("item", "logit"))
    flat = sampling.nucleus(long, top_p, 0.7, top_k=top_k)
    want = sorted((r["seq_id"], r["rank"], r["item"], round(r["prob"], 9)) for r in flat.collect())
    held = df.select("seq_id", sampling.nucleus_of("logits", top_p, 0.7, top_k).alias("c"))
    assert "Exchange" not in held._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["seq_id"], i + 1, c["item"], round(c["prob"], 9)) for r in held.collect() for i, c in enumerate(r["c"]))
    assert got == want
    draws = {r["seq_id"]: r["d"] for r in held.select("seq_id", sampling.drawn_of("c", "seq_id", 3).alias("d")).collect()}
    assert draws == {r["seq_id"]: r["item"] for r in sampling.sample_one(flat, 3).collect()}


def test_rows_without_logits(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, [None, 2.0, None])], "seq_id long, logits array<double>")
    got = {r["seq_id"]: r["c"] for r in df.select("seq_id", sampling.nucleus_of("logits").alias("c")).collect()}
    assert got[1] == [] and got[2] is None and [(c["item"], c["prob"]) for c in got[3]] == [(1, 1.0)]
