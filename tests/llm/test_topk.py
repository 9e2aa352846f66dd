"""Operator 11 against brute force in Python integers."""

import duckdb
import numpy as np

from prefspark.llm import queries, topk
from prefspark.llm.oracle import SQL

VECTORS = "vec_id long, embedding array<double>"


def terms(v):
    if v is None or any(x is None or not np.isfinite(x) for x in v):
        return None
    return [max(-topk.MOST_WEIGHT, min(topk.MOST_WEIGHT, int(np.floor(256 * x)))) for x in v]


def brute(rows, asks, top):
    rows = [(i, terms(v)) for i, v in rows if i is not None and terms(v) is not None]
    asks = {(i, tuple(terms(v))) for i, v in asks if i is not None and terms(v) is not None}
    out = []
    for query, q in asks:
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), i) for i, v in rows if i != query)[:top]
        out += [(query, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, top=5, **how):
    df = spark.createDataFrame(rows, VECTORS)
    got = topk.search(df, df.where("vec_id % 50 = 0"), top=top, **how).collect()
    return got, sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def as_rows(v, seed=0):
    ids = np.random.default_rng(seed).permutation(len(v))
    return [(int(i), [float(x) for x in r]) for i, r in zip(ids, v, strict=True)]


def test_random_vectors_are_whole_and_exact(spark):
    rows = as_rows(np.random.default_rng(1).standard_normal((400, 12)) * 0.2)
    asks = [r for r in rows if r[0] % 50 == 0]
    assert run(spark, rows, block_rows=8, shard_blocks=4)[1] == brute(rows, asks, 5)


def test_clustered_vectors_leave_most_blocks_unscored(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16)) * 0.3
    rows = as_rows(centres[rng.integers(0, 12, 600)] + rng.standard_normal((600, 16)) * 0.01)
    got, plain = run(spark, rows, block_rows=8, shard_blocks=4, work=True)
    assert plain == brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert np.mean([r.blocks_scored for r in got]) < 0.25 * 600 / 8


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = as_rows(rng.standard_normal((90, 8)) * 0.3)
    hot = rows[0][1]
    rows += [(1000 + i, hot) for i in range(120)]  # more copies than a block holds: ties by id
    rows += [(None, [1.0] * 8), (2000, None), (2050, []), (2100, [0.0] * 8), (2150, [None, 1.0]), (2200, [float("nan")] * 8)]
    rows += [(2250, [float("inf")]), (2350, [1.0]), (2350, [1.0]), (2350, [2.0]), (2400, [5.0] * 40), (5, rows[3][1])]
    asks = [r for r in rows if r[0] is not None and r[0] % 50 == 0]
    assert run(spark, rows, block_rows=8, shard_blocks=4)[1] == brute(rows, asks, 5)


def test_sums_beyond_doubles_are_exact(spark):
    rows = [(0, [8e6, 8e6, 1 / 256]), (1, [8e6, 8e6, 1 / 256]), (2, [8e6, 8e6, 0.0]), (3, [-1e300, 1e300]), (50, [1e300] * 3)]
    assert run(spark, rows)[1] == brute(rows, [rows[0], rows[4]], 5)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (7, [1.0, -2.0])]
    assert run(spark, rows)[1] == [(0, 1, 7, 256 * 256 - 512 * 512)]
    assert run(spark, rows[:1])[1] == [] and run(spark, [])[1] == []


def test_bounds_hold_and_order_is_by_bound():
    rng = np.random.default_rng(4)
    rows = np.floor(rng.standard_normal((64, 6)) * 50)
    shard = topk.Shard(np.arange(64), rows, 8)
    queries_ = np.floor(rng.standard_normal((10, 6)) * 50)
    bound = topk.bounds(queries_, shard.high, shard.low)
    scores = queries_ @ rows.T
    assert (bound >= np.maximum.reduceat(scores, shard.cuts[:-1], axis=1)).all()
    best, scored = topk.search_shard(shard, queries_, np.full(10, -1), [(-np.inf, topk.MOST_SCORE)] * 10, 1)
    for q in range(10):  # a block is scored only if its bound reaches the best score
        assert best[q].found[0][0] == -scores[q].max() and scored[q] <= (bound[q] >= scores[q].max()).sum() + 8


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], i, 0, "x") for i in range(60)], "vec_id long, embedding array<float>, q long, score long, terms string")
    got = topk.search(df, df.where("vec_id = 50"), top=2).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(59, 256 * 256 * (50 * 59 + 1)), (58, 256 * 256 * (50 * 58 + 1))]


def test_query_matches_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet')")
    got = sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in queries.op11_topk(spark, folder).collect())
    assert got == sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({SQL['op11_topk']})").fetchall())
