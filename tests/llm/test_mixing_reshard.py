"""Operators 5 and 7: laws, brute force and odd rows."""

import heapq
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prefspark.llm import mixing, reshard


def plain_targets(sizes, most=3):
    """Water filling one source at a time; sizes in source order."""
    weight = [i % 3 + 1 for i in range(len(sizes))]
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        open_weight = sum(w for i, w in enumerate(weight) if i not in capped)
        aim = [most * sizes[i] if i in capped else rest * weight[i] / open_weight for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if i not in capped and aim[i] > most * sizes[i]}
        if not over or not total:
            return aim if total else [0.0] * len(sizes)
        capped |= over


def mixed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    return mixing.mix(docs, "size", block_words=4).collect()


@pytest.mark.parametrize("sizes", [[500, 20, 900, 40, 3000, 70, 1], [100, 100, 100], [10_000, 1], [7], [300, 0, 50]])
def test_targets_and_taken(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]  # null comes last
    rows = []
    for name, size in zip(names, sizes):
        while size > 0:
            part = min(size, 37)
            rows.append((len(rows), name, part))
            size -= part
        rows.append((len(rows), name, 0))
    got = mixed(spark, rows)
    assert len(got) == len(rows)
    for name, size, aim in zip(names, sizes, plain_targets(sizes)):
        own = [r for r in got if r.source == name]
        assert all(abs(r.target - aim) < 1e-6 * max(1, aim) and r.source_size == size for r in own)
        assert abs(sum(r.taken for r in own) - aim) <= 8 + 0.02 * aim
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    assert sorted(got) == sorted(mixed(spark, rows))  # reruns agree


def test_quotas_are_sainte_lague(spark):
    sizes = {"sa": 700, "sb": 90, "sc": 400, "sd": 33}
    totals = spark.createDataFrame(list(sizes.items()), "src string, source_size long")
    aimed = mixing.targets(totals)
    target = {r.src: r.target for r in aimed.collect()}
    quotas = mixing.quotas(aimed, shards=5, block_words=3).collect()
    block = quotas[0].block
    houses = int(sum(sizes.values()) / block + 0.5)
    heap, seats, awarded = [(-target[s] / 1, i, s, 0) for i, s in enumerate(sorted(sizes))], dict.fromkeys(sizes, 0), []
    heapq.heapify(heap)
    for _ in range(houses):
        _, i, s, k = heapq.heappop(heap)
        seats[s] += 1
        awarded.append(dict(seats))
        heapq.heappush(heap, (-target[s] / (2 * k + 3), i, s, k + 1))
    for r in quotas:
        house = houses * (r.shard + 1) // 5
        assert r.upto == awarded[house - 1][r.src] and r.quota >= 0
    assert sum(r.quota for r in quotas) == houses


def test_take_keeps_words(spark, make_docs):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(20)), "en", f"s{i % 3}") for i in range(30)] + [(99, None, "en", None), (98, " \n", "en", "s0"), (97, "a  b\nc", "en", None)]
    docs = make_docs(rows).withColumn("size", mixing.word_count()).withColumn("laps", F.lit("clash"))
    out = mixing.mix(docs, "size", block_words=4)
    assert out.count() == len(rows)
    taken = {r.doc_id: r.taken for r in out.collect()}
    pieces = mixing.take(out).collect()
    words = {}
    for r in pieces:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert r.text in dict((i, t) for i, t, *_ in rows)[r.doc_id]
    assert words == {i: t for i, t in taken.items() if t}
    assert mixing.mix(docs.limit(0), "size").count() == 0


def test_blocks_fill_the_quotas_of_shards(spark):
    """Half of the rows of the largest source have no id, most of them one size; every shard gets the blocks of its quota."""
    rows = [(None if i % 2 else i, "a", 20 if i % 4 else i % 97) for i in range(3000)] + [(9000 + i, "b", 15) for i in range(400)]
    got = mixed(spark, rows)
    assert sorted((r.doc_id or -1, r.source, r.size) for r in got) == sorted((i or -1, s, n) for i, s, n in rows)
    totals = spark.createDataFrame([("sa", sum(n for _, s, n in rows if s == "a")), ("sb", 6000)], "src string, source_size long")
    for q in mixing.quotas(mixing.targets(totals), shards=8, block_words=4).collect():
        words = sum(r.shard_words[q.shard] for r in got if "s" + r.source == q.src)
        assert q.quota * q.block - 3 * q.block <= words <= q.quota * q.block  # less by the last block of a source, once a lap
    for r in got:
        assert r.taken == sum(r.shard_words) == r.laps * r.size + sum(c.b - c.a for c in r.cuts)
        assert all(0 <= c.a < c.b <= r.size for c in r.cuts) and all(c.b <= d.a for c, d in zip(r.cuts, r.cuts[1:]))
    assert sum(1 for r in got if r.cuts) > 1000  # blocks are drawn from all over the source, not from one stretch
    key = lambda r: (r.doc_id or -1, r.size, r.source, r.taken, r.shard_words)
    assert sorted(map(key, got)) == sorted(map(key, mixed(spark, rows[::-1])))


def test_no_words_at_all(spark):
    assert [(r.target, r.taken) for r in mixed(spark, [(1, "a", 0), (None, None, 0)])] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 50])
def test_reshard_rows_law(spark, make_docs, n):
    docs = make_docs([(i, "é" * (i % 11)) for i in range(n - 1)] + ([(None, None)] if n else []))
    old = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("doc_id") % 3 == 0, F.lit(9)).otherwise(F.lit(2))
    got = reshard.reshard(docs.withColumn("old", old), "old", shards=8).collect()
    assert len(got) == n
    per = [[r.slot for r in got if r.shard == j] for j in range(8)]
    assert max(map(len, per)) - min(map(len, per)) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in per)
    for r in got:
        text = "" if r.doc_id is None else "é" * (r.doc_id % 11)
        assert (r.size, r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 20)), min_size=1, max_size=7))
def test_flow_moves_fewest_bytes(rows):
    """With one row a block, the network's answer is the cheapest of all assignments (3 new shards)."""
    rows = sorted(rows)
    blocks, count = [], {}
    for old, size in rows:
        blocks.append((old, count.get(old, 0), 1, size))
        count[old] = count.get(old, 0) + 1
    moves = reshard.solve_moves(blocks, 3)
    place = {(old, r): new for old, a, b, new in moves for r in range(a, b)}
    assert len(place) == len(rows)
    moved = sum(b[3] for b in blocks if place[b[0], b[1]] != b[0])
    low, high = len(rows) // 3, -(-len(rows) // 3)
    best = min(
        sum(b[3] for b, j in zip(blocks, choice) if b[0] != j)
        for choice in product(range(3), repeat=len(rows))
        if all(low <= choice.count(j) <= high for j in range(3))
    )
    assert moved == best
    assert all(low <= list(place.values()).count(j) <= high for j in range(3))


def test_rewrite_only_affected_shards(spark, make_docs, tmp_path):
    docs = make_docs([(i, f"text {i}") for i in range(32)])
    old = F.when(F.col("doc_id") < 8, 0).when(F.col("doc_id") < 16, 1).when(F.col("doc_id") < 28, 2).otherwise(3).cast("int")
    placed = reshard.reshard(docs.withColumn("old", old), "old", shards=4)
    affected = reshard.rewrite(docs, placed, str(tmp_path / "out"), rows_a_file=5)
    assert affected == [2, 3]
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.groupBy("shard").count().orderBy("shard").collect() == [(2, 8), (3, 8)]
    assert {r.doc_id for r in out.collect()} == set(range(16, 32))


def test_rewrite_keeps_null_and_repeated_ids(spark, make_docs, tmp_path):
    ids = [None] * 5 + [7] * 9 + list(range(20, 30))
    docs = make_docs([(i, f"text {n % 6} {n}" if n % 4 else None) for n, i in enumerate(ids)])
    docs.withColumn("old", F.when(F.col("doc_id") == 7, 0).otherwise(2)).write.parquet(str(tmp_path / "old"))
    rows = spark.read.parquet(str(tmp_path / "old")).select(
        "doc_id", "text", "old", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    key = ["file", "at"]
    placed = reshard.reshard(rows, "old", shards=4, row_cols=key)
    reshard.rewrite(rows, placed, str(tmp_path / "out"), rows_a_file=3, row_cols=key)
    out = spark.read.parquet(str(tmp_path / "out"))
    pairs = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    assert pairs(out) == pairs(docs)
    with pytest.raises(ValueError, match="doc_id"):
        reshard.rewrite(docs, placed, str(tmp_path / "by_id"))
    done = reshard.resharded(rows, "old", key, shards=4, rows_a_file=3).collect()
    assert sorted((r.shard, r.slot, r.size, r.text_crc32) for r in done) == sorted((r.shard, r.slot, r.size, r.text_crc32) for r in placed.collect())


def test_query_writes_its_shards(spark, tmp_path):
    """The query's rows come from written shards, and no row is lost; shards left alone are not written."""
    from prefspark.llm.queries import QUERIES

    rows = [(i % 5 or None, f"t{i}", f"s{i % 3}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op5_reshard"](spark, str(tmp_path))
    assert any("/shards-" in f for f in out.inputFiles())
    got = out.collect()
    assert sorted(r.text_crc32 for r in got) == sorted(zlib.crc32(t.encode()) for _, t, _ in rows)
    assert all(sorted(r.slot for r in got if r.shard == j) == list(range(5)) for j in range(8))
