"""Operators 3 and 9 against brute force over all pairs."""

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prefspark.llm import embed_dedup, queries, simhash
from prefspark.llm.components import connected_components
from prefspark.llm.oracle import SQL


def components(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_and_components(spark, make_docs):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = list(rng.choice(words, 120))
        for _ in range(4):
            rows.append((len(rows) + 7, " ".join(text)))
            text[int(rng.integers(120))] = "Ä"
    rows += [(1000, ""), (1001, None), (1002, " \t\n"), (1003, "one Two"), (1004, "ONE two"), (1005, "É x"), (1006, "é x"), (1003, "one Two"), (None, "one two")]
    rows += [(2000 + i, "same text over and over again") for i in range(200)]
    got = simhash.near_duplicates(make_docs(rows), shard_rows=16).collect()
    assert len(got) == len(rows)
    fps = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    links = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 4]
    label = components(distinct, links)
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[label[f]] = min(i, least.get(label[f], i))
    want = sorted((i if i is not None else -1, f, least[label[f]]) for (i, _), f in zip(rows, fps))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fp & (2**64 - 1), r.component_id) for r in got) == want


def test_keep_one(spark, make_docs):
    docs = make_docs([
        (5, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (9, "something else entirely here"), (None, "a b c d e"),
        (9, "one id but quite another text"), (None, "no id on either"), (None, "no id on either"), (None, None), (7, ""),
    ]).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x")).withColumn("row_no", F.lit("y"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [
        (-1, "no id on either"), (3, "a b c d e"), (7, ""), (9, "one id but quite another text"), (9, "something else entirely here")]
    assert simhash.keep_one(make_docs([])).count() == 0
    assert simhash.near_duplicates(make_docs([])).count() == 0


def test_ranges_follow_the_fingerprints(spark):
    """Shards stay about as large as the table grows, and every number of ranges gives the same components."""
    assert [simhash.ranges_for(n, 4) for n in (0, 10**6, 10**8, 10**10)] == [5, 5, 6, 7]
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**63), 2**63 - 1, 400)
    fps = {int(x) for x in base} | {int(x) ^ (1 << int(a)) ^ (1 << int(b)) for x, a, b in zip(base, rng.integers(0, 63, 400), rng.integers(0, 63, 400))}
    prints = spark.createDataFrame([(f, f) for f in fps], "fp long, rep long")
    found = [
        {(r.node, r.component) for r in connected_components(simhash.near_links(prints, 4, blocks)).collect()} for blocks in (5, 6, 7)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 600


def test_search_follows_only_edges_within_the_radius():
    """A tree of clustered fingerprints is searched without measuring most of its nodes; one of random ones with some left out."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**64 - 1, 40, dtype=np.uint64)
    bits = np.left_shift(np.uint64(1), rng.integers(0, 64, (4000, 6)).astype(np.uint64))
    clustered = np.unique(np.bitwise_xor.reduce(bits, axis=1) ^ np.repeat(centres, 100))
    for fps, share in ((clustered, 0.6), (np.unique(rng.integers(0, 2**64 - 1, 4000, dtype=np.uint64)), 0.9)):
        one = np.zeros(len(fps), np.int64)
        forest = simhash.Forest(fps, one)
        found = sum(len(who) for who, _ in forest.search(fps[::40], one[::40], 4))
        gaps = np.bitwise_count(fps[::40, None] ^ fps[None, :])
        assert found == int((gaps <= 4).sum())
        print("visited", forest.visited / gaps.size)
        assert forest.visited <= share * gaps.size


def test_very_long_text_is_read_whole():
    text = " ".join(f"w{i % 5003}" for i in range(60_000))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=60, unique=True), st.integers(0, 8), st.randoms(use_true_random=False))
def test_forest_finds_all_within_radius(values, radius, random):
    near = [v ^ (1 << random.randrange(64)) for v in values]
    fps = np.array(sorted(set(values + near)), np.uint64)
    group = np.arange(len(fps)) % 2
    forest = simhash.Forest(fps, group)
    found = {(int(a), int(b)) for who, node in forest.search(fps, group, radius) for a, b in zip(who, node)}
    want = {(i, j) for i in range(len(fps)) for j in range(len(fps)) if group[i] == group[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
    assert found == want


@pytest.mark.parametrize("links", [[], [(1, 1), (None, 2)], [(i, i + 1) for i in range(300)], [(0, i) for i in range(1, 200)], [(3, 1), (1, 3), (9, 8), (8, 7), (2, 5)]])
def test_connected_components(spark, links):
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == components({n for e in real for n in e}, real)


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((40, 16))
    rows = []
    for i, v in enumerate(base):
        for k in range(int(rng.integers(1, 6))):
            rows.append((len(rows), [float(x) for x in v + 0.03 * k * rng.standard_normal(16)], int(i % 3)))
    n = len(rows)
    rows += [(n + i, rows[0][1], rows[0][2]) for i in range(30)]  # copies
    rows += [(n + 40, rows[0][1], None), (n + 41, None, 0), (n + 42, [0.0] * 16, 0), (n + 43, [0.0] * 16, 0), (n + 44, [float("nan")] * 16, 0),
             (n + 45, [1.0] * 4, 0), (n + 46, [2.0] * 4, 0), (n + 47, [], 0), (n + 48, [None, 1.0], 0), (n + 49, [-0.0, 1.0], 1), (n + 50, [0.0, 1.0], 1), (n + 50, [0.0, 1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {}
    for r in embed_dedup.near_duplicates(table, block_rows=8).collect():
        got[r.vec_id] = (r.n_links, r.component_id, r.kept)
    ok = [(i, np.array(v), la) for i, v, la in rows if la is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [(a[0], b[0]) for x, a in enumerate(ok) for y, b in enumerate(ok)
             if x != y and a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / (np.sqrt(a[1] @ a[1]) * np.sqrt(b[1] @ b[1])) >= 0.98]
    label = components([r[0] for r in rows], links)
    count = {}
    for a, _ in links:
        count[a] = count.get(a, 0) + 1
    count[n + 50] = count[n + 50] // 2  # a repeated row is counted once for each of its rows
    assert got == {r[0]: (count.get(r[0], 0), label[r[0]], label[r[0]] == r[0]) for r in rows}
    assert embed_dedup.near_duplicates(table.limit(0)).count() == 0


def test_bound_never_loses_a_pair():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.standard_normal(x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * noise
    bits, factor = embed_dedup.encode(x, 42)
    estimates = np.array([embed_dedup.estimate(bits[i : i + 1], factor[i : i + 1], y[i : i + 1], 42)[0, 0] for i in range(len(x))])
    assert (estimates >= embed_dedup.least_estimate(factor, 0.98)).all()
    assert abs((estimates - 0.98).mean()) < 0.01  # unbiased


def test_queries_match_oracle(spark):
    from tests.conftest import SF001

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    for name in SQL:
        # rows as Python values: a data frame would show integers next to nulls as floats
        got = queries.QUERIES[name](spark, SF001).toArrow()
        want = con.execute(SQL[name]).to_arrow_table().select(got.column_names)
        rows = [sorted(str(list(r.values())) for r in t.to_pylist()) for t in (got, want)]
        assert rows[0] == rows[1] and rows[0], name
