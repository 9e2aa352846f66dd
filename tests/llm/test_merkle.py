"""Operator 13 against a tree built level by level in plain Python."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from prefspark.llm import merkle, queries
from prefspark.llm.oracle import SQL

LEAVES = "doc_id long, source string, leaf string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves):
    """Root, and for each leaf its (place, other digests) by level."""
    steps = [[] for _ in leaves]
    nodes = [(d, [i]) for i, d in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for place, (_, under) in enumerate(run):
                for leaf in under:
                    steps[leaf].append((place, [d for i, (d, _) in enumerate(run) if i != place]))
            above.append((h("".join(d for d, _ in run)), [leaf for _, under in run for leaf in under]))
        nodes = above
    return nodes[0][0], steps


def plain_manifest(rows):
    """(doc_id, source, leaf, subroot, root, proof_sha256) of rows (doc_id, source, leaf)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        leaves = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees.append((leaves, *plain_tree([r[2] for r in leaves])))
    root, tops = plain_tree([t[1] for t in trees])
    return [
        (*row, subroot, root, h("".join("".join(others) for _, others in steps + top)))
        for (leaves, subroot, all_steps), top in zip(trees, tops, strict=True)
        for row, steps in zip(leaves, all_steps, strict=True)
    ]


@pytest.mark.parametrize("n", [*range(1, 32), 80, 81, 82, 243, 244, 728, 729])
def test_appended_witnesses(n):
    leaves = [h(str(i)) for i in range(n)]
    tree = merkle.Tree()
    for leaf in leaves:
        tree.append(bytes.fromhex(leaf))
    root, steps = plain_tree(leaves)
    assert tree.close().hex() == root
    for i in range(n):
        folded, siblings = merkle.fold(bytes.fromhex(leaves[i]), bytes(tree.witness[i]))
        assert folded.hex() == root and siblings.decode() == "".join("".join(o) for _, o in steps[i])


def test_partial_witnesses_are_extended_when_siblings_complete():
    tree = merkle.Tree()
    sizes = []
    for i in range(9):
        tree.append(bytes.fromhex(h(str(i))))
        sizes.append(len(tree.witness[0]))
    step = 2 + 2 * merkle.DIGEST
    assert sizes == [0, 0, *[step] * 6, 2 * step]


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_of_sources(spark, height):
    rng = random.Random(height)
    rows = [(i, rng.choice(["a", "b", "a", "a", None, "é", "Z", ""]), h(str(i))) for i in range(0, 300, 2)]
    rows += [(1000, "lone", h("x")), (None, "a", h("n")), (None, None, h("n")), (4, "a", h("dup")), (4, "a", h("dup"))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, LEAVES)
    done = merkle.checked(merkle.manifest(df, height=height), "leaf").collect()
    got = [(r.doc_id, r.source, r.leaf, r.subroot, r.root, r.proof_sha256) for r in done]
    assert sorted(map(str, got)) == sorted(map(str, plain_manifest(rows)))
    assert all(r.verified and r.folded_root == r.root for r in done)


def test_lone_row_and_no_rows(spark):
    one = merkle.checked(merkle.manifest(spark.createDataFrame([(1, None, h("1"))], LEAVES)), "leaf").collect()[0]
    assert (one.subroot, one.root, one.folded_root, one.proof_sha256, one.verified) == (h("1"), h("1"), h("1"), h(""), True)
    assert merkle.checked(merkle.manifest(spark.createDataFrame([], LEAVES)), "leaf").collect() == []


def test_changed_leaves_do_not_verify_and_clashing_columns_stay(spark):
    df = spark.createDataFrame([(i, "s", h(str(i)), h("other") if i % 2 else h(str(i)), i, "g") for i in range(20)],
                               LEAVES + ", changed string, _place int, _group string")
    done = merkle.checked(merkle.manifest(df), "changed").collect()
    assert {(r.doc_id % 2 == 0) == r.verified for r in done} == {True}
    assert all(r._place == r.doc_id and r._group == "g" for r in done)


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def test_query_on_odd_documents(spark, make_docs, tmp_path):
    rows = [(1, "a\nb"), (2, "no feed"), (3, None), (4, ""), (5, "x\n" * 100_000), (6, "é\n", None, None), (7, "t\n", "de", None), (7, "t\n", "de", None), (None, "n\n")]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    full = [(*r, *("en", "s")[len(r) - 2 :]) if len(r) == 2 else r for r in rows]
    fields = lambda i, t, la, s: "".join(map(field, (i, s, la, None if t is None else len(t))))
    leaves = [(i, s, h(fields(i, t, la, s) + field(t))) for i, t, la, s in full]
    expect = sorted(map(str, ((r[0], r[2], *r[3:]) for r in plain_manifest(leaves))))
    done = queries.op13_merkle(spark, str(tmp_path)).collect()
    assert sorted(map(str, ((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in done))) == expect
    for r in done:
        text = next(t for i, t, *_ in full if i == r.doc_id)
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and text is not None and "\n" in text
        assert r.verified == (not hit) == (r.folded_root == r.root)


def test_query_matches_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    cols = "doc_id, leaf, subroot, root, proof_sha256, folded_root, verified"
    got = sorted(map(str, ([r[c] for c in cols.split(", ")] for r in queries.op13_merkle(spark, folder).collect())))
    assert got == sorted(str(list(r)) for r in con.execute(f"SELECT {cols} FROM ({SQL['op13_merkle']})").fetchall())
    assert queries.op13_merkle(spark, folder).where(F.col("verified")).count() < len(got)
