"""Operator 12: the rank index against counting, the transformation against slicing Python strings."""

import hashlib
import time

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prefspark.llm import fim, queries
from prefspark.llm.oracle import SQL


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \né漢😀", max_size=400))
def test_index_gives_every_boundary(text):
    index = fim.fit(text.encode())
    assert index.length == len(text)
    assert [index.offset(i) for i in range(len(text) + 1)] == [len(text[:i].encode()) for i in range(len(text) + 1)]


def test_lines_stay_within_the_error_and_are_few():
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcdefgh é漢"), 200_000))
    index = fim.fit(text.encode())
    assert np.abs(index.residuals.astype(int)).max() <= fim.EPSILON + 1
    assert len(index.starts) < 400
    for i in rng.integers(0, len(text), 50).tolist():
        assert index.offset(i) == len(text[:i].encode())


def test_long_texts_are_linear():
    text = ("word é漢 " * 500_000).encode()
    begin = time.perf_counter()
    index = fim.fit(text)
    assert index.length == 4_000_000 and index.offset(3_999_999) == len(text) - 1
    assert time.perf_counter() - begin < 10


def plain(doc_id, text, rate=90, spm_rate=20):
    text = text or ""
    n = len(text)
    hexed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_rate:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_outputs_and_restored_texts(spark, make_docs):
    rng = np.random.default_rng(2)
    rows = [(i, "".join(rng.choice(list("ab <PSM>é漢😀\n"), rng.integers(0, 80)))) for i in range(300)]
    rows += [(None, "no id"), (None, "no id"), (400, None), (401, ""), (402, "has <M> mark"), (403, "<"), (403, "other text of the id"), (404, "x" * 300_000)]
    docs = make_docs(rows).withColumn("form", F.lit("clash")).withColumn("_h", F.lit(1))
    made = fim.transform(docs).withColumn("back", fim.restored())
    assert set(docs.columns) < set(made.columns) and "_fim0" not in made.columns
    got = sorted((str(r.doc_id), r.text or "", r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made.collect())
    assert got == sorted((str(i), t or "", *plain(i, t), t or "") for i, t in rows)
    assert {r[3] for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(make_docs([])).collect() == []


def test_rates(spark, make_docs):
    docs = make_docs([(i, "some text") for i in range(2000)])
    forms = {r.form: r["count"] for r in fim.transform(docs).groupBy("form").count().collect()}
    assert 150 < forms["plain"] < 250 and 0.15 < forms["spm"] / (2000 - forms["plain"]) < 0.25
    assert {r.form for r in fim.transform(docs, rate=0).collect()} == {"plain"}


def test_query_matches_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    cols = "doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256"
    got = sorted(map(str, ([r[c] for c in cols.split(", ")] for r in queries.op12_fim(spark, folder).collect())))
    assert got == sorted(str(list(r)) for r in con.execute(f"SELECT {cols} FROM ({SQL['op12_fim']})").fetchall())
