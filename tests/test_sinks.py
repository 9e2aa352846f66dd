"""Ordered text parts, line numbers, and batch files that keep their layout."""

import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from prefspark import convert_trees
from prefspark.operators import batching
from prefspark.sources import io


def lines_of(path):
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(os.path.join(path, name), encoding="utf-8") as f:
                out += [json.loads(line)["text"] for line in f]
    return out


@pytest.mark.parametrize("n, parts", [(0, 3), (1, 4), (10, 4), (1000, 7)])
def test_parts_are_in_order(spark, tmp, n, parts):
    df = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("é line\n"), F.col("id")).alias("text")).repartition(5)
    path = os.path.join(tmp, "out")
    assert io.write_texts_ordered(df, path, "k", parts=parts) == n
    assert lines_of(path) == [f"é line\n{i}" for i in range(n)]
    m = io.read_manifest(spark, path)
    assert m["rows"] == n == sum(p["rows"] for p in m["parts"]) and [p["first"] for p in m["parts"]] == sorted(p["first"] for p in m["parts"])
    assert all(p["rows"] == sum(1 for _ in open(os.path.join(path, p["file"]), encoding="utf-8")) for p in m["parts"])
    if n:
        assert io.read_texts(spark, path).count() == n


def test_converted_trees_stay_in_input_order(spark, tmp):
    src = os.path.join(tmp, "t.jsonl")
    with open(src, "w") as f:
        f.writelines(json.dumps({"prompt": {"role": "prompter", "text": f"tree {i}"}}) + "\n" for i in range(300))
    out = os.path.join(tmp, "chatml")
    assert convert_trees.run(spark, src, out, system="") == 300
    assert lines_of(out) == [f"<|im_start|>user\ntree {i}<|im_end|>\n" for i in range(300)]


@pytest.mark.parametrize("split", ["64", "1k", "128m"])
def test_line_numbers_do_not_depend_on_splits(spark, tmp, split):
    for name, n in (("a.jsonl", 200), ("b.jsonl", 1), ("c.jsonl", 57)):
        with open(os.path.join(tmp, name), "w") as f:
            f.writelines(json.dumps({"text": f"{name} {i} " + "x" * (i % 90)}) + "\n" for i in range(n))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = io.line_numbers(spark.read.schema("text string").json(tmp)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 258
    assert all(r["text"].split()[:2] == [r["file"].rsplit("/", 1)[-1], str(r["line"])] for r in rows)


def test_json_keys_are_stable(spark, tmp):
    for s, n in (("train", 40), ("test", 9)):
        os.makedirs(f"{tmp}/p/split={s}")
        with open(f"{tmp}/p/split={s}/part-0.json", "w") as f:
            f.writelines(json.dumps({"prompt": f"{s} {i}"}) + "\n" for i in range(n))
    keys = {r["prompt"]: r["prompt_id"] for r in io.read_prompts(spark, f"{tmp}/p", fmt="json").collect()}
    assert keys == {f"{s} {i}": f"split={s}/part-0.json:{i}" for s, n in (("train", 40), ("test", 9)) for i in range(n)}
    assert io.read_prompts(spark, f"{tmp}/p", fmt="json").columns == ["prompt_id", "prompt", "split"]


def test_batch_files_need_no_exchange(spark, tmp):
    df = spark.range(0, 500).select(F.col("id").alias("k"), F.sequence(F.lit(1), (F.col("id") % 9 + 1).cast("int")).alias("input_ids"))
    batched = batching.with_batches(df, df, 4, "k")
    a, b = os.path.join(tmp, "a"), os.path.join(tmp, "b")
    io.write_batches(batched, a, buckets=6)
    io.write_batches(batched.select("batch_id", "k", (F.col("k") * 2).alias("score")), b, buckets=6)
    spark.sql(f"DROP TABLE {io._table_name(a)}")  # another session knows the folder only
    back = io.read_batches(spark, a)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        padded = batching.pad_batch(back)
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        joined = back.join(io.read_batches(spark, b), ["batch_id", "k"])
        sizes = back.groupBy("batch_id").agg(F.count("*"))
        ranked = back.withColumn("r", F.row_number().over(Window.partitionBy("batch_id").orderBy("k")))
        for plan in (padded, joined, sizes, ranked):
            assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, padded.collect())) == sorted(map(str, batching.pad_batch(batched).select(*padded.columns).collect()))
        assert joined.where("score = 2 * k").count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    m = io.read_manifest(spark, a)
    assert m["rows"] == 500 and len(m["files"]) == 6 == m["buckets"] and m["by"] == "batch_id"


def test_batches_are_overwritten(spark, tmp):
    path = os.path.join(tmp, "x")
    for n in (30, 20):
        io.write_batches(spark.range(n).select((F.col("id") % 5).alias("batch_id"), "id"), path, buckets=3)
        assert io.read_batches(spark, path).count() == n == io.read_manifest(spark, path)["rows"]


def test_trees_from_lines(spark):
    lines = spark.createDataFrame([(1, ' \t{"prompt": {"role": "prompter", "text": "a"}} \r'), (2, ""), (3, " \x0b ")], "n long, value string")
    got = io.trees_from_lines(lines).select("n", F.variant_get("tree", "$.prompt.text", "string").alias("t")).collect()
    assert [(r["n"], r["t"]) for r in got] == [(1, "a")]
    with pytest.raises(Exception):
        io.trees_from_lines(spark.createDataFrame([("{broken",)], "value string")).collect()
