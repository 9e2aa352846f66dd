"""Scans and sinks (IO1-IO8): JSONL trees as VARIANT, text / pair / prompt datasets, JSONL and parquet sinks."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefspark.functions.exprs import strip_line
from prefspark.operators.indexing import global_index
from prefspark.session import materialize

# Fixed schemas of the input shapes.
TEXT_SCHEMA = "text STRING"
FLAT_PAIR_SCHEMA = "chosen STRING, rejected STRING"
MESSAGE_PAIR_SCHEMA = ("prompt STRING, chosen ARRAY<STRUCT<content: STRING, role: STRING>>, "
                       "rejected ARRAY<STRUCT<content: STRING, role: STRING>>")
PROMPT_SCHEMA = "prompt STRING"


def read_trees(spark: SparkSession, path: str, key: str | None = None, tree_col: str = "tree",
               id_col: str = "tree_id", partitions: int | None = None) -> DataFrame:
    """IO1 + IO2: one recursive tree per JSONL line as a single VARIANT column.

    FAILFAST turns a malformed line into an error instead of a NULL row. ``key`` names a
    top-level field that identifies the tree; otherwise ``monotonically_increasing_id``
    numbers the lines right after the scan (a content hash would merge duplicate trees,
    which the reference keeps); the numbers hold for as long as the files do.
    Gzip input (a file, or any file of a folder or glob) is not splittable, so it is spread over ``partitions`` (default: the
    cluster's parallelism) right after the scan.
    """
    df = (
        spark.read.option("singleVariantColumn", tree_col)
        .option("mode", "FAILFAST")
        .json(path)
    )
    if key is not None:
        df = df.withColumn(id_col, F.variant_get(F.col(tree_col), f"$.{key}", "string"))
    else:
        df = df.withColumn(id_col, F.monotonically_increasing_id())
    if partitions is not None or any(f.endswith(".gz") for f in df.inputFiles()):
        df = df.repartition(partitions or spark.sparkContext.defaultParallelism)
    return df


def trees_from_lines(lines: DataFrame, col: str = "value", tree_col: str = "tree") -> DataFrame:
    """IO2 on lines that are already rows of text (a text scan, a stream): each line stripped (SF1) and parsed to VARIANT.

    Blank lines are left out (S17); a malformed line raises. All other columns stay.
    """
    stripped = lines.withColumn(tree_col, strip_line(col)).where(F.col(tree_col) != "")
    kept = [c for c in lines.columns if c not in (col, tree_col)]
    return stripped.select(*kept, F.parse_json(tree_col).alias(tree_col))


def read_texts(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """IO3: JSONL ``{text}`` records into a named split."""
    return (
        spark.read.schema(TEXT_SCHEMA).option("mode", "FAILFAST").json(path)
        .withColumn("split", F.lit(split))
    )


def _read_split_root(spark: SparkSession, root: str, schema: str, fmt: str) -> DataFrame:
    reader = spark.read.schema(f"{schema}, split STRING")
    if fmt == "json":
        return reader.option("mode", "FAILFAST").json(root)
    if fmt == "parquet":
        return reader.parquet(root)
    raise ValueError(f"unknown format {fmt!r}")


#: A table of input splits is broadcast up to so many of them.
BROADCAST_SPLITS = 1_000_000


def line_numbers(lines: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """Rows of a scan of text or JSON files with the file's path and the row's number in it, from 0.

    The numbers do not depend on how the files are cut into splits: a first pass counts the rows of each split, a second
    adds what comes before. Only a row per split is moved.
    """
    placed = lines.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias("_start"),
                          F.monotonically_increasing_id().alias("_id"))
    splits = placed.groupBy(F.col(file).alias("_file"), F.col("_start").alias("_at")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(splits.select("_file", "_at", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    if before.count() <= BROADCAST_SPLITS:
        before = F.broadcast(before)
    met = placed.join(before, (F.col(file) == F.col("_file")) & (F.col("_start") == F.col("_at")))
    return met.withColumn(line, F.col("_before") + F.col("_id") - F.col("_first")).drop("_start", "_id", "_file", "_at", "_first", "_before")


def _keyed(df: DataFrame, key: str, fmt: str) -> DataFrame:
    """A string key for each row, file and row number: the same however the files are split. Parquet has row
    numbers (so split filters still reach the scan); lines of JSON are counted (``line_numbers``)."""
    if fmt == "parquet":
        file = F.regexp_extract("_metadata.file_path", "[^/]*/[^/]*$", 0)
        return df.select(F.concat_ws(":", file, F.col("_metadata.row_index").cast("string")).alias(key), "*")
    numbered = line_numbers(df, "_path", "_line")
    file = F.regexp_extract("_path", "[^/]*/[^/]*$", 0)
    return numbered.select(F.concat_ws(":", file, F.col("_line").cast("string")).alias(key), *df.columns)


def read_pairs(spark: SparkSession, root: str, kind: str = "flat", fmt: str = "parquet", key: str = "pair_id") -> DataFrame:
    """IO4: a multi-split pair dataset laid out as ``root/split=<name>/``, each row with a ``key`` of its own.

    ``kind='flat'`` is D5 (chosen / rejected strings), ``'messages'`` is D6. The split is a
    partition column, so ``select_split`` prunes whole directories.
    """
    schema = FLAT_PAIR_SCHEMA if kind == "flat" else MESSAGE_PAIR_SCHEMA
    return _keyed(_read_split_root(spark, root, schema, fmt), key, fmt)


def read_prompts(spark: SparkSession, root: str, fmt: str = "parquet", key: str = "prompt_id") -> DataFrame:
    """IO5: a prompt dataset (D7) laid out like ``read_pairs``."""
    return _keyed(_read_split_root(spark, root, PROMPT_SCHEMA, fmt), key, fmt)


def select_split(df: DataFrame, split: str) -> DataFrame:
    """IO6: ``ds[split]`` -- a partition filter Catalyst pushes into the scan."""
    return df.where(F.col("split") == F.lit(split))


def write_texts(df: DataFrame, path: str, text_col: str = "text") -> None:
    """IO7: JSONL ``{"text": ...}`` with non-ASCII kept as is; overwrites; a folder of part files."""
    df.select(F.col(text_col).alias("text")).write.mode("overwrite").json(path)


def write_shaped(df: DataFrame, path: str, split_col: str | None = "split") -> None:
    """IO8: persist a shaped (tokenized) dataset as parquet, partitioned by split when present."""
    w = df.write.mode("overwrite")
    if split_col and split_col in df.columns:
        w = w.partitionBy(split_col)
    w.parquet(path)


# ---------------------------------------------------------------- sinks in order


def write_texts_ordered(df: DataFrame, path: str, order: str, text_col: str = "text", parts: int | None = None) -> int:
    """IO7 in input order: JSONL part files that hold the texts in ascending ``order``, put one after the other by name.

    Rows are numbered (``global_index``), dealt to parts by ranges of these numbers and sorted inside them, so no task
    holds more than its range. Overwrites; returns the number of lines. ``read_manifest`` tells each part's first line.
    """
    spark = df.sparkSession
    numbered = global_index(df.select(F.col(order).alias("_o"), F.col(text_col).alias("text")), ["_o"], "_i")
    n = numbered.count()
    parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # ranges of nearly equal length, by number: nothing is sampled, and the rows of a part are known without reading it
    part = F.expr(f"CAST((_i * {parts}) DIV {max(1, n)} AS INT)")
    numbered.repartitionById(parts, part).sortWithinPartitions("_i").select("text").write.mode("overwrite").json(path)
    starts = sorted({-(-p * n // parts) for p in range(parts)} - {n}) if n else []
    files = sorted(f.rsplit("/", 1)[-1] for f in spark.read.text(path).inputFiles()) if n else []
    if len(files) != len(starts):
        raise RuntimeError(f"{len(files)} part files for {len(starts)} ranges")
    ends = [*starts[1:], n]
    entries = [{"file": f, "first": a, "rows": b - a} for f, a, b in zip(files, starts, ends, strict=False)]
    _write_manifest(spark, path, {"rows": n, "parts": entries})
    return n


def _write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    """One line of JSON in ``path/_manifest``, which scans of ``path`` leave out."""
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_manifest")


def read_manifest(spark: SparkSession, path: str) -> dict:
    """What the ordered sinks wrote about their files."""
    return json.loads(spark.read.text(f"{path}/_manifest").first()["value"])


def write_batches(df: DataFrame, path: str, batch_col: str = "batch_id", buckets: int | None = None) -> None:
    """IO8 for training (D10): batches hashed into bucket files, each sorted by batch; one file a bucket. Overwrites.

    ``read_batches`` gives the rows back with that layout, so steps that group or join by batch need no exchange.
    """
    spark = df.sparkSession
    buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, batch_col).write.mode("overwrite").bucketBy(buckets, batch_col).sortBy(batch_col)
     .option("path", path).saveAsTable(name))
    files = spark.table(name).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(batch_col).alias("low"), F.max(batch_col).alias("high"), F.count(F.lit(1)).alias("rows"))
    entries = [r.asDict() for r in files.orderBy("file").collect()]  # a row a bucket
    columns = [[f.name, f.dataType.simpleString()] for f in df.schema]
    _write_manifest(spark, path, {"buckets": buckets, "by": batch_col, "columns": columns, "files": entries,
                                  "rows": sum(e["rows"] for e in entries)})


def _table_name(path: str) -> str:
    return "batches_" + hashlib.sha256(path.encode()).hexdigest()[:32]


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Batches that ``write_batches`` wrote, in any session: the layout comes from the manifest.

    Windows and groups by batch need no exchange, nor do joins by batch of tables with equally many buckets; for joins by
    batch and more columns, set ``spark.sql.requireAllClusterKeysForCoPartition`` to false.
    """
    m, name = read_manifest(spark, path), _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{c}` {kind}" for c, kind in m["columns"])
        quoted = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{m['by']}`) SORTED BY (`{m['by']}`) "
                  f"INTO {m['buckets']} BUCKETS LOCATION '{quoted}'")
    return spark.table(name)
