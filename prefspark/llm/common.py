"""Helpers shared by the operators: reading tables, mapping Arrow batches, writing shared intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prefspark.session import ensure_checkpoint_dir

#: Words everywhere are maximal runs of other characters than these six (Java regex class).
WORD = "[^\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialized(df: DataFrame, *partition_hint: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it back.

    Cuts lineage like ``checkpoint()`` but keeps the rows compressed and columnar, so a
    later read prunes columns. The folder is shared, so the rows survive lost executors.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scanned(df: DataFrame) -> DataFrame:
    """``df`` if it is a plain scan of files, else a written copy of it: rows that ``row_number_of`` can tell apart."""
    plain = df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"
    return df if plain and "_metadata" not in df.columns else materialized(df)


def row_number_of(scan: DataFrame) -> Column:
    """A struct (file, place in the file) that names each row of a scan, also where it is read again."""
    meta = scan.metadataColumn("_metadata")
    return F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("at"))


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    return df.mapInArrow(fn, schema)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def binary_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column without decoding; null counts as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [b"" if v is None else v for v in column.to_pylist()]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], least_rows: int = 200_000) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by integer ``keys``: many small groups come in one table.

    A table has about ``least_rows`` rows, or as many as its last group needs; callers bound their groups.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least_rows:
            continue
        table = pa.Table.from_batches(held)
        change = np.zeros(table.num_rows - 1, bool)
        for key in keys:
            column = table.column(key).to_numpy()
            change |= column[1:] != column[:-1]
        ends = np.flatnonzero(change)
        if len(ends):  # the last group may go on in the next batch
            cut = int(ends[-1]) + 1
            yield table.slice(0, cut)
            table = table.slice(cut)
        held, rows = table.to_batches(), table.num_rows
    if rows:
        yield pa.Table.from_batches(held)


def group_bounds(table: pa.Table, keys: Sequence[str]) -> list[tuple[int, int]]:
    """(start, end) of each run of equal ``keys`` in a sorted table."""
    change = np.zeros(table.num_rows - 1, bool)
    for key in keys:
        column = table.column(key).to_numpy()
        change |= column[1:] != column[:-1]
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
    return list(zip(cuts, cuts[1:], strict=False))


def clean_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each row's vector as float64; None if it is null, empty, zero or holds null or non-finite components."""
    out: list[np.ndarray | None] = []
    for value in column:
        if not value.is_valid or value.values.null_count or not len(value.values):
            out.append(None)
            continue
        v = value.values.to_numpy().astype(np.float64)
        out.append(v if np.isfinite(v).all() and v.any() else None)
    return out


def vector_matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` components as one matrix (float64); the column holds no nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
