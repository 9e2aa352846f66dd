"""Epochs, repeatable shuffles, contiguous batches and per-batch padding (BA1-BA3, TK5, TK6, PR7).

Batch numbers come from the global ordered index (``indexing.global_index``), so no
step puts all rows in one partition. Padding windows are partitioned by batch id,
and a batch holds ``batch_size`` rows by construction, so they stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.functions.exprs import md5_key
from prefspark.operators.indexing import global_index
from prefspark.operators.permute import permuted
from prefspark.operators.tokens import PAD_ID


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def shuffle_key(key, seed: int = 42, epoch=None) -> Column:
    """BA1: the sort key of a seeded, repeatable shuffle: ``md5(key:seed[:epoch])``.

    The reference shuffles without a seed (S14); a seed makes every run repeatable.
    """
    parts = [_c(key), F.lit(seed)] + ([_c(epoch) if not isinstance(epoch, int) else F.lit(epoch)]
                                      if epoch is not None else [])
    return md5_key(*parts)


def with_epochs(df: DataFrame, num_epochs: int, col: str = "epoch") -> DataFrame:
    """Repeat every row once per epoch (a generator, not a join)."""
    return df.withColumn(col, F.explode(F.sequence(F.lit(0), F.lit(num_epochs - 1))))


def assign_batches(df: DataFrame, batch_size: int, key: str, seed: int | None = 42, epoch_col: str | None = None,
                   idx_col: str = "idx", batch_col: str = "batch_id", step_col: str | None = "step") -> DataFrame:
    """BA2 (+ BA1): contiguous slices of ``batch_size`` rows in shuffled (or key) order; the last
    batch may be partial.

    With ``epoch_col`` (see ``with_epochs``) each epoch is ordered and sliced on its own,
    and ``step`` counts batches across epochs from 1, as the training loop's global step.
    """
    order: list[Column] = []
    if epoch_col:
        order.append(F.col(epoch_col))
    if seed is not None:
        order.append(shuffle_key(key, seed, F.col(epoch_col) if epoch_col else None))
    order.append(F.col(key))
    indexed = global_index(df, order, "_g")
    if epoch_col:
        # a row an epoch: its first index and how many batches the epochs before it have, however epochs are numbered
        per = indexed.groupBy(F.col(epoch_col).alias("_e")).agg(F.min("_g").alias("_first"), F.count(F.lit(1)).alias("_n"))
        table, before = [], 0
        for r in sorted(per.collect(), key=lambda r: r["_first"]):
            table.append((r["_e"], r["_first"], r["_n"], before))
            before += -(-r["_n"] // batch_size)
        kind = df.schema[epoch_col].dataType.simpleString()
        per = df.sparkSession.createDataFrame(table, f"_e {kind}, _first long, _n long, _before long")
        out = indexed.join(F.broadcast(per), F.col(epoch_col).eqNullSafe(F.col("_e")))
        out = out.withColumn(idx_col, F.col("_g") - F.col("_first"))
        out = out.withColumn(batch_col, F.floor(F.col(idx_col) / batch_size).cast("bigint"))
        if step_col:
            out = out.withColumn(step_col, (F.col("_before") + F.col(batch_col) + 1).cast("bigint"))
        out = out.drop("_e", "_first", "_n", "_before")
    else:
        out = indexed.withColumnRenamed("_g", idx_col).withColumn(
            batch_col, F.floor(F.col(idx_col) / batch_size).cast("bigint"))
        if step_col:
            out = out.withColumn(step_col, F.col(batch_col) + 1)
    return out.drop("_g")


def epoch_batches(df: DataFrame, batch_size: int, key: str, num_epochs: int, seed: int = 42) -> DataFrame:
    """BA1 + BA2 without a sort per epoch: ``(key, epoch, idx, batch_id, step)`` for every row of ``df`` in every epoch.

    Rows are numbered once, in key order (the only exchange); each epoch's order is a seeded permutation of these numbers
    (``permute.permuted``), which a row computes for itself. Batches and steps are as ``assign_batches`` gives them.
    """
    indexed = global_index(df.select(key), [F.col(key)], "_i")
    n = indexed.count()
    batches = -(-n // batch_size)
    rows = with_epochs(indexed, num_epochs).withColumn("epoch", F.col("epoch").cast("bigint"))
    placed = rows.withColumn("idx", permuted("_i", n, seed, "epoch"))
    batch = F.floor(F.col("idx") / batch_size).cast("bigint")
    return placed.select(key, "epoch", "idx", batch.alias("batch_id"), (F.col("epoch") * batches + batch + 1).alias("step"))


def with_batches(rows: DataFrame, keys: DataFrame, batch_size: int, key: str, seed: int | None = 42) -> DataFrame:
    """BA2 for wide rows: only ``keys`` (every key of ``rows`` once) is sorted and numbered; rows meet their batch by key."""
    numbered = assign_batches(keys.select(key), batch_size, key, seed=seed, step_col=None)
    numbered = numbered.select(F.col(key).alias("_k"), "idx", "batch_id")
    return rows.join(numbered, F.col(key).eqNullSafe(F.col("_k"))).drop("_k")


def plan_steps(df: DataFrame, batch_size: int, num_epochs: int) -> DataFrame:
    """BA3: one row ``(n_rows, batch_size, num_epochs, steps)`` with ``steps = ceil(n / b) * epochs``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(batch_size).cast("bigint").alias("batch_size"),
        F.lit(num_epochs).cast("bigint").alias("num_epochs"),
        (F.ceil(F.col("n_rows") / F.lit(batch_size)) * F.lit(num_epochs)).cast("bigint").alias("steps"),
    )


def _pad(ids: Column, length: Column, pad_id: int, side: str) -> Column:
    pads = F.array_repeat(F.lit(pad_id), length - F.size(ids))
    return F.concat(ids, pads) if side == "right" else F.concat(pads, ids)


def _mask(ids: Column, length: Column, side: str) -> Column:
    ones = F.array_repeat(F.lit(1), F.size(ids))
    zeros = F.array_repeat(F.lit(0), length - F.size(ids))
    return F.concat(ones, zeros) if side == "right" else F.concat(zeros, ones)


def pad_batch(df: DataFrame, ids_col: str = "input_ids", batch_col: str = "batch_id", pad_id: int = PAD_ID,
              side: str = "right", mask_col: str = "attention_mask") -> DataFrame:
    """TK5 + TK4: pad every row to the longest row of its batch; mask 1 = token, 0 = pad."""
    m = F.max(F.size(ids_col)).over(Window.partitionBy(batch_col))
    return (
        df.withColumn("_len", m)
        .withColumn(mask_col, _mask(F.col(ids_col), F.col("_len"), side))
        .withColumn(ids_col, _pad(F.col(ids_col), F.col("_len"), pad_id, side))
        .drop("_len")
    )


def pad_pairs(df: DataFrame, batch_col: str = "batch_id", pad_id: int = PAD_ID,
              chosen: str = "input_ids_chosen", rejected: str = "input_ids_rejected") -> DataFrame:
    """TK6: pad chosen and rejected to one shared per-batch maximum (the paired collator)."""
    m = F.max(F.greatest(F.size(chosen), F.size(rejected))).over(Window.partitionBy(batch_col))
    out = df.withColumn("_len", m)
    for side_col, mask in ((chosen, "attention_mask_chosen"), (rejected, "attention_mask_rejected")):
        out = out.withColumn(mask, _mask(F.col(side_col), F.col("_len"), "right")).withColumn(
            side_col, _pad(F.col(side_col), F.col("_len"), pad_id, "right"))
    return out.drop("_len")


def log_steps(df: DataFrame, every: int, step_col: str = "step") -> DataFrame:
    """PR7: keep the rows of every ``every``-th step (the training log cadence)."""
    return df.where(F.col(step_col) % F.lit(every) == 0)


def logged(step, every: int) -> Column:
    """PR7 as a flag column, for reports that keep all steps."""
    return (_c(step) % F.lit(every) == 0)


__all__ = ["assign_batches", "epoch_batches", "log_steps", "logged", "pad_batch", "pad_pairs", "plan_steps",
           "shuffle_key", "with_batches", "with_epochs"]
