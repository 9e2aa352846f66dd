"""Discounted suffix sums of sequences that are longer than a task should hold (RO3, RO4).

``y_t = x_t + g * y_{t+1}`` is a composition of affine maps, so a sequence is cut into pieces of positions: a piece's own
sums are a window over the piece, and all that a piece needs from the rest is the sum at the start of the next one. These
sums are the same kind of scan over one number a piece, with ``g ** piece`` for ``g``; it is folded in
groups of ``FOLD`` pieces, whose heads are scanned in turn until one group is left. No step sorts, gathers or
joins more than a piece, or ``FOLD`` numbers, in one place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.operators.logsumexp import let
from prefspark.session import materialize

PIECE = 1 << 16
FOLD = 1 << 10


def piece_size(factor: float, piece: int = PIECE) -> int:
    """``piece``, or fewer positions so that ``factor ** piece`` stays a normal double (between 1e-300 and 1e300)."""
    if factor <= 0:
        raise ValueError("a discount is positive")
    if factor == 1.0:
        return piece
    return max(1, min(piece, int(300 * math.log(10) / abs(math.log(factor)))))


def _piece(pos: str, size: int) -> Column:
    return F.floor(F.col(pos) / size).cast("bigint")


def next_value(df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str, piece: int = PIECE) -> DataFrame:
    """WN1: ``value`` at the next position of the sequence (0.0 after its last), a piece at a time. Positions have no gaps."""
    own = _piece(pos, piece)
    # a piece's first row also lies at the end of the piece before it, so each row is worked out and moved once
    both = F.when((F.col(pos) > 0) & (F.col(pos) % piece == 0), F.array(own, own - 1)).otherwise(F.array(own))
    staged = df.withColumn("_piece", F.explode(both)).withColumn("_after", F.coalesce(F.col("_piece") != own, F.lit(False)))
    group = Window.partitionBy(*keys, "_piece")
    after = F.collect_list(F.when(F.col("_after"), F.struct(F.col(value).alias("first")))).over(group)
    met = staged.withColumn("_firsts", after).where(~F.col("_after")).withColumn("_first", F.explode_outer("_firsts"))
    inside = F.lead(value).over(group.orderBy(pos))
    return met.withColumn(out, F.coalesce(inside, F.col("_first.first"), F.lit(0.0))).drop("_piece", "_after", "_firsts", "_first")


def _scanned(heads: DataFrame, keys: list[str], factor: float, last: int) -> DataFrame:
    """``(keys, at, y)`` of ``heads`` (keys, at, x): the sum at each ``at`` over the places from it on, ``factor ** distance`` apart."""
    fold = F.struct(F.lit(None).cast("bigint").alias("at"), F.lit(0.0).alias("y"))
    steps = lambda n: F.pow(F.lit(factor), n.cast("double"))

    def push(done: Column, x: Column) -> Column:
        # done: the places after x, nearest first
        behind = F.get(done, F.lit(0))
        y = x["x"] + F.when(behind["at"].isNull(), F.lit(0.0)).otherwise(steps(behind["at"] - x["at"]) * behind["y"])
        return F.concat(F.array(F.struct(x["at"].alias("at"), y.alias("y"))), done)

    grouped = heads.groupBy(*keys, F.floor(F.col("at") / FOLD).cast("bigint").alias("_g")).agg(
        F.reverse(F.sort_array(F.collect_list(F.struct("at", "x")))).alias("_xs"))
    empty = F.array(fold).cast("array<struct<at: bigint, y: double>>")
    # the last entry is the empty fold; what stands before it are the group's places in order
    own = grouped.select(*keys, "_g", let(
        F.aggregate("_xs", empty, push), lambda ys: F.slice(ys, 1, F.size(ys) - 1)).alias("_ys"))
    if last < FOLD:
        return own.select(*keys, F.inline("_ys"))
    start = F.col("_g") * FOLD
    group_heads = own.select(*keys, F.col("_g").alias("at"), (steps(F.col("_ys")[0]["at"] - start) * F.col("_ys")[0]["y"]).alias("x"))
    behind = _scanned(group_heads, keys, factor**FOLD, last // FOLD).withColumnRenamed("y", "_behind")
    carry = _behind(behind, keys)
    met = own.join(carry, _same(keys, "_g"), "left").drop(*_names(keys))
    place = met.select(*keys, "_g", "_behind", F.inline("_ys"))
    rest = steps((F.col("_g") + 1) * FOLD - F.col("at")) * F.coalesce("_behind", F.lit(0.0))
    return place.select(*keys, "at", (F.col("y") + rest).alias("y"))


def _names(keys: Sequence[str]) -> list[str]:
    return [f"_c{i}" for i in range(len(keys))] + ["_cat"]


def _behind(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sum at each place as ``_behind`` of the place before it."""
    return sums.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)], (F.col("at") - 1).alias("_cat"), "_behind")


def _same(keys: Sequence[str], place: str) -> Column:
    same = F.col(place) == F.col("_cat")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_c{i}"))
    return same


def discounted_sums(df: DataFrame, keys: Sequence[str], pos: str, value: str, factor: float, out: str, piece: int = PIECE) -> DataFrame:
    """``df`` with ``out = sum over s >= t of factor ** (s - t) * value_s`` in each sequence of ``keys``, positions 0 .. n - 1 without gaps.

    A gap as long as a piece raises. Equal positions of one sequence are summed in any order.
    """
    keys, size = list(keys), piece_size(factor, piece)
    staged = df.withColumn("_piece", _piece(pos, size)).withColumn("_off", F.col(pos) - F.col("_piece") * size)
    weight = F.pow(F.lit(factor), F.col("_off"))
    staged = staged.withColumn("_u", F.col(value) * weight)
    later = Window.partitionBy(*keys, "_piece").orderBy(F.col(pos).desc()).rowsBetween(Window.unboundedPreceding, -1)
    local = staged.withColumn("_local", F.col(value) + F.coalesce(F.sum("_u").over(later), F.lit(0.0)) / weight)
    # a number a piece, kept: checked below and scanned, without working out ``df`` for each
    heads = materialize(staged.groupBy(*keys, F.col("_piece").alias("at")).agg(F.sum("_u").alias("x")))
    size_of = heads.groupBy(*keys).agg(F.max("at").alias("last"), F.count(F.lit(1)).alias("n")).agg(
        F.max("last").alias("last"), F.max((F.col("last") + 1 != F.col("n")).cast("int")).alias("gap")).first()
    if size_of["gap"]:
        raise ValueError("a sequence has a gap in its positions")
    sums = _scanned(heads, keys, factor**size, int(size_of["last"] or 0)).withColumnRenamed("y", "_behind")
    met = local.join(_behind(sums, keys), _same(keys, "_piece"), "left")
    total = F.col("_local") + F.pow(F.lit(factor), F.lit(size) - F.col("_off")) * F.coalesce("_behind", F.lit(0.0))
    return met.withColumn(out, total).drop("_piece", "_off", "_u", "_local", "_behind", *_names(keys))
