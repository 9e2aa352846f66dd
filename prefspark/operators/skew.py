"""Lookup joins in which a key may hold any share of the rows.

Keys with more than ``limit`` rows are found by counting, which combines before the shuffle. There are at
most ``rows / limit`` of them, a thousand for a hundred million rows, so they can be broadcast. Their rows are dealt into
pieces of about ``limit`` rows by a hash of the row, and the looked-up rows of these keys are repeated once per
piece. All other keys have one piece. The join is exact for every key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 100_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hot_keys(rows: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS) -> DataFrame:
    """``(_h0, _h1, .., _pieces)`` of the keys with more than ``limit`` rows; a key with a NULL matches nothing and is none."""
    return _hot_of(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, "_n", limit)


def _hot_of(counts: DataFrame, keys: Sequence[str], counted: str, limit: int) -> DataFrame:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return counts.where((F.col(counted) > limit) & known).select(
        *[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], F.ceil(F.col(counted) / limit).cast("int").alias("_pieces"))


def lookup(rows: DataFrame, table: DataFrame, on: Sequence[tuple[str, str]], deal: Sequence[str], how: str = "left",
           limit: int = HOT_ROWS, counted: str | None = None) -> DataFrame:
    """``rows`` joined with ``table`` on pairs of (column of rows, column of table), whose names all differ.

    ``deal`` names columns of ``rows`` that tell the rows of one key apart: their hash picks a hot row's piece. Rows whose key has
    a NULL match nothing; they are dealt by the same hash, so they do not meet in one task either. If ``table`` comes from
    grouping ``rows`` by the keys, ``counted`` names its column of how many rows each key has, and ``rows`` are not counted again.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join {how!r}")
    mine, theirs = [a for a, _ in on], [b for _, b in on]
    if counted is None:
        hot = hot_keys(rows, mine, limit)
    else:
        hot, table = _hot_of(table, theirs, counted, limit), table.drop(counted)

    def pieces(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & (F.col(k) == F.col(f"_h{i}"))
        return df.join(F.broadcast(hot), same, "left").drop(*[f"_h{i}" for i in range(len(keys))])

    draw = F.xxhash64(*deal)
    empty = F.lit(False)
    for k in mine:
        empty = empty | F.col(k).isNull()
    dealt = pieces(rows, mine).withColumn(
        "_piece", F.when(empty, draw).otherwise(F.pmod(draw, F.coalesce("_pieces", F.lit(1)).cast("bigint"))))
    repeated = pieces(table, theirs).withColumn("_spare", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_pieces", F.lit(1)).cast("bigint") - 1)))
    same = F.col("_piece") == F.col("_spare")
    for a, b in on:
        same = same & (F.col(a) == F.col(b))
    return dealt.drop("_pieces").join(repeated.drop("_pieces"), same, how).drop("_piece", "_spare")


def frequent(rows: DataFrame, column: str, most: int) -> DataFrame:
    """``(column)``: up to ``most`` frequent values of a column, from one mergeable sketch of all its rows.

    The sketch (frequent items) keeps counters for ``16 * most`` values, 1,024 to 1,000,000, and is merged like any
    aggregate, so its size does not depend on the data. A counter is wrong by at most 3.5 rows in each ``counters``
    rows: a value that holds a larger share cannot be missed among the ``most`` largest. NULL is left out.
    """
    counters = max(1024, min(1_000_000, 16 * most))
    top = rows.where(F.col(column).isNotNull()).agg(F.expr(f"approx_top_k(`{column}`, {int(most)}, {counters})").alias("_top"))
    return top.select(F.explode("_top").alias("_t")).select(F.col("_t.item").alias(column))
