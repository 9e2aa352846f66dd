"""Seeded permutations of 0 .. n - 1, row by row: a shuffle without a sort (BA1, BA2).

``x`` is split into ``(x div b, x mod b)`` with ``a * b`` the least product over ``n`` of nearly equal sides, and mixed by a
Feistel network whose halves are added modulo ``a`` and ``b``: every round is a bijection of the ``a * b`` points. A
result of ``n`` or more is mixed again until it is below ``n`` (cycle walking), which keeps the map a bijection of
0 .. n - 1. Fewer than ``a`` points lie outside, so about one row in ``sqrt(n)`` walks, and never more than ``a`` steps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark.functions.exprs import md5_key
from prefspark.operators.logsumexp import let

#: Each step mixes both halves.
STEPS = 3


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x).cast("bigint")


def _draw(step: Column, half: Column, *key: Column) -> Column:
    """32 bits that depend on the step, a half and the key."""
    return F.conv(F.substring(md5_key(step, half, *key), 1, 8), 16, 10).cast("bigint")


def _mixed(x: Column, a: Column, b: Column, key: list[Column]) -> Column:
    start = F.struct(F.floor(x / b).cast("bigint").alias("l"), F.pmod(x, b).alias("r"))

    def step(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + _draw(i * 2, s["r"], *key), a)
        return let(left, lambda l: F.struct(l.alias("l"), F.pmod(s["r"] + _draw(i * 2 + 1, l, *key), b).alias("r")))  # noqa: E741

    return F.aggregate(F.array(*[F.lit(i) for i in range(STEPS)]), start, step, lambda s: s["l"] * b + s["r"])


def permuted(index, n, *key) -> Column:
    """The place of ``index`` (0 .. n - 1) in the permutation of 0 .. n - 1 that ``key`` (seed, epoch, ..) names.

    ``n`` is a number or a column, so that every group may have a size of its own; up to 2 ** 52 (sides are
    found in doubles). An index outside 0 .. n - 1 raises.
    """
    x, size, key = _c(index), _c(n), [_c(k) for k in key]
    a = F.greatest(F.ceil(F.sqrt(size.cast("double"))), F.lit(1)).cast("bigint")
    b = F.greatest(F.ceil(size / a), F.lit(1)).cast("bigint")
    sides = F.struct(a.alias("a"), b.alias("b"), size.alias("n"))

    def walk(s: Column) -> Column:
        again = lambda y: _mixed(y, s["a"], s["b"], key)
        steps = F.sequence(F.lit(1).cast("bigint"), s["a"])
        return let(again(x), lambda first: F.when(first < s["n"], first).otherwise(
            F.aggregate(steps, first, lambda y, _: F.when(y < s["n"], y).otherwise(again(y)))))

    outside = F.raise_error(F.concat(F.lit("index outside the permutation: "), F.coalesce(x.cast("string"), F.lit("NULL"))))
    return F.when((x >= 0) & (x < size), let(sides, walk)).otherwise(outside.cast("bigint"))
