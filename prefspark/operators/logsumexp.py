"""Log-sum-exp as a mergeable aggregate, for logits wider than one row (LP1, D11).

The state of some logits is ``(level, mass)``: ``mass = sum(exp(x - SPAN * level))`` with ``level`` the floor of
their maximum over SPAN. States of one level merge by adding their masses, which is a plain ``sum`` and so
combines before the shuffle; states of different levels, few for any key, merge by scaling to the highest. No value
overflows: an exponent is never above SPAN.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 64.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda of its own."""
    return F.transform(F.array(value), body)[0]


def state_of(logits) -> Column:
    """``struct<level, mass>`` of an array of logits. NULL and -inf entries have no mass; without other entries both are NULL.

    A NaN entry gives a NaN mass, +inf an infinite one.
    """
    xs = _c(logits)

    def level_of(top: Column) -> Column:
        odd = F.isnan(top) | (top == F.lit(float("inf")))
        return F.when(odd, F.lit(0.0)).when(top != F.lit(float("-inf")), F.floor(top / SPAN).cast("double"))

    def mass(base: Column) -> Column:
        # exp(-inf) is 0, so masked items need no test of their own
        return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + F.coalesce(F.exp(x.cast("double") - base), F.lit(0.0)))

    # the maximum is bound once, and alone: NaN is the largest of all, -inf only where nothing else is
    return let(F.array_max(xs), lambda top: let(level_of(top), lambda lv: F.struct(
        lv.alias("level"), let(lv * SPAN, lambda base: F.when(base.isNotNull(), mass(base))).alias("mass"))))


def merged(states) -> Column:
    """The log-sum-exp of an array of ``struct<level, mass>``; NULL if none has mass."""
    xs = F.filter(_c(states), lambda s: s["mass"].isNotNull())
    return let(xs, lambda held: let(F.array_max(F.transform(held, lambda s: s["level"])), lambda top: F.when(
        top.isNotNull(), top * SPAN + F.log(F.aggregate(held, F.lit(0.0), lambda acc, s: acc + s["mass"] * F.exp((s["level"] - top) * SPAN))))))


def log_sum_exp(df: DataFrame, keys: Sequence[str], logits: str = "logits", out: str = "lse") -> DataFrame:
    """``(keys, out)``: the log-sum-exp of all ``logits`` arrays of each key, in any number of rows."""
    states = df.select(*keys, state_of(logits).alias("s")).select(*keys, "s.level", "s.mass")
    sums = states.groupBy(*keys, "level").agg(F.sum("mass").alias("mass"))
    return sums.groupBy(*keys).agg(merged(F.collect_list(F.struct("level", "mass"))).alias(out))


def sliced_token_logps(df: DataFrame, keys: Sequence[str] = ("seq_id", "pos"), logits: str = "logits", label: str = "label",
                       offset: str = "offset", out: str = "logp") -> DataFrame:
    """LP1 + JN2 over slices of the vocabulary: ``(keys, out)`` with ``log_softmax(all logits of the key)[label]``.

    A row has the logits of items ``offset .. offset + size - 1``. Rows reduce to a state and the label's own logit
    before anything is shuffled. A label outside all slices raises, as does one in several of them.
    """
    place = _c(label) - _c(offset)
    inside = (place >= 0) & (place < F.size(_c(logits)))
    own = F.when(inside, F.get(_c(logits), place.cast("int")).cast("double"))
    rows = df.select(*keys, state_of(logits).alias("s"), own.alias("own"), inside.cast("int").alias("hits")).select(*keys, "s.*", "own", "hits")
    sums = rows.groupBy(*keys, "level").agg(F.sum("mass").alias("mass"), F.max("own").alias("own"), F.sum("hits").alias("hits"))
    found = sums.groupBy(*keys).agg(
        merged(F.collect_list(F.struct("level", "mass"))).alias("lse"), F.max("own").alias("own"), F.sum("hits").alias("hits"))
    wrong = F.raise_error(F.concat(F.lit("label in "), F.col("hits").cast("string"), F.lit(" slices for key "), F.to_json(F.struct(*keys))))
    return found.select(*keys, F.when(F.col("hits") != 1, wrong).otherwise(F.col("own") - F.col("lse")).alias(out))
