"""Candidate sets and draws over per-sequence logit tables (BA4, BA5).

Generation itself is not built; its table-shaped parts are: temperature softmax,
the nucleus (top-p) set and a seeded Gumbel-max draw. Windows are partitioned by
sequence, so a group is one vocabulary row -- bounded by the vocabulary width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.functions.exprs import unit_uniform
from prefspark.operators.logsumexp import let

# Nucleus mass and sampling temperature of the rollout generator.
TOP_P, TEMPERATURE = 0.9, 0.7


def softmax(df: DataFrame, key: str = "seq_id", logit: str = "logit", temperature: float = 1.0,
            out: str = "prob") -> DataFrame:
    """Temperature softmax over each sequence's items (max-shifted, so exp never overflows)."""
    w = Window.partitionBy(key)
    z = F.col(logit) / F.lit(temperature)
    return (
        df.withColumn("_z", z)
        .withColumn("_e", F.exp(F.col("_z") - F.max("_z").over(w)))
        .withColumn(out, F.col("_e") / F.sum("_e").over(w))
        .drop("_z", "_e")
    )


def nucleus(df: DataFrame, top_p: float = TOP_P, temperature: float = TEMPERATURE, key: str = "seq_id",
            item: str = "item", logit: str = "logit", top_k: int | None = None) -> DataFrame:
    """BA4: the smallest most-probable set whose mass reaches ``top_p``.

    Items are ranked by (prob desc, item); an item is kept while the mass strictly
    before it is below ``top_p``, so the first item is always kept. ``top_k`` (unset in
    the reference) additionally keeps only the k best.
    """
    p = softmax(df, key, logit, temperature)
    order = Window.partitionBy(key).orderBy(F.col("prob").desc(), F.col(item))
    before = F.coalesce(F.sum("prob").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ranked = p.withColumn("rank", F.row_number().over(order)).withColumn("mass_before", before)
    keep = F.col("mass_before") < F.lit(top_p)
    if top_k is not None:
        keep = keep & (F.col("rank") <= top_k)
    return ranked.where(keep)


def sample_one(candidates: DataFrame, seed: int = 42, key: str = "seq_id", item: str = "item",
               prob: str = "prob") -> DataFrame:
    """BA5: one draw per sequence from ``candidates`` (e.g. the nucleus) by Gumbel-max.

    ``argmax(ln p - ln(-ln u))`` with ``u`` from md5(key:item:seed) is an exact sample
    of the renormalised distribution, repeatable, and a plain grouped ``max_by``.
    """
    score = F.log(F.col(prob)) - F.log(-F.log(unit_uniform(F.col(key), F.col(item), F.lit(seed))))
    return candidates.groupBy(key).agg(F.max_by(F.col(item), score).alias(item))


def nucleus_of(logits, top_p: float = TOP_P, temperature: float = TEMPERATURE, top_k: int | None = None) -> Column:
    """BA4 on a row of logits (D11): ``array<struct<item, prob>>`` of the nucleus, most probable first.

    The same set as ``nucleus`` gives, as an expression on the array: nothing is exploded, shuffled or sorted across
    rows. A NULL logit is no candidate; a row without logits has an empty nucleus.
    """
    row = F.col(logits) if isinstance(logits, str) else logits
    scaled = F.transform(row, lambda x: x.cast("double") / F.lit(temperature))

    def chosen(z: Column) -> Column:
        # (-exp(z - max), item) sorts by probability, then item; the mass is their sum
        weights = lambda top: F.filter(F.transform(z, lambda x, i: F.struct((-F.exp(x - top)).alias("w"), i.alias("item"))),
                                       lambda s: s["w"].isNotNull())
        return let(let(F.array_max(z), weights), lambda ws: let(F.aggregate(ws, F.lit(0.0), lambda acc, s: acc - s["w"]),
                                                                lambda mass: kept(F.sort_array(F.transform(ws, lambda s: F.struct((s["w"] / mass).alias("w"), s["item"].alias("item")))))))

    def kept(ranked: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            return F.when(acc["before"] < F.lit(top_p), F.struct((acc["before"] - s["w"]).alias("before"), (acc["n"] + 1).alias("n"))).otherwise(acc)

        def first(rows: Column) -> Column:
            start = F.struct(F.lit(0.0).alias("before"), F.lit(0).alias("n"))
            n = F.aggregate(rows, start, step, lambda acc: acc["n"])
            return F.slice(rows, 1, F.least(n, F.lit(top_k)) if top_k is not None else n)

        return F.transform(let(ranked, first), lambda s: F.struct(s["item"].alias("item"), (-s["w"]).alias("prob")))

    return let(scaled, chosen)


def drawn_of(candidates, key, seed: int = 42) -> Column:
    """BA5 on a row: the item that ``sample_one`` draws from an ``array<struct<item, prob>>``; NULL if it is empty."""
    items = F.col(candidates) if isinstance(candidates, str) else candidates
    name = F.col(key) if isinstance(key, str) else key
    scored = F.transform(items, lambda s: F.struct(
        (F.log(s["prob"]) - F.log(-F.log(unit_uniform(name, s["item"], F.lit(seed))))).alias("score"), s["item"].alias("item")))
    return F.array_max(scored)["item"]
