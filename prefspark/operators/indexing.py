"""Global ordered numbering without a single-partition window.

``row_number() OVER (ORDER BY k)`` puts every row into one task. Instead the frame is
range-partitioned and sorted (Spark samples the keys, so hot values are split across
ranges when the order key is unique), each row gets ``monotonically_increasing_id``
(partition id in the high bits, local position in the low 33 bits), the frame is
checkpointed so the numbering is fixed and survives executor loss, and one offset per
partition -- bounded by the partition count, not by the data -- turns the local
position into a contiguous global index. Only the per-partition counts (one integer per
partition) reach the driver; the offsets go back into the plan as a literal array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.session import materialize

_LOCAL_BITS = 33
BROADCAST_BYTES = 256 << 20


def global_index(df: DataFrame, order: Sequence[Column | str], idx_col: str = "idx") -> DataFrame:
    """Add a 0-based contiguous ``idx_col`` following the total order ``order``.

    The order must be total (end it with a unique key); ties are otherwise numbered
    in an arbitrary but fixed way.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    staged = materialize(df.orderBy(*cols).withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    # One count per non-empty partition: bounded by the partition count, not by the data,
    # so the prefix sum runs on the driver and comes back as a literal array indexed by
    # partition id -- a plain expression, no join and no Python-side table.
    counts = dict(tuple(r) for r in staged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1))).collect())
    offsets, running = [], 0
    for p in range(int(max(counts, default=-1)) + 1):
        offsets.append(running)
        running += int(counts.get(p, 0))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    if not offsets:
        return staged.withColumn(idx_col, local.cast("bigint")).drop("_mid")
    # one string literal, whatever the number of partitions; the optimizer folds it to an array
    table = F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")
    return staged.withColumn(idx_col, (F.element_at(table, (pid + 1).cast("int")) + local).cast("bigint")).drop("_mid")


def rank_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    rank_col: str = "rank",
    broadcast_groups_below: int = 1_000_000,
) -> DataFrame:
    """0-based rank inside each group, safe when one group holds a large share of all rows.

    Rows are numbered globally in (group, order) order; a group's rank is the distance
    from its first index. The group-start table is pre-aggregated map-side, so a hot
    group shuffles one row per partition; it is broadcast only below a counted size in rows and bytes.
    """
    indexed = global_index(df, [*group, *order], "_gidx")
    named = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    starts = indexed.groupBy(*named).agg(F.min("_gidx").alias("_start"))
    width = F.coalesce(F.octet_length(F.to_json(F.struct(*[F.col(f"_g{i}") for i in range(len(group))]))), F.lit(0)) + 8
    size = starts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    if size["n"] <= broadcast_groups_below and size["bytes"] <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    same = F.lit(True)
    for i, g in enumerate(group):  # NULL is a group like any other
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return indexed.join(starts, same).withColumn(rank_col, F.col("_gidx") - F.col("_start")).select(*df.columns, rank_col)
