"""Resharding by minimum-cost flow (operator 5).

Documents lie in old shards; the new shards shall hold row counts at most one apart. Each old
shard's documents are ranked by size and cut into at most ``blocks`` blocks of equally many rows.
A flow network has one node a block: its rows may stay in the shard of the same number for
nothing, or move for their mean size a row. New shards take N div n rows each, and one more row at
a price that no move can reach. The cheapest maximum flow says how many rows of each block move
where; it moves the fewest bytes at block level, since the smallest documents of a shard are its
first block. The network has a node a block and shard, whatever the size of the data.

The moves are rank intervals of old shards, so a document's new shard and slot follow from its
rank by a join with a few intervals, and only files of shards that gain or lose rows are rewritten:
whole rows are dealt to their new shard and slot and written there.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prefspark.operators.indexing import global_index
from prefspark.session import ensure_checkpoint_dir


class Network:
    """Directed arcs with capacities and integer costs, and a cheapest maximum flow over them."""

    def __init__(self) -> None:
        self.arcs: dict[int, list[int]] = {}
        self.head: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def add(self, u: int, v: int, room: int, cost: int) -> int:
        """A new arc's number; the next number is its reverse."""
        for a, b, c, w in ((u, v, room, cost), (v, u, 0, -cost)):
            self.arcs.setdefault(a, []).append(len(self.head))
            self.head.append(b)
            self.room.append(c)
            self.cost.append(w)
        return len(self.head) - 2

    def flow(self, arc: int) -> int:
        return self.room[arc + 1]

    def saturate(self, source: int, sink: int) -> None:
        """Push flow along cheapest paths until none is left."""
        while True:
            best, came, queued = {source: 0}, {}, {source}
            queue = deque([source])
            while queue:
                u = queue.popleft()
                queued.discard(u)
                for a in self.arcs.get(u, ()):
                    v, d = self.head[a], best[u] + self.cost[a]
                    if self.room[a] and d < best.get(v, d + 1):
                        best[v], came[v] = d, a
                        if v not in queued:
                            queued.add(v)
                            queue.append(v)
            if sink not in came:
                return
            path, v = [], sink
            while v != source:
                path.append(came[v])
                v = self.head[came[v] ^ 1]
            amount = min(self.room[a] for a in path)
            for a in path:
                self.room[a] -= amount
                self.room[a ^ 1] += amount


def solve_moves(blocks: list[tuple[int, int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Blocks (old shard, first rank, rows, bytes) -> (old shard, rank from, rank to, new shard), all ranks covered."""
    blocks = sorted(blocks)
    total = sum(b[2] for b in blocks)
    price = sum(b[3] for b in blocks) * 1000 + 1
    net = Network()
    source, sink, hub = 0, 1, 2
    shard_node = lambda j: 3 + j
    stay, move = [], []
    for i, (old, _, rows, size) in enumerate(blocks):
        node = 3 + shards + i
        net.add(source, node, rows, 0)
        stay.append(net.add(node, shard_node(old), rows, 0) if 0 <= old < shards else None)
        move.append(net.add(node, hub, rows, max(1, size * 1000 // rows)))
    gains = [net.add(hub, shard_node(j), total, 0) for j in range(shards)]
    for j in range(shards):
        net.add(shard_node(j), sink, total // shards, 0)
        net.add(shard_node(j), sink, 1, price)
    net.saturate(source, sink)
    wanted = [[j, net.flow(a)] for j, a in enumerate(gains) if net.flow(a)]
    out: list[list[int]] = []

    def put(old: int, start: int, rows: int, new: int) -> None:
        if out and out[-1][0] == old and out[-1][2] == start and out[-1][3] == new:
            out[-1][2] += rows
        elif rows:
            out.append([old, start, start + rows, new])

    for i, (old, start, rows, _) in enumerate(blocks):
        left = net.flow(move[i])
        while left:
            part = min(left, wanted[0][1])
            put(old, start, part, wanted[0][0])
            start, left, rows = start + part, left - part, rows - part
            wanted[0][1] -= part
            if not wanted[0][1]:
                wanted.pop(0)
        put(old, start, rows, old)
    return [tuple(x) for x in out]


def reshard(
    docs: DataFrame, old_col: str, shards: int = 8, blocks: int = 64, id_col: str = "doc_id", text_col: str = "text",
    row_cols: Sequence[str] = (),
) -> DataFrame:
    """(id, size, text_crc32, old_shard, shard, slot) and ``row_cols`` for every row of ``docs``.

    ``old_col`` numbers a row's present shard (an int; null and numbers beyond the new shards mean that
    its rows have no shard to stay in). size: UTF-8 bytes of the text plus 1, a null text has none and
    the CRC of the empty text. Row counts of the new shards differ by one at most; slots of a shard run
    from 0 without gaps. Equal rows are told apart by their rank only. An empty table gives no rows.
    ``row_cols`` name a row of ``docs`` for ``rewrite``, the same at each reading: a file and a row number in it, say.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.coalesce(F.col(old_col).cast("int"), F.lit(-1)).alias("old_shard"),
        *row_cols,
    )
    ranked = global_index(narrow, ["old_shard", "size", "id", "text_crc32", *row_cols], "idx")
    spans = ranked.groupBy("old_shard").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("rows"))
    spans = F.broadcast(spans)  # a row an old shard
    ranked = ranked.join(spans, "old_shard").withColumn("rank", F.col("idx") - F.col("first"))
    block = F.floor(F.col("rank") * blocks / F.col("rows"))
    listed = ranked.groupBy("old_shard", block.alias("block")).agg(
        F.min("rank").alias("start"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")
    ).collect()  # at most ``blocks`` rows an old shard
    moves = solve_moves([(r.old_shard, r.start, r.n, r.bytes) for r in listed], shards)
    filled, table = [0] * shards, []
    for old, a, b, new in moves:
        table.append((old, a, b, new, filled[new]))
        filled[new] += b - a
    spark = docs.sparkSession
    plan = spark.createDataFrame(table, "old_shard int, a long, b long, shard int, base long")
    return (
        ranked.join(F.broadcast(plan), "old_shard").where("rank >= a AND rank < b")
        .select(F.col("id").alias(id_col), "size", "text_crc32", "old_shard", "shard",
                (F.col("base") + F.col("rank") - F.col("a")).alias("slot"), *row_cols)
    )


def rewrite(
    docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id", rows_a_file: int = 100_000, row_cols: Sequence[str] = ()
) -> list[int]:
    """Write the new content of the shards that gain or lose rows to ``path``/shard=<n>; returns their numbers.

    ``placed`` is the result of ``reshard`` for the same rows and ``row_cols``, which both tables have: each row
    finds its place by them, whatever its id. Without them rows are found by id, and null or repeated ids raise.
    Shards that keep exactly their rows are left alone. Rows are dealt by shard and slot range, so a large shard
    becomes several files, in slot order.
    """
    keys = list(row_cols) or [id_col]
    if not row_cols:
        bad = placed.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where(F.col(id_col).isNull() | (F.col("n") > 1))
        if bad.limit(1).count():
            raise ValueError(f"null or repeated {id_col}: rewrite needs row_cols")
    changed = placed.where("old_shard <> shard")
    sides = changed.select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct()
    affected = sorted(r.s for r in sides.collect() if r.s >= 0)
    target = placed.select(*keys, "old_shard", "shard", "slot").where(F.col("shard").isin(affected))
    rows = docs.drop("old_shard", "shard", "slot").join(target, keys).drop(*row_cols)
    part = F.floor(F.col("slot") / rows_a_file)
    dealt = rows.repartition("shard", part).sortWithinPartitions("shard", "slot")
    dealt.write.mode("append").partitionBy("shard").option("compression", "zstd").parquet(path)
    return affected


def resharded(
    docs: DataFrame, old_col: str, row_cols: Sequence[str], shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
    rows_a_file: int = 100_000,
) -> DataFrame:
    """(id, size, text_crc32, old_shard, shard, slot) of every row after the affected shards were written anew.

    Sizes and CRCs of rewritten shards are those of the texts read back from their files; shards that were left
    alone are the old rows. The files lie in a fresh folder under ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    placed = reshard(docs, old_col, shards, id_col=id_col, text_col=text_col, row_cols=row_cols)
    path = f"{ensure_checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}"
    affected = rewrite(docs.select(id_col, text_col, *row_cols), placed, path, id_col, rows_a_file, row_cols)
    schema = StructType([*docs.select(id_col, text_col).schema.fields, *placed.select("old_shard", "slot", "shard").schema.fields])
    text = F.coalesce(F.col(text_col), F.lit(""))
    written = spark.read.schema(schema).parquet(path).select(
        id_col, (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        "old_shard", "shard", "slot",
    )
    return written.unionByName(placed.where(~F.col("shard").isin(affected)).drop(*row_cols))
