"""Merkle manifest of a dataset with a witness for every row (operator 13).

Rows are leaves. In a group (a source) leaves ascend by key; while several nodes remain, every ``ARITY``
consecutive ones become the hash of their hexadecimal digests, put together (a last run may be shorter, even a single
node). What remains is the group's subroot; subroots in group order give the root in the same way.

Witnesses grow while nodes are appended. ``Tree`` holds the open subtrees, aligned to powers of ``ARITY``;
each leaf under an open subtree has a partial witness, and when a subtree's siblings are complete, all
witnesses under them are extended by the siblings' digests. Blocks of ``ARITY ** height`` leaves are
appended in tasks of their own; their roots are appended again as nodes of the next round, until one block
is left in each group, and the subroots last. A round's witnesses extend those of the round below, so no
task holds more than one block, and what is shuffled is a digest and a few numbers a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, StringType, StructField, StructType

from prefspark.llm.common import map_batches, materialized
from prefspark.operators.indexing import global_index

ARITY = 3
DIGEST = 32


def parent(children: list[bytes]) -> bytes:
    """The digest of the children's hexadecimal digests put together."""
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


class Tree:
    """Appends leaves one after the other; ``witness[i]`` grows until the tree is closed.

    A step of a witness is the node's place in its run, how many siblings the run has, and their digests.
    """

    def __init__(self) -> None:
        self.witness: list[bytearray] = []
        self.open: list[list[tuple[bytes, int]]] = []  # by level: (digest, first leaf) of the nodes of the open run

    def append(self, leaf: bytes) -> None:
        self.witness.append(bytearray())
        self._add(0, leaf, len(self.witness) - 1)

    def _add(self, level: int, digest: bytes, first: int) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((digest, first))
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """The open run of ``level`` becomes a node of the next; all leaves under it learn their siblings."""
        run, self.open[level] = self.open[level], []
        digests = [d for d, _ in run]
        ends = [first for _, first in run[1:]] + [len(self.witness)]
        for place, ((_, first), end) in enumerate(zip(run, ends, strict=True)):
            step = bytes([place, len(run) - 1]) + b"".join(digests[:place] + digests[place + 1 :])
            for leaf in range(first, end):
                self.witness[leaf] += step
        self._add(level + 1, parent(digests), run[0][1])

    def close(self, height: int | None = None) -> bytes:
        """The root: at ``height`` if given, else at the level where a single node remains."""
        level = 0
        while level < (len(self.open) - 1 if height is None else height):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
            level += 1
        if height is None and len(self.open[level]) > 1:
            self._complete(level)
            level += 1
        return self.open[level][0][0]


def fold(leaf: bytes, witness: bytes) -> tuple[bytes, bytes]:
    """The root that ``leaf`` and its witness lead to, and the hexadecimal digests of all siblings, left to right, level by level."""
    at, siblings = 0, []
    while at < len(witness):
        place, n = witness[at], witness[at + 1]
        others = [witness[at + 2 + DIGEST * i : at + 2 + DIGEST * (i + 1)] for i in range(n)]
        siblings += others
        leaf = parent([*others[:place], leaf, *others[place:]])
        at += 2 + DIGEST * n
    return leaf, b"".join(s.hex().encode() for s in siblings)


def fields_digest(*columns: Column) -> Column:
    """Hexadecimal SHA-256 of the columns as strings: ``-`` for null, else UTF-8 bytes, ``:``, value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table | None, pa.Table]]:
    """(rows with place -1, or None; rows of the block) for each block of rows sorted by group, block and place."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        places = batch.column(batch.schema.get_field_index("_place")).to_pylist()
        heads = batch.column(batch.schema.get_field_index("_head")).to_pylist()
        last = 0
        for i, head in enumerate(heads):
            if head:
                held.append(batch.slice(last, i - last))
                yield from _split(held)
                held, last = [], i
        if len(places) > last:
            held.append(batch.slice(last))
    yield from _split(held)


def _split(held: list[pa.RecordBatch]) -> Iterator[tuple[pa.Table | None, pa.Table]]:
    held = [b for b in held if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        above = table.column("_place")[0].as_py() < 0
        yield (table.slice(0, 1) if above else None), table.slice(1 if above else 0)


def _append_all(rows: pa.Table, height: int) -> tuple[Tree, bytes]:
    tree = Tree()
    for leaf in rows.column("_digest").to_pylist():
        tree.append(leaf)
    return tree, tree.close(height if rows.column("_count")[0].as_py() > ARITY**height else None)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows in blocks: each block in one partition, ordered by place."""
    return rows.repartition("_group", "_block").sortWithinPartitions("_group", "_block", "_place")


def _block(height: int) -> Column:
    return F.floor(F.col("_place") / ARITY**height).cast("bigint")


def _block_roots(nodes: DataFrame, height: int) -> DataFrame:
    """A node of the next round for each block of ``nodes``."""
    group = StructField("_group", nodes.schema["_group"].dataType)
    schema = StructType([group, *nodes.select("_place", "_count", "_digest").schema.fields])
    names, block = schema.names, ARITY**height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _blocks(batches):
            _, root = _append_all(rows, height)
            group, place, count = (rows.column(c)[0].as_py() for c in ("_group", "_place", "_count"))
            made = [pa.array([group], pa.binary()), pa.array([place // block], pa.int64()), pa.array([-(-count // block)], pa.int64()), pa.array([root], pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names)

    placed = nodes.select("_group", "_place", "_count", "_digest", _block(height).alias("_block"), (F.col("_place") % block == 0).alias("_head"))
    return map_batches(_dealt(placed), run, schema)


def _witnesses(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """``nodes`` with subroot, root and witness, given those of their blocks: ``above`` (_group, _block, subroot, root, witness)."""
    extra = ["subroot", "root", "witness"]
    schema = StructType([*nodes.schema.fields, *[StructField(c, BinaryType()) for c in extra]])
    own, names = nodes.columns, schema.names
    # what is known of a block comes right before its nodes
    lower = nodes.select("*", *[F.lit(None).cast("binary").alias(c) for c in extra], _block(height).alias("_block"), F.lit(False).alias("_head"))
    upper = above.select("_group", "_block", *extra, F.lit(-1).cast("bigint").alias("_place"), F.lit(True).alias("_head"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for known, rows in _blocks(batches):
            tree, _ = _append_all(rows, height)
            subroot, root, rest = (known.column(c)[0].as_py() for c in extra)
            made = [pa.array([v] * rows.num_rows, pa.binary()) for v in (subroot, root)] + [pa.array([bytes(w) + rest for w in tree.witness], pa.binary())]
            kept = rows.select(own).combine_chunks()
            yield from pa.table([*kept.columns, *made], names).to_batches()

    return map_batches(_dealt(lower.unionByName(upper, allowMissingColumns=True)), run, schema)


def _grouped(leaves: DataFrame, group: Column, order: list[Column], digest: Column, stretch: int = 1024) -> DataFrame:
    """Rows as _row, with _group (never null), _place (0-based in the group), _count (of the group) and _digest.

    A group's first place and size meet its rows by group and stretch of the global order, so that a group
    of any size is joined in bounded pieces.
    """
    keyed = leaves.select(F.struct(*leaves.columns).alias("_row"), group.alias("_group"), digest.alias("_digest"), *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    indexed = global_index(keyed, ["_group", *[f"_o{i}" for i in range(len(order))]], "_at")
    sizes = indexed.groupBy("_group").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_count"))
    piece = lambda at: F.floor(at / stretch).cast("bigint")
    sizes = sizes.withColumn("_piece", F.explode(F.sequence(piece(F.col("_first")), piece(F.col("_first") + F.col("_count") - 1))))
    joined = indexed.withColumn("_piece", piece(F.col("_at"))).join(sizes, ["_group", "_piece"])
    return joined.select("_row", "_group", (F.col("_at") - F.col("_first")).alias("_place"), "_count", "_digest")


def _tree(nodes: DataFrame, top: Callable[[DataFrame], DataFrame], height: int) -> DataFrame:
    """``nodes`` with subroot, root and witness. ``top`` adds root and witness to the subroots (_group, _round, subroot)."""
    most = nodes.agg(F.max("_count")).first()[0] or 0  # one number
    rounds, subroots = [nodes], None
    while True:
        roots = materialized(_block_roots(rounds[-1], height))
        ended = roots.where("_count = 1").select("_group", F.lit(len(rounds) - 1).alias("_round"), F.col("_digest").alias("subroot"))
        subroots = ended if subroots is None else subroots.unionByName(ended)
        most = -(-most // ARITY**height)
        if most <= 1:
            break
        rounds.append(roots.where("_count > 1"))
    known = materialized(top(subroots))
    columns = ["_group", "_block", "subroot", "root", "witness"]
    above = None
    for i in reversed(range(len(rounds))):
        # the one block of a group that ends in this round; other blocks are nodes of the round above
        last = known.where(F.col("_round") == i).withColumn("_block", F.lit(0).cast("bigint")).select(*columns)
        found = _witnesses(rounds[i], last if above is None else last.unionByName(above), height)
        if i:
            above = materialized(found.withColumn("_block", F.col("_place")).select(*columns))
    return found


def manifest(leaves: DataFrame, leaf_col: str = "leaf", group_col: str = "source", key_col: str = "doc_id", height: int = 6) -> DataFrame:
    """``leaves`` with subroot, root (hexadecimal) and witness (see ``fold``); existing columns of these names are replaced.

    ``leaf_col`` is a hexadecimal SHA-256. Groups are ordered by UTF-8 bytes with null first, rows by key with
    null first; rows that repeat a key are ordered by leaf, and rows equal in both have equal digests in any
    order. A single row is its own subroot and root, with an empty witness. An empty table stays empty. ``leaves`` is
    read once: make it narrow. A task appends blocks of 3 ** ``height`` nodes.
    """
    kept = [c for c in leaves.columns if c not in ("subroot", "root", "witness")]
    # bytes that no other value's can equal: null sorts first, then values with a mark before them
    group = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0")).cast("binary")
    staged = materialized(leaves.select(*kept))
    nodes = materialized(_grouped(staged, group, [F.col(key_col), F.col(leaf_col)], F.unhex(leaf_col)))

    def of_groups(subroots: DataFrame) -> DataFrame:
        ranked = materialized(_grouped(materialized(subroots), F.lit("").cast("binary"), [F.col("_group")], F.col("subroot")))
        alone = _tree(ranked, lambda whole: whole.withColumn("root", F.col("subroot")).withColumn("witness", F.lit(b"")), height)
        return alone.select("_row.*", "root", "witness")

    done = _tree(nodes, of_groups, height)
    return done.select(
        *[F.col("_row").getField(c).alias(c) for c in kept], F.lower(F.hex("subroot")).alias("subroot"), F.lower(F.hex("root")).alias("root"), "witness"
    )


def checked(rows: DataFrame, leaf_col: str, root_col: str = "root", witness_col: str = "witness") -> DataFrame:
    """``rows`` with folded_root (hexadecimal), proof_sha256 (of all siblings) and verified; the witness is dropped.

    Existing columns of these names are replaced. A null leaf or witness gives nulls, and is not verified.
    """
    added = ("folded_root", "proof_sha256", "verified")
    kept = [c for c in rows.columns if c not in (*added, witness_col)]
    source = rows.select(*kept, F.col(witness_col).alias("_witness"))
    fields = [StructField("folded_root", StringType()), StructField("proof_sha256", StringType()), StructField("verified", BooleanType())]
    schema = StructType([*rows.select(*kept).schema.fields, *fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, root = (batch.column(kept.index(c)).to_pylist() for c in (leaf_col, root_col))
            folded, proofs = [], []
            for digest, witness in zip(leaf, batch.column(len(kept)).to_pylist(), strict=True):
                if digest is None or witness is None:
                    folded.append(None)
                    proofs.append(None)
                    continue
                top, siblings = fold(bytes.fromhex(digest), witness)
                folded.append(top.hex())
                proofs.append(hashlib.sha256(siblings).hexdigest())
            verified = [f is not None and f == r for f, r in zip(folded, root, strict=True)]
            made = [pa.array(folded, pa.string()), pa.array(proofs, pa.string()), pa.array(verified, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names)

    return map_batches(source, run, schema)
