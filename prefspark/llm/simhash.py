"""SimHash near-duplicates through sharded BK-trees (operator 3).

A document's fingerprint takes the majority of each bit over the XXH64 hashes of its word
shingles. Two fingerprints within the radius agree on at least ``blocks - radius`` of the
``blocks`` bit ranges, so each choice of that many ranges is a shard key: linked fingerprints
share a key. The number of ranges follows the number of distinct fingerprints, so that a shard has ``tree_rows`` of them
on average at any size: with few ranges a fingerprint has few keys, with many a key has many bits. In each shard, a BK-tree holds children by their integer Hamming distance to the
parent, and a search only follows edges within the radius of the distance just measured.

Equal fingerprints collapse before the search, so copies cost nothing. A shard of more than
``shard_rows`` fingerprints is dealt into several trees, and each tree travels to each block of
queries: no task holds more than two blocks. A task reports only a spanning chain of what it
linked, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from prefspark.llm.common import binary_list, group_bounds, map_batches, materialized, row_number_of, scanned, whole_groups
from prefspark.llm.components import connected_components

SEED = 42


def fingerprint(text: bytes, words_each: int = 4) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text; 0 without words.

    bytes.lower folds A-Z only and bytes.split cuts at the six ASCII white-space characters.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[words_each - 1 :] if len(words) >= words_each else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), last.tolist(), strict=False)]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = np.array(hashes[at : at + (1 << 15)], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words_each: int = 4, text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. Null text counts as text without words."""
    source = docs.select("doc_id", text_col)
    schema = StructType([source.schema["doc_id"], StructField("fp", LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words_each) for t in binary_list(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return map_batches(source, run, schema)


def shard_keys(blocks: int, radius: int, fp: str = "fp") -> Column:
    """Array of shard keys of a fingerprint: one for each choice of ``blocks - radius`` bit ranges."""
    if not 0 <= radius < blocks:
        raise ValueError("need more blocks than differing bits")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    keys = []
    for c, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(masks[i] for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(c).alias("choice"), F.col(fp).bitwiseAND(F.lit(signed).cast("long")).alias("value")))
    return F.array(*keys)


def ranges_for(distinct: int, radius: int, tree_rows: int = 512) -> int:
    """The least number of bit ranges whose shards hold at most ``tree_rows`` of ``distinct`` random fingerprints on average.

    Every number of ranges finds every link; it only sets how the work is cut. The more ranges, the more keys a fingerprint
    has (5, 15, 35, .. for radius 4) and the more values a key (13, 21, 27, .. bits).
    """
    blocks = radius + 1
    while blocks < 16 and distinct >> (64 * (blocks - radius) // blocks) > tree_rows:
        blocks += 1
    return blocks


class Forest:
    """BK-trees of several groups at once, built and searched level by level.

    ``group`` numbers the tree each fingerprint belongs to. ``children`` sorts the nodes by
    (parent, distance to the parent), so the edges of a node within a range are one slice.
    """

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        self.fps = fps
        self.visited = 0  # nodes that searches so far measured a distance to
        n = len(fps)
        parent, distance = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        order = np.argsort(group, kind="stable")
        items, cell = order, group[order]
        self.root_group, first = np.unique(cell, return_index=True)
        self.root = items[first]
        while len(items):
            starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            sizes = np.diff(np.append(starts, len(cell)))
            heads = np.repeat(items[starts], sizes)  # the first of a cell becomes its node
            rest = np.ones(len(items), bool)
            rest[starts] = False
            items, heads = items[rest], heads[rest]
            gap = np.bitwise_count(fps[items] ^ fps[heads]).astype(np.int64)
            parent[items], distance[items] = heads, gap
            cell = heads * 65 + gap
            order = np.argsort(cell, kind="stable")
            items, cell = items[order], cell[order]
        inner = np.flatnonzero(parent >= 0)
        edge = parent[inner] * 65 + distance[inner]
        order = np.argsort(edge, kind="stable")
        self.children, self.edges = inner[order], edge[order]

    def search(self, queries: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, node index) of all pairs within the radius in the query's group."""
        at = np.searchsorted(self.root_group, group)
        at[at == len(self.root_group)] = 0
        known = self.root_group[at] == group if len(self.root_group) else np.zeros(len(group), bool)
        who, node = np.flatnonzero(known), self.root[at[known]]
        while len(who):
            self.visited += len(who)
            gap = np.bitwise_count(queries[who] ^ self.fps[node]).astype(np.int64)
            near = gap <= radius
            yield who[near], node[near]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(gap - radius, 0), "left")
            high = np.searchsorted(self.edges, node * 65 + np.minimum(gap + radius, 64), "right")
            count = high - low
            total = int(count.sum())
            who = np.repeat(who, count)
            ahead = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            node = self.children[ahead]


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest index of the component so far) after linking a[i] with b[i] for all i."""
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return labels
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low = np.minimum(la, lb)
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up


def link_shards(keys: np.ndarray, fps: np.ndarray, ids: np.ndarray, in_tree: np.ndarray, asks: np.ndarray, radius: int):
    """Spanning chains (id, id) of what the trees of all shards in one chunk link."""
    tree_rows = np.flatnonzero(in_tree)
    ask_rows = np.flatnonzero(asks)
    forest = Forest(fps[tree_rows], keys[tree_rows])
    labels = np.arange(len(fps))
    # so few queries at a time that even a search that visits whole trees stays within memory
    _, sizes = np.unique(keys[tree_rows], return_counts=True)
    step = max(256, 8_000_000 // max(1, int(sizes.max(initial=1))))
    for at in range(0, len(ask_rows), step):
        rows = ask_rows[at : at + step]
        for who, node in forest.search(fps[rows], keys[rows], radius):
            labels = merge_labels(labels, rows[who], tree_rows[node])
    order = np.argsort(labels, kind="stable")
    same = labels[order][1:] == labels[order][:-1]
    return ids[order[:-1][same]], ids[order[1:][same]]


def near_links(prints: DataFrame, radius: int = 4, blocks: int | None = None, shard_rows: int = 16_384) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fingerprints within ``radius`` bits.

    ``prints``: (fp, rep), distinct fp, rep a long that names it. ``shard_rows`` bounds a tree
    and a block of queries; larger shards are dealt into several of each. ``blocks``: bit ranges, by default
    those of ``ranges_for`` the number of fingerprints.
    """
    blocks = blocks or ranges_for(prints.count(), radius)
    keyed = prints.select("fp", "rep", F.explode(shard_keys(blocks, radius)).alias("k")).select(
        F.xxhash64("k.choice", "k.value").alias("key"), "fp", "rep"
    )
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / shard_rows).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    dealt = (
        keyed.join(counts, "key").withColumn("parts", parts).withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                F.col("mine").alias("part"), "fp", "rep")
    )
    grouped = dealt.repartition(F.col("key"), F.col("i"), F.col("j")).sortWithinPartitions("key", "i", "j")
    schema = "a long, b long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("key", "i", "j")):
            bounds = group_bounds(table, ("key", "i", "j"))
            shard = np.repeat(np.arange(len(bounds)), [e - s for s, e in bounds])
            col = {c: table.column(c).to_numpy() for c in ("i", "j", "part", "fp", "rep")}
            a, b = link_shards(shard, col["fp"].view(np.uint64), col["rep"], col["part"] == col["i"], col["part"] == col["j"], radius)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return map_batches(grouped, run, schema)


def _labelled(named: DataFrame, radius: int, blocks: int | None, shard_rows: int) -> DataFrame:
    """``named`` (fp, rep: a long) with label, the smallest rep of the fingerprint's component."""
    reached = connected_components(near_links(named, radius, blocks, shard_rows))
    return named.join(reached, named["rep"] == reached["node"], "left").select("fp", "rep", F.coalesce("component", "rep").alias("label"))


def near_duplicates(
    docs: DataFrame, words_each: int = 4, radius: int = 4, blocks: int | None = None, shard_rows: int = 16_384, text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``; ``doc_id`` is a long.

    component_id is the smallest doc_id reachable over links of at most ``radius`` differing bits,
    the row's own included. Null text counts as empty; all texts without words share fingerprint 0.
    A null doc_id takes part through its fingerprint but is never a component_id; component_id is
    null only if no linked row has an id. Repeated rows give repeated result rows. An empty table gives no rows;
    a very long text is one row of one task, held as its words and a hash for each.
    """
    prints = materialized(fingerprints(docs, words_each, text_col))
    distinct = materialized(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    # a fingerprint whose rows all lack an id still carries links: it is named by its own hash, below all ids
    named = distinct.select("fp", F.coalesce("rep", F.lit(-(1 << 62)) - F.abs(F.shiftright(F.xxhash64("fp"), 2))).alias("rep"))
    joined = _labelled(named, radius, blocks, shard_rows)
    real = F.min(F.when(F.col("rep") >= -(1 << 62), F.col("rep")))
    ids = joined.groupBy("label").agg(real.alias("component_id"))
    labels = joined.join(ids, "label").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words_each: int = 4, radius: int = 4, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each component of linked fingerprints, all columns kept.

    The row of the smallest id stays, an id before none; of several rows with that id the one of the smallest fingerprint, then the
    first as written. So rows without an id go if they are copies, and of rows that share an id but not a component
    each stays. An empty table stays empty. ``docs`` is written to the shared folder unless it is a plain scan of files.
    """
    # the row travels as one struct, so that its columns cannot clash with those added here
    lying = scanned(docs)
    numbered = lying.select(F.struct(*docs.columns).alias("row"), row_number_of(lying).alias("row_no"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = materialized(fingerprints(
        numbered.select(F.struct("id", "row_no").alias("doc_id"), "text"), words_each).select("doc_id.id", "doc_id.row_no", "fp"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_no"))
    distinct = materialized(prints.groupBy("fp").agg(first.alias("first")))
    labelled = _labelled(distinct.select("fp", F.col("fp").alias("rep")), radius, None, 16_384).select("fp", "label")
    best = F.min(F.struct("first.no_id", "first.id", "fp", "first.row_no"))
    keep = distinct.join(labelled, "fp").groupBy("label").agg(best.alias("best")).select(F.col("best.row_no").alias("row_no"))
    return numbered.select("row_no", "row").join(keep, "row_no", "left_semi").select("row.*")
