"""Quality by an interpolated modified Kneser-Ney trigram model of trusted text (operator 4).

Learning: three quarters of the trusted documents (labelled good, not toxic) of each language, told apart by a hash of
their ids, are counted whole: each shard of n-grams is a few compressed arrays of counts, from which it works out every trigram's, bigram's
and word's discounted share, and each context's weight for the order below. All other
trusted documents calibrate, so every trusted document is used.

Scoring: the tables grow with the trusted text, so they stay sharded by a hash of the n-gram. A block of documents asks
each shard for its distinct n-grams, packed; a shard answers in that order, and the answers meet the block's texts. A
document's perplexity is over its words, with ``prior_words`` words at its language's mean added, so that a few words
decide little. Thresholds are quantiles of all calibration documents of each language (see ``classify``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.llm.bpe import slices
from prefspark.llm.common import binary_list, map_batches, materialized, row_number_of, scanned
from prefspark.session import Scratch, ensure_checkpoint_dir, shuffles_released

#: Stands before the first word of a text (twice).
START = 0

#: Bytes of text in a block of documents, and n-grams asked of one shard by all blocks, about.
BLOCK_BYTES = 4 << 20
SHARD_GRAMS = 8 << 20

#: Words counted at once by a task that learns, in how many turns shards are learned and documents scored, and blocks that a turn scores at least.
PIECE_WORDS = 1 << 20
LEARN_ROUNDS, SCORE_ROUNDS, TURN_BLOCKS = 4, 12, 8

#: So many ids of documents to learn travel to the tasks as a table; if there are more, documents and ids meet in a shuffle join.
BROADCAST_IDS = 1 << 20

#: Which bytes are white space.
WHITE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of each 64-bit number depends on all of its bits; no two numbers become one."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


class Hashes:
    """Words -> their 64-bit hashes, eight bytes of all words at a time; a word over ``longest`` bytes by itself."""

    seed = 4
    longest = 64

    def of(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the words that lie there in ``data``, which goes on for 8 bytes after the last."""
        eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        lengths = ends - starts
        h = mixed(lengths.astype(np.uint64) + np.uint64(self.seed << 32))
        mine = np.flatnonzero(lengths <= self.longest)
        for at in range(0, self.longest, 8):
            left = lengths[mine] - at
            part = eights[starts[mine] + at]
            part &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * np.minimum(left, 8).astype(np.uint64))
            h[mine] = mixed(h[mine] ^ part)
            mine = mine[left > 8]
            if not len(mine):
                break
        for i in np.flatnonzero(lengths > self.longest).tolist():
            h[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], self.seed)
        return h.view(np.int64)


def word_hashes(texts: list[bytes], hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (case counts), the two words before each, and how many words each text has."""
    data = b" ".join([b"", *texts, b" " * 8])
    white = WHITE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(white[1:] != white[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
    w = hashes.of(data, starts, ends)
    first = (np.cumsum(counts) - counts)[counts > 0]
    v, u = np.roll(w, 1), np.roll(w, 2)
    v[first] = u[first] = START
    second = first + 1
    u[second[second < len(w)]] = START
    return u, v, w, counts


def join_key(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit key for tuples of hashes; equal keys of unequal tuples are as rare as hash collisions."""
    out = np.zeros(len(parts[0]), np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            out = (out ^ part.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


#: The first bits of a key say its shard.
HEAD = np.uint64(0xFFFFF << 44)


def gram_keys(*parts: np.ndarray, context: np.ndarray | None = None) -> np.ndarray:
    """``join_key`` of n-grams of any order: the order is a part, so that no two orders share keys.

    A triple's begins as that of its first two words (``context``, if known), so they have a shard.
    """
    keys = join_key(np.full(len(parts[0]), len(parts), np.int64), *parts)
    if len(parts) < 3:
        return keys
    return ((gram_keys(*parts[:2]) if context is None else context) & HEAD) | (keys >> np.uint64(20))


@dataclass
class Table:
    """Values by sorted key; a missing key has the given values."""

    keys: np.ndarray
    values: list[np.ndarray]
    missing: list[float]

    @classmethod
    def build(cls, keys: np.ndarray, values: list[np.ndarray], missing: list[float]) -> Table:
        order = np.argsort(keys, kind="stable")
        return cls(keys[order], [v[order].astype(np.float32) for v in values], missing)

    def find(self, keys: np.ndarray) -> list[np.ndarray]:
        if not len(self.keys):
            return [np.full(len(keys), m, np.float32) for m in self.missing]
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys
        return [np.where(known, v[at], np.float32(m)) for v, m in zip(self.values, self.missing, strict=True)]


@dataclass
class KneserNey:
    """Interpolated trigram model: share of an n-gram in its context, and what the context leaves to the order below."""

    words: Table  # share of the word among continuations; weight its bigram context leaves
    pairs: Table  # share; weight its trigram context leaves
    triples: Table  # share
    floor: float  # probability of a word never seen
    key: Callable[..., np.ndarray] = join_key

    def log10(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """log10 p(w | u v)."""
        key = self.key
        one, _ = self.words.find(key(w))
        _, leave_v = self.words.find(key(v))
        two, _ = self.pairs.find(key(v, w))
        _, leave_uv = self.pairs.find(key(u, v))
        three = self.triples.find(key(u, v, w))[0]
        p = three + leave_uv * (two + leave_v * (one + self.floor))
        return np.log10(p, dtype=np.float64)


def discounts(histogram: dict[int, int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more from how many n-grams have counts 1 to 4."""
    n = [histogram.get(i, 0) for i in range(1, 5)]
    if min(n[:2]) == 0:
        return [0.5, 0.75, 1.0]
    y = n[0] / (n[0] + 2 * n[1])
    out = [i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else i + 0.5 for i in range(3)]
    return [min(max(d, 0.1), i + 0.9) for i, d in enumerate(out)]


def packed(values: np.ndarray) -> bytes:
    """The bytes of an array, compressed: their number, then the first bytes of all values, the second ones and so on."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def packed_keys(keys: np.ndarray) -> bytes:
    """``packed`` differences of ascending keys."""
    return packed(np.diff(keys, prepend=keys.dtype.type(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def packed_grams(columns: list[np.ndarray], count: np.ndarray) -> list[bytes]:
    """N-grams, a column of hashes a word: the distinct hashes, the place of each word among them, and a count."""
    words, places = np.unique(np.concatenate(columns), return_inverse=True)
    places = places.astype(np.uint32).reshape(len(columns), -1)
    return [packed_keys(words.view(np.uint64)), *map(packed, places), packed(count)]


def unpacked_grams(data: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    words = unpacked_keys(data[0]).view(np.int64)
    return [words[unpacked(x, np.uint32)] for x in data[1:-1]], unpacked(data[-1], np.int64)


def grouped(columns: list[np.ndarray], sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows of integer columns, ascending, and the sums of their values."""
    order = np.lexsort(columns[::-1])
    columns, sums = [c[order] for c in columns], [x[order] for x in sums]
    if not len(order):
        return columns, sums
    change = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)])
    starts = np.flatnonzero(change)
    return [c[starts] for c in columns], [np.add.reduceat(x, starts) for x in sums]


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """A shard has a range of keys, so that ascending keys lie by shard, and their differences are small."""
    return ((keys >> np.uint64(44)) * np.uint64(shards) >> np.uint64(20)).astype(np.int64)


#: Rows of packed tables: the n-grams of an order (``kind``) in a shard; how many have counts 1, 2, 3 and more, and how many there are.
PACKED = "shard long, kind int, data array<binary>, counts array<long>"


def _packed_rows(kind: int, rows: list[tuple[int, list[bytes], np.ndarray]]) -> pa.RecordBatch:
    counts = [np.bincount(np.minimum(c, 4), minlength=5)[1:].tolist() + [len(c)] for _, _, c in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array([s for s, _, _ in rows], pa.int64()), pa.array([kind] * len(rows), pa.int32()), pa.array([d for _, d, _ in rows], pa.list_(pa.binary())),
         pa.array(counts, pa.list_(pa.int64()))], ["shard", "kind", "data", "counts"])


def _by_shard(kind: int, home: np.ndarray, columns: list[np.ndarray], sums: list[np.ndarray]) -> pa.RecordBatch:
    """A packed row for each shard from the n-grams of all; ``home`` is their shard."""
    rows = []
    order = np.argsort(home, kind="stable")
    shards, starts = np.unique(home[order], return_index=True)
    for shard, mine in zip(shards.tolist(), np.split(order, starts[1:]) if len(order) else [], strict=True):
        rows.append((shard, *_packed(kind, [c[mine] for c in columns], [x[mine] for x in sums])))
    return _packed_rows(kind, rows)


def _packed(kind: int, columns: list[np.ndarray], sums: list[np.ndarray]) -> tuple[list[bytes], np.ndarray]:
    return (packed_grams(columns, sums[0]) if kind > 1 else [packed(x) for x in (*columns, *sums)]), sums[0]


def _unpacked(kind: int, data: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    if kind > 1:
        columns, count = unpacked_grams(data)
        return columns, [count]
    word, *sums = (unpacked(x, np.int64) for x in data)
    return [word], sums


def _merged(parts: DataFrame) -> DataFrame:
    """One packed row for each shard: equal n-grams of its parts are added up."""

    def run(table: pa.Table) -> pa.Table:
        kind, shard = table.column("kind")[0].as_py(), table.column("shard")[0].as_py()
        each = [_unpacked(kind, data) for data in table.column("data").to_pylist()]
        columns, sums = grouped(*([np.concatenate(x) for x in zip(*side, strict=True)] for side in zip(*each, strict=True)))
        return pa.Table.from_batches([_packed_rows(kind, [(shard, *_packed(kind, columns, sums))])])

    return parts.groupBy("shard").applyInArrow(run, PACKED)


class PackedModel:
    """Counts of a model's n-grams, sharded: a table of ``PACKED`` rows in as many buckets as shards.

    Kind 3 are triples, in the shard of their first two words; kind 2 pairs, counted by words before them; kind 1 words: pairs they end, and the sum
    and the numbers of counts 1, 2, 3 and more of the pairs they begin. What an n-gram needs from others is in its own shard or that of its words.
    """

    def __init__(self, spark: SparkSession, shards: int):
        self.spark, self.shards, self.name = spark, shards, f"grams_{uuid.uuid4().hex}"
        self.path = f"{ensure_checkpoint_dir(spark)}/{self.name}"
        self.cuts: dict[int, list[float]] = {}
        self.floor = 1.0
        self.all_pairs = 0

    def add(self, parts: DataFrame) -> None:
        """Merge ``parts`` into the table; they are all parts of their shards and kind."""
        _merged(parts).write.format("parquet").mode("append").option("path", self.path).bucketBy(self.shards, "shard").saveAsTable(self.name)

    def rows(self, kind: int | None = None) -> DataFrame:
        rows = self.spark.table(self.name)
        return rows if kind is None else rows.where(F.col("kind") == kind)

    def counts(self, kind: int) -> list[int]:
        sums = self.rows(kind).agg(*[F.sum(F.col("counts")[i]) for i in range(5)]).first()
        return [x or 0 for x in sums]

    def finish(self) -> None:
        """Discounts of each order, and the probability of a word never seen."""
        for kind in (1, 2, 3):
            *histogram, number = self.counts(kind)
            self.cuts[kind] = [0.0, *discounts(dict(enumerate(histogram, 1)))]
            if kind == 1:
                words, seen = number, histogram
            elif kind == 2:
                self.all_pairs = number
        cut = sum(n * d for n, d in zip((seen[0], seen[1], seen[2] + seen[3]), self.cuts[1][1:], strict=True))
        self.floor = (cut / self.all_pairs if self.all_pairs else 1.0) / (words + 1)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_of(count: np.ndarray, cuts: list[float]) -> np.ndarray:
    return np.array(cuts)[np.minimum(count, 3)]


def shard_tables(rows: list[tuple[int, list[bytes]]], cuts: dict[int, list[float]], all_pairs: int) -> dict[str, tuple[np.ndarray, list[np.ndarray]]]:
    """Ascending ``gram_keys`` of the packed (kind, data) ``rows`` of a shard, and their values: triples (share), contexts
    (what they leave to the order below), pairs (count) and words (share, sum of the pairs they begin, what they leave)."""
    found = {}
    ascending = lambda keys, *values: (keys[order := np.argsort(keys)], [x[order] for x in values])
    for kind, data in rows:
        columns, sums = _unpacked(kind, data)
        if kind == 3:
            u, v, w = columns
            cut = cut_of(sums[0], cuts[3])
            starts = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])]))
            total = np.add.reduceat(sums[0], starts)
            share = (sums[0] - cut) / np.repeat(total, np.diff(np.append(starts, len(u))))
            context = gram_keys(u, v)
            found["triples"] = ascending(gram_keys(u, v, w, context=context), share.astype(np.float32))
            found["contexts"] = ascending(context[starts], (np.add.reduceat(cut, starts) / total).astype(np.float32))
        elif kind == 2:
            found["pairs"] = ascending(gram_keys(*columns), sums[0])
        else:
            count, total, *low = sums
            share = np.where(count > 0, (count - cut_of(count, cuts[1])) / max(1, all_pairs), 0.0)
            leave = np.where(total > 0, sum(n * d for n, d in zip(low, cuts[2][1:], strict=True)) / np.maximum(total, 1), 1.0)
            found["words"] = ascending(gram_keys(columns[0]), share.astype(np.float32), total, leave.astype(np.float32))
    return found


#: Values of n-grams that a model does not know, by ``shard_tables``.
MISSING = {"triples": [np.float32(0)], "contexts": [np.float32(1)], "pairs": [np.int64(0)], "words": [np.float32(0), np.int64(0), np.float32(1)]}


def looked_up(tables: dict[str, tuple[np.ndarray, list[np.ndarray]]], what: str, keys: np.ndarray) -> list[np.ndarray]:
    if what not in tables or not len(tables[what][0]):
        return [np.full(len(keys), m) for m in MISSING[what]]
    names, values = tables[what]
    at = np.searchsorted(names, keys)
    at[at == len(names)] = 0
    known = names[at] == keys
    return [np.where(known, v[at], m) for v, m in zip(values, MISSING[what], strict=True)]


def learned_tables(trusted: DataFrame, text_col: str = "text", shards: int = 1, rounds: int = 1, gathers: int = 1) -> PackedModel:
    """The counts of the words of ``trusted``, a table to be dropped after use.

    Continuation counts (how many words precede an n-gram) take the place of counts below the highest order. Texts are
    written aside in ``gathers`` parts by their hash, then read in ``rounds``, each for a part of the shards, so that what
    brings texts or triples to a task takes a part of their size on disk.
    """
    spark = trusted.sparkSession
    turns = min(rounds, shards)

    def triples(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            columns, sums = grouped([np.concatenate(x) for x in zip(*held, strict=True)], [np.ones(sum(len(x[0]) for x in held), np.int64)])
            return _by_shard(3, shard_of(gram_keys(*columns[:2]), shards), columns, sums)

        for batch in batches:
            for part in slices(batch, 0):
                u, v, w, _ = word_hashes(binary_list(part.column(0)), _HASHES)
                mine = shard_of(gram_keys(u, v), shards) % turns == turn
                held.append([x[mine] for x in (u, v, w)])
                size += len(held[-1][0])
                if size > PIECE_WORDS:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                (_, v, w), _ = unpacked_grams(data)
                columns, sums = grouped([v, w], [np.ones(len(v), np.int64)])
                yield _by_shard(2, shard_of(gram_keys(*columns), shards), columns, sums)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                (v, w), count = unpacked_grams(data)
                none, some = np.zeros(len(v), np.int64), np.ones(len(v), np.int64)
                begun = [count, count == 1, count == 2, count > 2]
                columns, sums = grouped([np.concatenate([w, v])], [np.concatenate([a, b]).astype(np.int64) for a, b in zip([some, *[none] * 4], [none, *begun], strict=True)])
                yield _by_shard(1, shard_of(gram_keys(*columns), shards), columns, sums)

    model = PackedModel(spark, shards)
    with Scratch(spark) as scratch, shuffles_released(spark):
        gathered = [scratch.written(trusted.where(F.pmod(F.xxhash64(text_col), F.lit(gathers)) == turn).select(text_col)) for turn in range(gathers)]
        texts = reduce(DataFrame.unionByName, gathered)
        for turn in range(turns):
            model.add(map_batches(texts, partial(triples, turn=turn), PACKED))
    with shuffles_released(spark):
        model.add(map_batches(model.rows(3).select("data"), pairs, PACKED))
        model.add(map_batches(model.rows(2).select("data"), words, PACKED))
    model.finish()
    return model


def learn(trusted: DataFrame, text_col: str = "text") -> KneserNey:
    """The model of the words of a small ``trusted`` as arrays; ``classify`` leaves the tables sharded."""
    model = learned_tables(trusted, text_col)
    rows = [(r.kind, r.data) for r in model.rows().collect()]
    model.drop()
    tables = shard_tables(rows, model.cuts, model.all_pairs)
    words, pairs = tables.get("words", (np.zeros(0, np.uint64), [np.zeros(0)] * 3)), next((data for kind, data in rows if kind == 2), None)
    two = np.zeros(0, np.uint64)
    share = np.zeros(0)
    if pairs is not None:
        (v, w), count = unpacked_grams(pairs)
        two, share = gram_keys(v, w), (count - cut_of(count, model.cuts[2])) / looked_up(tables, "words", gram_keys(v))[1]
    contexts, leave = tables.get("contexts", (np.zeros(0, np.uint64), [np.zeros(0)]))
    alone = ~np.isin(contexts, two)
    return KneserNey(
        Table.build(words[0], [words[1][0], words[1][2]], [0.0, 1.0]),
        Table.build(np.concatenate([two, contexts[alone]]), [np.concatenate([share, np.zeros(alone.sum())]), np.concatenate([looked_up(tables, "contexts", two)[0], leave[0][alone]])], [0.0, 1.0]),
        Table.build(*tables.get("triples", (np.zeros(0, np.uint64), [np.zeros(0)])), [0.0]),
        model.floor, gram_keys,
    )


_HASHES = Hashes()


def text_size(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first().n


def window_means(logs: np.ndarray, counts: np.ndarray, words_each: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean log10 of each stretch of ``words_each`` words of each text (the last may be shorter), and how many a text has."""
    stretches = -(-counts // words_each)
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), stretches)
    order = np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    starts = first[owner] + order * words_each
    if not len(starts):
        return np.zeros(0), stretches
    lengths = np.diff(np.append(starts, len(logs)))
    return np.add.reduceat(logs, starts) / lengths, stretches


def dealt(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys``, ascending and thus by shard, and where each shard's begin."""
    ranked = np.sort(keys)
    distinct = ranked[np.append(True, ranked[1:] != ranked[:-1])]
    return distinct, np.searchsorted(shard_of(distinct, shards), np.arange(shards + 1))


def placed(keys: np.ndarray) -> np.ndarray:
    """The place of each key among the distinct ones, ascending."""
    order = np.argsort(keys)
    ranked = keys[order]
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(np.append(False, ranked[1:] != ranked[:-1]))
    return at


def block_grams(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Keys of the words, pairs and triples of texts, the place of the word before each word, and how many words each text has.

    As a context a word, or a pair, is the one before. Before a text's first word is START, and START twice; they come after all others.
    """
    u, v, w, counts = word_hashes(texts, _HASHES)
    start = np.full(1, START, np.int64)
    before = np.arange(len(w)) - 1
    before[(np.cumsum(counts) - counts)[counts > 0]] = len(w)
    one = np.append(gram_keys(w), gram_keys(start))
    two = np.append(gram_keys(v, w), gram_keys(start, start))
    return [one, two, gram_keys(u, v, w, context=two[before])], before, counts


def measure(docs: DataFrame, model: PackedModel, deal: str, text_col: str = "text", words_each: int = 8, keep_text: bool = False) -> DataFrame:
    """``docs`` (without ``deal``, and its text unless ``keep_text``), with n_words, log_prob (sum of log10 over the words; 0 for null and empty text),
    stretches of ``words_each`` words, and ``means``, the mean of every stretch; written and read back.

    Blocks of documents, dealt by the hash ``deal``, ask the shards of ``model`` for their distinct n-grams; a shard answers in
    the order it is asked, so answers carry no keys. Blocks take turns (``SCORE_ROUNDS``), and what a turn shuffles goes after it. The
    number of blocks follows the text, so they do not grow; nothing of the tables is broadcast, and buckets are read where they lie.
    """
    added = ("n_words", "log_prob", "stretches", "means")
    kept = [c for c in docs.columns if c not in (text_col, deal, *added)]
    spark, shards, cuts, all_pairs, floor = docs.sparkSession, model.shards, model.cuts, model.all_pairs, model.floor
    blocks = text_size(docs, text_col) // BLOCK_BYTES + 1
    texts = docs.select(text_col, *kept, F.pmod(F.col(deal), F.lit(blocks)).alias("_block"))

    def ask(table: pa.Table) -> pa.Table:
        grams, _, counts = block_grams(binary_list(table.column(0).combine_chunks()))
        grams = [dealt(keys, shards) for keys in grams] if counts.sum() else []
        asked = [s for s in range(shards) if any(cuts[s] < cuts[s + 1] for _, cuts in grams)]
        return pa.table({
            "shard": pa.array(asked, pa.int64()), "_block": pa.array([table.column("_block")[0].as_py()] * len(asked), pa.int64()),
            "keys": pa.array([[packed_keys(keys[cuts[s] : cuts[s + 1]]) for keys, cuts in grams] for s in asked], pa.list_(pa.binary()))})

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        tables = shard_tables(list(zip(known.column("kind").to_pylist(), known.column("data").to_pylist(), strict=True)), cuts, all_pairs) if asked.num_rows else {}
        out = []
        for keys in asked.column("keys").to_pylist():
            one, two, three = map(unpacked_keys, keys)
            out.append([packed(x) for what, wanted in (("words", one), ("pairs", two), ("contexts", two), ("triples", three)) for x in looked_up(tables, what, wanted)])
        return pa.table({"_block": asked.column("_block"), "shard": asked.column("shard"), "values": pa.array(out, pa.list_(pa.binary()))})

    shown = [text_col, *kept] if keep_text else kept
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*shown).schema)

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({c: pa.nulls(0) for c in (*shown, *added)})
        grams, before, counts = block_grams(binary_list(rows.column(0).combine_chunks()))
        logs = np.zeros(0)
        if len(before):
            given = answers.sort_by("shard").column("values").to_pylist()
            kinds = (np.float32, np.int64, np.float32, np.int64, np.float32, np.float32)
            share, total, leave, count, leave_pair, three = (np.concatenate([unpacked(x[i], kind) for x in given]) for i, kind in enumerate(kinds))
            words, pairs, triples = map(placed, grams)
            here, context = words[: len(before)], words[before]
            count = count[pairs[: len(before)]]
            two = np.where(count > 0, (count - cut_of(count, cuts[2])) / np.maximum(total[context], 1), 0.0).astype(np.float32)
            logs = np.log10(three[triples] + leave_pair[pairs[before]] * (two + leave[context] * (share[here] + floor)), dtype=np.float64)
        sums = np.bincount(np.repeat(np.arange(len(counts)), counts), logs, len(counts))
        means, stretches = window_means(logs, counts, words_each)
        ends = np.concatenate([[0], np.cumsum(stretches)])
        last = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(means, pa.float64()))
        return pa.table(dict(zip((*shown, *added), [*(rows.column(c) for c in shown), pa.array(counts), pa.array(sums.astype(np.float64)), pa.array(stretches), last], strict=True)))

    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    schema = f"{fields}, n_words long, log_prob double, stretches long, means array<double>"
    turns = min(SCORE_ROUNDS, -(-blocks // TURN_BLOCKS))
    for turn in range(turns):
        mine = texts.where(F.pmod("_block", F.lit(turns)) == turn)
        asked = mine.groupBy("_block").applyInArrow(ask, "shard long, _block long, keys array<binary>")
        answers = asked.groupBy("shard").cogroup(model.rows().select("shard", "kind", "data").groupBy("shard")).applyInArrow(answer, "_block long, shard long, values array<binary>")
        scored = mine.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(score, schema)
        with shuffles_released(spark):
            scored.write.mode("append").parquet(path)
    return spark.read.schema(scored.schema).parquet(path)


def _bounds(part: DataFrame, by: str, high: float, margin: float, prior_words: int) -> dict:
    """``by`` -> documents, mean log, bound of perplexity, bound of a stretch's mean, bound of the share of rough stretches.

    Quantiles are merged from sketches of the tasks; their rank is right to one in 20,000.
    """
    quantile = lambda column, share: F.percentile_approx(column, share, F.lit(20_000))
    means = part.groupBy(by).agg((-F.sum("log_prob") / F.sum("n_words")).alias("mean"))
    least = part.select(by, F.explode("means").alias("m")).groupBy(by).agg(quantile("m", 1 - high).alias("least"))
    known = part.join(F.broadcast(means), by).join(F.broadcast(least), by)  # a row a language each
    score = (-F.col("log_prob") + prior_words * F.col("mean")) / (F.col("n_words") + prior_words)
    rough = F.size(F.filter("means", lambda m: m < F.col("least"))) / (F.col("stretches") + prior_words)
    rows = known.withColumn("score", score).withColumn("rough", rough).groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.first("mean"), quantile("score", high), F.first("least"), quantile("rough", high)).collect()
    return {r[0]: (r[1], r[2], float(10 ** r[3] * margin), r[4], float(r[5] * margin)) for r in rows}


def classify(
    docs: DataFrame, labels: DataFrame, trusted_docs: int | None = None, high: float = 0.999, margin: float = 1.1,
    prior_words: int = 10, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep_text: bool = False,
) -> DataFrame:
    """``docs`` (without its text unless ``keep_text``) with n_words, perplexity, most, rough_share, most_rough and kept.

    Columns of those names that ``docs`` has are replaced. Trusted are documents with quality 1 and not toxic in
    ``labels``. The model learns from three quarters of each language's, told apart by a hash of their ids. With
    ``trusted_docs`` it learns from fewer: three quarters of so many, shared equally between the languages, and at most
    three quarters of a language's. All other trusted
    documents calibrate. Two thresholds of each language are quantiles ``high`` of its calibration documents times
    ``margin``: ``most`` of the perplexity, and ``most_rough`` of the share of short stretches that are less probable
    than all but 1 - ``high`` of the calibration stretches (a word repeated on and on gives rough stretches even where
    the whole text has an ordinary perplexity). A document is kept if it exceeds neither; one rough stretch alone is no
    evidence. There is no lower bound: copies of what the model learned from are probable, and clean.

    A language with under 50 calibration documents takes the laxer of its own quantiles and those of all; null, and
    a language without any, take those of all. Text without words sits at its
    language's mean and is kept. Without any trusted document nothing can be judged: perplexity is null and every
    row is kept. Labels without a document and null ids are ignored; repeated rows are judged alike.
    """
    spark = docs.sparkSession
    added = ["n_words", "perplexity", "most", "rough_share", "most_rough", "kept"]
    columns = [c for c in docs.columns if c not in added and (keep_text or c != text_col)]
    # columns travel under numbers, so that none can clash with those added here
    number = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    scan = scanned(docs)
    source = scan.select(*[F.col(c).alias(n) for c, n in number.items()])
    text, lang = number[text_col], number[lang_col]
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id")).distinct()
    named = source.select(F.col(number[id_col]).cast("long").alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    trusted = materialized(named.select("id", "lang").join(good, "id"))
    sizes = {r.lang: r.n for r in trusted.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language
    each = float("inf") if trusted_docs is None else trusted_docs * 3 / 4 / max(1, len(sizes))
    shares = F.broadcast(spark.createDataFrame([(x, min(0.75, each / n)) for x, n in sizes.items()], "of string, part double"))
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    learned = materialized(trusted.join(shares, F.col("lang").eqNullSafe(F.col("of"))).where(draw < F.col("part")).select("id").distinct())
    size = text_size(source, text)
    rounds, wanted, gathers = min(LEARN_ROUNDS, size // BLOCK_BYTES + 1), F.broadcast(learned), 1
    if learned.count() > BROADCAST_IDS:
        wanted, gathers = learned, rounds  # the join shuffles the texts
    model = learned_tables(named.join(wanted, "id").select("text"), "text", size // 3 // SHARD_GRAMS + 1, rounds, gathers)
    measured = measure(source.withColumn("_row", F.xxhash64(row_number_of(scan))), model, "_row", text, keep_text=keep_text)
    model.drop()
    worded = measured.where("n_words > 0").select(
        F.col(number[id_col]).cast("long").alias("id"), F.col(lang).alias("lang"), "n_words", "log_prob", "stretches", "means", F.lit("all").alias("everywhere")
    ).join(good, "id")
    calibration = materialized(worded.join(learned, "id", "left_anti"))
    if not calibration.limit(1).count():  # too few trusted documents for both
        calibration = materialized(worded)
    shown = [*[F.col(number[c]).alias(c) for c in columns], *added]
    pooled = _bounds(calibration, "everywhere", high, margin, prior_words).get("all")
    if pooled is None:
        scored = measured
        for name in ("perplexity", "most", "rough_share", "most_rough"):
            scored = scored.withColumn(name, F.lit(None).cast("double"))
        return scored.withColumn("kept", F.lit(True)).select(*shown)
    table = []
    for known_lang, (n, mean, most, least, rough) in _bounds(calibration.where("lang IS NOT NULL"), "lang", high, margin, prior_words).items():
        if n < 50:
            most, least, rough = max(most, pooled[2]), min(least, pooled[3]), max(rough, pooled[4])
        table.append((known_lang, mean, most, least, rough))
    known = F.broadcast(spark.createDataFrame(table, "known string, mean double, most double, least double, most_rough double"))  # a row a language
    judged = measured.join(known, F.col(lang) == F.col("known"), "left")
    for name, value in zip(("mean", "most", "least", "most_rough"), pooled[1:], strict=True):
        judged = judged.withColumn(name, F.coalesce(name, F.lit(value)))
    judged = judged.withColumn("rough", F.size(F.filter("means", lambda m: m < F.col("least"))))
    score = (-F.col("log_prob") + prior_words * F.col("mean")) / (F.col("n_words") + prior_words)
    judged = judged.withColumn("perplexity", F.pow(F.lit(10.0), score)).withColumn("rough_share", F.col("rough") / (F.col("stretches") + prior_words))
    fits = (F.col("perplexity") <= F.col("most")) & ((F.col("rough") < 2) | (F.col("rough_share") <= F.col("most_rough")))
    return judged.withColumn("kept", fits).select(*shown)
