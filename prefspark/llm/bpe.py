"""Byte-level BPE encoding and decoding with a two-tier lookup (operator 6).

Tier one resolves whole pre-tokens: a minimal perfect hash over the vocabulary maps a
pre-token's bytes to one slot, whose stored key decides hit or miss. Tier two encodes the
misses: the bytes form a linked list and a heap yields the best adjacent pair, so a
pre-token of n bytes costs O(n log n) however long it is. Decoding is a gather of token
bytes by id.

The vocabulary is read once on the driver and broadcast; it has a fixed size (tens of
thousands of entries) that does not grow with the data. Texts never leave their row, so
nothing shuffles.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from prefspark.llm.common import map_batches

#: Entries in each of a worker's two generations; pre-tokens longer than this many characters are not remembered.
MEMO_ENTRIES = 100_000
MEMO_CHARS = 64
#: The same of an encoder, whose misses cost a heap of merges each: some 70 MB of a worker when full.
ENCODER_ENTRIES = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank from a ``.tiktoken`` file (base64 and rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PerfectHash:
    """Minimal perfect hash (hash and displace) from n byte strings to 0..n-1, with key check.

    Keys are grouped into about n/2 buckets by one half of a 128-bit hash. Buckets are placed
    largest first: the first displacement that sends all its keys to free slots is stored; a
    bucket of one key stores its slot itself, as a negative number. A lookup is one hash, one
    displacement read and one comparison with the stored key.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        if len(set(keys)) != n:
            raise ValueError("keys repeat")
        self.m = max(1, n // 2)
        halves = [self._halves(k) for k in keys]
        buckets: list[list[int]] = [[] for _ in range(self.m)]
        for i, (a, _) in enumerate(halves):
            buckets[a % self.m].append(i)
        self.shift = [0] * self.m
        taken = [-1] * n
        by_size = sorted(range(self.m), key=lambda x: -len(buckets[x]))
        for b in by_size:
            members = buckets[b]
            if len(members) < 2:
                break
            d = 0
            while True:
                slots = {self._slot(halves[i][1], d, n) for i in members}
                if len(slots) == len(members) and all(taken[s] < 0 for s in slots):
                    break
                d += 1
            self.shift[b] = d
            for i in members:
                taken[self._slot(halves[i][1], d, n)] = i
        free = (s for s in range(n) if taken[s] < 0)
        for b in by_size:
            if len(buckets[b]) == 1:
                s = next(free)
                taken[s] = buckets[b][0]
                self.shift[b] = -s - 1
        self.keys = [keys[i] for i in taken]

    @staticmethod
    def _halves(key: bytes) -> tuple[int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        return h >> 64, h & 0xFFFFFFFFFFFFFFFF

    @staticmethod
    def _slot(half: int, d: int, n: int) -> int:
        x = (half + d * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        return (x ^ (x >> 29)) % n

    def find(self, key: bytes) -> int:
        """The slot of ``key``, or -1 if it is not one of the keys."""
        if not self.n:
            return -1
        a, b = self._halves(key)
        d = self.shift[a % self.m]
        s = -d - 1 if d < 0 else self._slot(b, d, self.n)
        return s if self.keys[s] == key else -1


def merge_heap(piece: bytes, ranks: dict[bytes, int], left: list[int] | None = None) -> list[bytes]:
    """Merge adjacent parts of ``piece``, lowest rank first and leftmost on ties, until none is left.

    ``ranks`` names merged strings. With ``left``, the merge of rank r only joins parts of which
    the first has ``left[r]`` bytes. Parts are a doubly linked list over start positions. A heap
    entry packs a pair's rank, start and end into one integer; it is stale, and skipped, once
    either part has changed.
    """
    n = len(piece)
    if n < 2:
        return [piece] if piece else []
    base = n + 1
    square = base * base
    get = ranks.get
    stop = list(range(1, n + 1))  # stop[i]: where the part that starts at i ends; 0 once that part is absorbed
    prev = list(range(-1, n - 1))
    first = [get(piece[i : i + 2]) for i in range(n - 1)]
    heap = [r * square + i * base + i + 2 for i, r in enumerate(first) if r is not None]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        rest = pop(heap) % square
        i, k = rest // base, rest % base
        j = stop[i]
        if not j or j == n or stop[j] != k:
            continue
        stop[i], stop[j] = k, 0
        if k < n:
            prev[k] = i
            e = stop[k]
            r = get(piece[i:e])
            if r is not None and (left is None or left[r] == k - i):
                push(heap, r * square + i * base + e)
        h = prev[i]
        if h >= 0:
            r = get(piece[h:k])
            if r is not None and (left is None or left[r] == i - h):
                push(heap, r * square + h * base + k)
    out, i = [], 0
    while i < n:
        out.append(piece[i : stop[i]])
        i = stop[i]
    return out


@dataclass
class Vocabulary:
    """Ranks of byte strings and the pre-token pattern."""

    ranks: dict[bytes, int]
    pattern: str
    hash: PerfectHash = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.hash = PerfectHash(list(self.ranks))

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        return cls(read_ranks(path), pattern)

    def name(self) -> str:
        """A digest of ranks and pattern: equal vocabularies share a worker's encoder."""
        ranked = sorted(self.ranks.items(), key=lambda x: x[1])
        return xxhash.xxh3_128_hexdigest(repr((self.pattern, ranked)))

    def encoder(self) -> Encoder:
        return Encoder(self)

    def token_table(self) -> tuple[np.ndarray, pa.Array]:
        """Token bytes by id as an Arrow binary array; ids without a token are null."""
        size = max(self.ranks.values(), default=-1) + 1
        table: list[bytes | None] = [None] * size
        for token, rank in self.ranks.items():
            table[rank] = token
        return pa.array(table, pa.binary())


class Memo(dict):
    """Key -> what ``resolve`` gives for it, remembered in two generations of bounded size.

    When the young generation is full, it becomes the old one. What is looked up again in time moves
    back, so frequent keys stay while memory stays bounded, however many keys there are.
    """

    def __init__(self, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.entries, self.old = entries, {}

    def resolve(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.resolve(key)
            if len(key) > MEMO_CHARS:
                return value
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder(Memo):
    """Pre-token (str) -> tuple of ids; a missing entry is resolved by the two tiers and remembered."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(ENCODER_ENTRIES)
        self.ranks = vocabulary.ranks
        self.hash = vocabulary.hash
        self.ids = [self.ranks[k] for k in self.hash.keys]
        self.find_all = regex.compile(vocabulary.pattern).findall

    def resolve(self, pre: str) -> tuple[int, ...]:
        piece = pre.encode()
        slot = self.hash.find(piece)
        if slot >= 0:
            return (self.ids[slot],)
        ranks = self.ranks
        return tuple([ranks[p] for p in merge_heap(piece, ranks)])

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.find_all(text))))


_ENCODERS: dict[str, Encoder] = {}


def worker_encoder(name: str, vocabulary: Callable[[], Vocabulary]) -> Encoder:
    """The encoder of this Python worker: built once for each vocabulary name, then reused by its tasks."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = vocabulary().encoder()
    return _ENCODERS[name]


def encode(df: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "ids", bytes_col: str | None = None) -> DataFrame:
    """Add ``ids_col`` (array<int>): the ids of the whole text. Null text counts as empty: no ids.

    With ``bytes_col``, the ids are decoded in the same pass, as ``decode`` would. Every row stays, in
    its partition; existing columns of these names are replaced.
    """
    kept = [c for c in df.columns if c not in (ids_col, bytes_col)]
    source = df.select(*kept)
    added = [StructField(ids_col, ArrayType(IntegerType(), False), False)]
    if bytes_col:
        added.append(StructField(bytes_col, BinaryType(), True))
    schema = StructType([*source.schema.fields, *added])
    shared = df.sparkSession.sparkContext.broadcast((vocabulary, vocabulary.token_table() if bytes_col else None))
    name = vocabulary.name()
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, table = shared.value
        encoder = worker_encoder(name, lambda: vocabulary)
        for batch in batches:
            for part in slices(batch, at):
                offsets, flat = [0], []
                for text in part.column(at).to_pylist():
                    if text:
                        flat.extend(encoder.encode(text))
                    offsets.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                more = [ids, _join_tokens(ids, table)] if bytes_col else [ids]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], schema.names)

    return map_batches(source, run, schema)


def slices(batch: pa.RecordBatch, at: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece come to about ``most`` bytes (one row at least)."""
    column = batch.column(at)
    if column.nbytes <= most or batch.num_rows <= 1:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), at, most)
    yield from slices(batch.slice(half), at, most)


def decode(df: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add ``bytes_col`` (binary): the bytes the ids stand for. Null ids give null; an unknown id raises."""
    kept = [c for c in df.columns if c != bytes_col]
    source = df.select(*kept)
    schema = StructType([*source.schema.fields, StructField(bytes_col, BinaryType(), True)])
    shared = df.sparkSession.sparkContext.broadcast(vocabulary.token_table())
    at = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            yield pa.RecordBatch.from_arrays([*batch.columns, _join_tokens(batch.column(at), table)], [*kept, bytes_col])

    return map_batches(source, run, schema)


def _join_tokens(ids: pa.ListArray, table: pa.Array) -> pa.Array:
    flat = ids.flatten()
    tokens = table.take(flat)
    if tokens.null_count:
        raise ValueError("an id has no token in this vocabulary")
    ends = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset : tokens.offset + len(tokens) + 1]
    data = memoryview(tokens.buffers()[2] or b"")
    lengths = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    stops = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    null = ids.is_null().to_pylist()
    out = [None if null[r] else bytes(data[ends[stops[r]] : ends[stops[r + 1]]]) for r in range(len(ids))]
    return pa.array(out, pa.binary())
