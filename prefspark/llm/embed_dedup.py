"""Near-duplicate embeddings from randomised-rotation binary codes (operator 9).

A unit vector o is rotated by a random orthogonal matrix and kept as the signs of its coordinates, a
unit code x, with the correction factor c = <x, o>. For another unit vector q, <x, q> / c is an unbiased
estimate of <o, q>. Split q into its part along o and the rest, and the error is at most
sin(o, q) * sqrt(1 - c * c) / c. A pair of cosine t or more thus has an estimate of at least
t - sqrt(1 - t * t) * sqrt(1 - c * c) / c, whatever the rotation: pairs below that bound are out for
certain, and the rest are recomputed exactly from the original vectors.

Equal vectors of a label collapse first. A label's vectors are dealt into blocks, each pair of blocks
is a task, and a task reports counts and a spanning chain of its links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import clean_vectors, group_bounds, map_batches, materialized, vector_matrix, whole_groups
from prefspark.llm.components import connected_components
from prefspark.llm.simhash import merge_labels


@lru_cache(maxsize=8)
def rotation(width: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, width]).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def encode(units: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated unit vectors, and the correction factor of each code."""
    turned = units @ rotation(units.shape[1], seed)
    signs = turned > 0
    factor = np.abs(turned).sum(axis=1) / np.sqrt(units.shape[1])
    return np.packbits(signs, axis=1), factor


def estimate(bits: np.ndarray, factor: np.ndarray, units: np.ndarray, seed: int) -> np.ndarray:
    """Unbiased estimates of all inner products of coded vectors with ``units``."""
    width = units.shape[1]
    signs = np.unpackbits(bits, axis=1, count=width).astype(np.float32) * 2 - 1
    turned = (units @ rotation(width, seed)).astype(np.float32)
    return (signs @ turned.T) / (np.sqrt(width) * factor[:, None]).astype(np.float32)


def least_estimate(factor: np.ndarray, threshold: float) -> np.ndarray:
    """The lower bound of the estimate of any pair of cosine ``threshold`` or more (with room for rounding)."""
    return threshold - np.sqrt(1 - threshold**2) * np.sqrt(np.maximum(0, 1 - factor**2)) / factor - 1e-4


def link_block(x: np.ndarray, y: np.ndarray, bits: np.ndarray, factor: np.ndarray, threshold: float, seed: int, chunk: int = 4_000_000):
    """(row of x, row of y) of all pairs of cosine ``threshold`` or more; ``bits`` and ``factor`` code x."""
    nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    units = y / ny[:, None]
    least = least_estimate(factor, threshold)
    step = max(1, chunk // max(1, len(y)))
    for at in range(0, len(x), step):
        part = slice(at, at + step)
        a, b = np.nonzero(estimate(bits[part], factor[part], units, seed) >= least[part, None])
        for cut in range(0, len(a), 200_000):
            i, j = a[cut : cut + 200_000] + at, b[cut : cut + 200_000]
            cosine = (x[i] * y[j]).sum(axis=1) / (nx[i] * ny[j])
            yield i[cosine >= threshold], j[cosine >= threshold]


def near_duplicates(
    table: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", seed: int = 42, block_rows: int = 2048,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    Rows link if their labels are equal and not null, their vectors have the same number of components and
    the cosine (in double precision) is at least ``threshold``. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing; such a row is its own component and kept. A null id is never a
    component_id. Repeated rows are rows like others: they link with their copies.
    """
    source = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = clean_vectors(batch.column(2))
            shown = [None if v is None else v + 0.0 for v in vectors]  # -0.0 is 0.0
            digest = [None if v is None else xxhash.xxh3_128_digest(v.tobytes()) for v in shown]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digest, pa.binary()),
                 pa.array([None if v is None else len(v) for v in shown], pa.int32()),
                 pa.array(shown, pa.list_(pa.float64()))],
                ["id", "label", "digest", "width", "vector"],
            )

    label_type = source.schema["label"].dataType.simpleString()
    rows = materialized(map_batches(source, clean, f"id long, label {label_type}, digest binary, width int, vector array<double>"))
    distinct = (
        rows.where("digest IS NOT NULL AND label IS NOT NULL").groupBy("label", "digest", "width")
        .agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
        # a vector all of whose rows lack an id is named below all ids
        .withColumn("rep", F.coalesce("least_id", F.lit(-(1 << 62)) - F.abs(F.shiftright(F.xxhash64("label", "digest"), 2))))
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, factors = [], []
            for v in clean_vectors(batch.column("vector")):
                b, f = encode((v / np.sqrt((v * v).sum()))[None, :], seed)
                bits.append(b[0].tobytes())
                factors.append(f[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits, pa.binary()), pa.array(factors, pa.float64())],
                                             [*batch.schema.names, "bits", "factor"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema)
    coded = materialized(map_batches(distinct, code, f"{columns}, bits binary, factor double"))
    sizes = coded.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n"))
    mine = F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int")
    dealt = (
        coded.join(sizes, ["label", "width"]).withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int"))
        .withColumn("part", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(F.xxhash64("label", "width").alias("g"), F.col("label").cast("string").alias("label"), "width",
                F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "rep", "copies", "vector", "bits", "factor")
    )
    keys = ("g", "i", "j")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in whole_groups(batches, keys, 4096):
            for start, end in group_bounds(held, keys):
                group = held.slice(start, end - start)
                names = np.array([f"{a}\0{b}" for a, b in zip(group.column("label").to_pylist(), group.column("width").to_pylist(), strict=True)])
                for name in np.unique(names):  # one, unless hashes of labels meet
                    yield solve(group.filter(pa.array(names == name)))

    def solve(group: pa.Table) -> pa.RecordBatch:
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        part, rep, copies = (group.column(c).to_numpy() for c in ("part", "rep", "copies"))
        width = group.column("width")[0].as_py()
        vectors = vector_matrix(group.column("vector"), width)
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        bits = np.frombuffer(b"".join(group.column("bits").to_pylist()), np.uint8).reshape(len(rep), -1)[left]
        factor = group.column("factor").to_numpy()[left]
        links, labels = np.zeros(len(rep), np.int64), np.arange(len(rep))
        for a, b in link_block(vectors[left], vectors[right], bits, factor, threshold, seed):
            a, b = left[a], right[b]
            a, b = a[a != b], b[a != b]
            np.add.at(links, a, copies[b])
            if i != j:  # within one block each pair comes both ways round
                np.add.at(links, b, copies[a])
            labels = merge_labels(labels, a, b)
        order = np.argsort(labels, kind="stable")
        same = labels[order][1:] == labels[order][:-1]
        some = np.flatnonzero(links)
        a = np.concatenate([rep[some], rep[order[:-1][same]]])
        b = [None] * len(some) + rep[order[1:][same]].tolist()
        n = links[some].tolist() + [None] * int(same.sum())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"])

    blocks = dealt.repartition(*keys).sortWithinPartitions(*keys)
    found = materialized(map_batches(blocks, link, "a long, b long, n long"))
    counts = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("links"))
    reached = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    named = (
        coded.select("label", "digest", "width", "rep", "copies")
        .join(counts, F.col("rep") == F.col("a"), "left").drop("a")
        .join(reached, F.col("rep") == F.col("node"), "left").drop("node")
        .withColumn("root", F.coalesce("component", "rep"))
    )
    real = F.min(F.when(F.col("rep") >= -(1 << 62), F.col("rep")))
    roots = named.groupBy("root").agg(real.alias("component_id"))
    known = named.join(roots, "root").select("label", "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return (
        rows.select("id", "label", "digest").join(known, ["label", "digest"], "left")
        .withColumn("component_id", component)
        .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "component_id",
                F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
    )
