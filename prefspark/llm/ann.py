"""Approximate nearest neighbours by learned partitions (operator 8).

Fit, on a bounded sample: a neighbour graph of the sample, a balanced partition of that graph by
recursive bisection (spectral order, cut at the median, improved by gainful swaps), and a small
classifier that learns from a vector how its neighbours spread over the partitions. The fit also finds the
probability mass a query must visit: the least with which sample queries reach the wanted recall of sample rows, both
held out of graph and training. A query the classifier is sure of visits few partitions, an unsure one more.

Search, over all rows: the classifier puts each row into its most probable partition and sends each
query to its several most probable ones. Partitions and their queries are dealt into blocks, so a
partition of any size is many bounded tasks; each reranks by exact double-precision products and keeps
its best few for each query, which are then merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import clean_vectors, group_bounds, map_batches, materialized, vector_matrix, whole_groups


def neighbour_graph(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Undirected edges (a, b) between rows of ``x`` and their ``k`` largest inner products."""
    k = max(0, min(k, len(x) - 1))
    near = np.zeros((len(x), k), np.int64)
    for at in range(0, len(x) if k else 0, 256):  # a few rows at a time: the whole product would fill the driver
        product = x[at : at + 256] @ x.T
        product[np.arange(len(product)), at + np.arange(len(product))] = -np.inf
        near[at : at + 256] = np.argpartition(product, len(x) - k, axis=1)[:, len(x) - k :]
    a, b = np.repeat(np.arange(len(x)), near.shape[1]), near.reshape(-1)
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return both[0], both[1]


def _halves(n: int, a: np.ndarray, b: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Which of two equally large halves (False, True) each of n nodes belongs to, with few edges between them."""
    degree = np.bincount(np.concatenate([a, b]), minlength=n).astype(float) + 1e-9
    v = rng.standard_normal(n)
    for _ in range(60):  # second eigenvector of the lazy random walk
        v -= (v * degree).sum() / degree.sum()
        v = 0.5 * v + 0.5 * (np.bincount(a, v[b], n) + np.bincount(b, v[a], n)) / degree
        v /= np.abs(v).max() + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2 :]] = True
    for _ in range(20):  # swap the best pairs while they gain
        across = side[a] != side[b]
        pull = np.bincount(a, 2.0 * across - 1, n) + np.bincount(b, 2.0 * across - 1, n)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-pull[left], kind="stable")], right[np.argsort(-pull[right], kind="stable")]
        m = min(len(left), len(right))
        good = pull[left[:m]] + pull[right[:m]] > 2
        swaps = max(1, int(good.sum()) // 8)
        if not good.any():
            break
        before = int(across.sum())
        trial = side.copy()
        trial[left[:swaps]], trial[right[:swaps]] = True, False
        if int((trial[a] != trial[b]).sum()) >= before:
            break
        side = trial
    return side


def balanced_parts(n: int, a: np.ndarray, b: np.ndarray, levels: int, seed: int) -> np.ndarray:
    """A part (0 .. 2**levels - 1) for each node: parts differ by a few nodes in size."""
    rng = np.random.default_rng(seed)
    part = np.zeros(n, np.int64)
    for _ in range(levels):
        deeper = part * 2
        for p in np.unique(part):
            members = np.flatnonzero(part == p)
            place = np.full(n, -1)
            place[members] = np.arange(len(members))
            inside = (place[a] >= 0) & (place[b] >= 0)
            deeper[members] += _halves(len(members), place[a[inside]], place[b[inside]], rng)
        part = deeper
    return part


@dataclass
class Router:
    """A classifier of one hidden layer from a vector to partition probabilities."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    mass: float  # a query visits its most probable partitions until they have this probability

    def scores(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def order(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Partitions of each row by falling probability, and the probability of those before each."""
        z = self.scores(x)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        order = np.argsort(-p, axis=1, kind="stable")
        sorted_p = np.take_along_axis(p, order, axis=1)
        return order, np.cumsum(sorted_p, axis=1) - sorted_p

    @property
    def parts(self) -> int:
        return len(self.b2)


def fit(sample: np.ndarray, parts: int, seed: int, recall: float, neighbours: int = 10, top: int = 20, hidden: int = 128) -> Router:
    """Graph, partition, classifier and mass to visit from the rows of ``sample``."""
    n, width = sample.shape
    rng = np.random.default_rng(seed)
    levels = 0
    while 2 ** (levels + 1) <= parts and n // 2 ** (levels + 1) >= 64:
        levels += 1
    count = 2**levels
    held = rng.permutation(n)[: n // 4] if levels else np.zeros(0, np.int64)
    used = np.setdiff1d(np.arange(n), held)
    x = sample[used]
    a, b = neighbour_graph(x, neighbours)
    part = balanced_parts(len(x), a, b, levels, seed)
    wanted = np.zeros((len(x), count))
    np.add.at(wanted, (a, part[b]), 1.0)
    np.add.at(wanted, (b, part[a]), 1.0)
    wanted[np.arange(len(x)), part] += neighbours / 2
    wanted /= wanted.sum(axis=1, keepdims=True)
    router = Router(rng.standard_normal((width, hidden)) * np.sqrt(2 / width), np.zeros(hidden),
                    rng.standard_normal((hidden, count)) * 0.01, np.zeros(count), 2.0)
    if count > 1:
        _train(router, x, wanted, rng)
        router.mass = _mass(router, sample[held], top, recall)
    return router


def _train(router: Router, x: np.ndarray, wanted: np.ndarray, rng: np.random.Generator, epochs: int = 40, batch: int = 256) -> None:
    """Cross entropy to the neighbours' spread, by Adam."""
    unit = x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)
    names = ("w1", "b1", "w2", "b2")
    state = {k: (np.zeros_like(getattr(router, k)), np.zeros_like(getattr(router, k))) for k in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(unit))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            u, y = unit[rows], wanted[rows]
            h = np.maximum(u @ router.w1 + router.b1, 0)
            z = h @ router.w2 + router.b2
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            dz = (p - y) / len(rows)
            dh = (dz @ router.w2.T) * (h > 0)
            grads = {"w1": u.T @ dh + 1e-4 * router.w1, "b1": dh.sum(axis=0), "w2": h.T @ dz + 1e-4 * router.w2, "b2": dz.sum(axis=0)}
            step += 1
            for k in names:
                m, v = state[k]
                m += 0.1 * (grads[k] - m)
                v += 0.01 * (grads[k] ** 2 - v)
                change = 3e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
                setattr(router, k, getattr(router, k) - change)


def _mass(router: Router, held: np.ndarray, top: int, recall: float) -> float:
    """The least mass with which held-out rows find the share ``recall`` of their nearest held-out rows."""
    order, before = router.order(held)
    place = np.argsort(order, axis=1)  # place[q, p]: how many partitions come before p
    product = held @ held.T
    np.fill_diagonal(product, -np.inf)
    near = np.argsort(-product, axis=1, kind="stable")[:, : min(top, len(held) - 1)]
    needed = np.take_along_axis(before, np.take_along_axis(place, order[:, 0][near], axis=1), axis=1).reshape(-1)
    least = np.sort(needed)[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]
    return float(np.nextafter(least, 2.0))


def parts_for(rows: int, sample_rows: int) -> int:
    """Partitions: the power of two nearest to the root of the rows, as far as the sample has 64 rows for each."""
    return 2 ** max(0, min(round(np.log2(max(1, rows)) / 2), int(np.log2(max(1, sample_rows // 64)))))


def nearest_in_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, top: int):
    """(query id, row id, score) of the ``top`` distinct ids of each query but its own; ties to the smaller id.

    An id with several rows counts once, with its best score.

    A product of matrices picks candidates; the scores returned are sums in one fixed order, so equal vectors tie.
    """
    out_q, out_r, out_s = [], [], []
    order = np.argsort(row_ids, kind="stable")
    rows, row_ids = rows[order], row_ids[order]
    firsts = np.flatnonzero(np.concatenate([[True], row_ids[1:] != row_ids[:-1]]))
    distinct = len(firsts) == len(row_ids)
    norm = np.sqrt((rows * rows).sum(axis=1)).max()
    step = max(1, 4_000_000 // max(1, len(rows)))
    for at in range(0, len(queries), step):
        product = queries[at : at + step] @ rows.T
        for offset, scores in enumerate(product):
            q = at + offset
            scores[row_ids == query_ids[q]] = -np.inf
            ranked = scores if distinct else np.maximum.reduceat(scores, firsts)  # a row of several vectors has its best score
            k = min(top, len(ranked)) - 1
            least = np.partition(ranked, len(ranked) - 1 - k)[len(ranked) - 1 - k]
            slack = 1e-12 * (1 + norm * np.sqrt((queries[q] * queries[q]).sum()))
            close = np.flatnonzero((scores >= least - slack) & (scores > -np.inf))
            exact = (rows[close] * queries[q]).sum(axis=1)
            best = np.argsort(-exact, kind="stable")  # rows are in id order
            if not distinct:
                best = best[np.sort(np.unique(row_ids[close[best]], return_index=True)[1])]
            best = best[:top]
            out_q.append(np.full(len(best), query_ids[q]))
            out_r.append(row_ids[close[best]])
            out_s.append(exact[best])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(out_q, np.int64), join(out_r, np.int64), join(out_s, np.float64)


def routed_rows(
    table: DataFrame, queries: DataFrame, top: int, parts: int | None, sample_rows: int, recall: float, id_col: str, vector_col: str, seed: int,
) -> tuple[DataFrame, int, int] | None:
    """((id, vector, asks, order, visits), width, parts): each row's partition as ``order[0]``, all partitions by falling probability
    of each query (``asks``) and how many of them it visits. None if no vector takes part."""
    source = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.lit(False).alias("asks"))
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.lit(True).alias("asks"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = clean_vectors(batch.column(1))
            keep = [v is not None and batch.column(0)[i].is_valid for i, v in enumerate(vectors)]
            rows = batch.filter(pa.array(keep, pa.bool_()))
            kept = [v for v, k in zip(vectors, keep, strict=True) if k]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(kept, pa.list_(pa.float64())), rows.column(2)], ["id", "vector", "asks"])

    cleaned = map_batches(source.unionAll(asked), clean, "id long, vector array<double>, asks boolean")
    everything = materialized(cleaned.distinct())  # a row repeated near a query must not fill its lists
    draw = F.xxhash64("vector", F.lit(seed))
    drawn = (
        everything.where("NOT asks").select(draw.alias("h"), F.col("vector")).dropDuplicates(["h"])
        .orderBy("h").limit(sample_rows).collect()  # bounded by the parameter
    )
    if not drawn:
        return None
    widths, counts = np.unique([len(r.vector) for r in drawn], return_counts=True)
    width = int(widths[counts.argmax()])
    sample = np.array([r.vector for r in drawn if len(r.vector) == width])
    parts = parts or parts_for(everything.where("NOT asks").count(), sample_rows)
    router = fit(sample, parts, seed, recall, top=top)
    shared = table.sparkSession.sparkContext.broadcast(router)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = shared.value
        for batch in batches:
            rows = batch.filter(pa.compute.equal(pa.compute.list_value_length(batch.column(1)), width))
            if not rows.num_rows:
                continue
            order, before = router.order(vector_matrix(rows.column(1), width))
            asks = rows.column(2).to_numpy(zero_copy_only=False)
            listed = [o.tolist() if q else [int(o[0])] for o, q in zip(order.astype(np.int32), asks, strict=True)]
            visits = (before < router.mass).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(listed, pa.list_(pa.int32())), pa.array(visits, pa.int32())], ["id", "vector", "asks", "order", "visits"])

    routed = map_batches(everything, route, "id long, vector array<double>, asks boolean, order array<int>, visits int")
    return materialized(routed), width, router.parts


def scanned_share(routed: DataFrame) -> float:
    """The share of all pairs of a query and a row that lie in a partition the query visits (``routed``: of ``routed_rows``)."""
    rows = routed.where("NOT asks").groupBy(F.element_at("order", 1).alias("part")).agg(F.count(F.lit(1)).alias("r"))
    asks = routed.where("asks").select(F.explode(F.slice("order", F.lit(1), F.col("visits"))).alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("q"))
    met = rows.join(asks, "part").agg(F.sum(F.col("r") * F.col("q"))).first()[0] or 0
    asking = routed.where("asks").count()
    return met / max(1, asking * (routed.count() - asking))


def search(
    table: DataFrame, queries: DataFrame, top: int = 20, parts: int | None = None, sample_rows: int = 6144, recall: float = 0.93,
    id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 42, block_rows: int = 4096, block_queries: int = 1024,
) -> DataFrame:
    """(query_id, rank, <id_col>, score): the ``top`` nearest rows found for each row of ``queries``.

    Rows and queries whose id is null, or whose vector is null, empty, zero or holds null or non-finite
    components take no part; vectors of another width than most of the sample are never near. A query's own id is left out.
    The sample is the ``sample_rows`` distinct vectors of smallest hash, whatever the table's size: the fit's only bound.
    ``parts`` follows the rows by default (``parts_for``). A query that finds fewer than ``top`` ids in the partitions it
    visits visits all of them. Equal rows count once; an id with several vectors is one neighbour with its best score, and
    one query with the best of each neighbour.
    """
    indexed = routed_rows(table, queries, top, parts, sample_rows, recall, id_col, vector_col, seed)
    if indexed is None:
        return table.sparkSession.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    routed, width, count = indexed
    rows, asked = routed.where("NOT asks").withColumn("part", F.element_at("order", 1)), routed.where("asks")
    found = materialized(_visit(rows, asked, F.slice("order", F.lit(1), F.col("visits")), width, top, block_rows, block_queries))
    counts_ = found.groupBy("query_id").agg(F.countDistinct("id").alias("n"))
    short = asked.join(counts_, F.col("id") == F.col("query_id"), "left").where((F.coalesce("n", F.lit(0)) < top) & (F.col("visits") < count))
    short = materialized(short.select("id", "vector", "order", "visits"))
    rest = F.slice("order", F.col("visits") + 1, F.lit(count) - F.col("visits"))
    found = found.unionAll(_visit(rows, short, rest, width, top, block_rows, block_queries))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    nearest = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    return nearest.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "query_id", "rank", F.col("id").alias(id_col), "score"
    )


def _visit(rows: DataFrame, asked: DataFrame, to: object, width: int, top: int, block_rows: int, block_queries: int) -> DataFrame:
    """(query_id, id, score): the best rows of each query in each block of the partitions it visits."""
    visiting = asked.select("id", "vector", F.explode(to).alias("part"))
    row_blocks = rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("rb"))
    query_blocks = visiting.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("qb"))
    blocks = F.broadcast(row_blocks.join(query_blocks, "part"))  # a row a partition
    # by id and vector, so that an id of many vectors is dealt too; blocks overlap in ids, and the merge counts an id once
    spread = lambda n: F.pmod(F.xxhash64("id", "vector"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt_rows = rows.join(blocks, "part").withColumn("r", spread("rb")).withColumn("q", all_of("qb"))
    dealt_queries = visiting.join(blocks, "part").withColumn("q", spread("qb")).withColumn("r", all_of("rb"))
    columns = ("part", "r", "q", "asks", "id", "vector")
    both = dealt_rows.withColumn("asks", F.lit(False)).select(*columns).unionAll(dealt_queries.withColumn("asks", F.lit(True)).select(*columns))
    keys = ("part", "r", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in whole_groups(batches, keys, 1024):
            for start, end in group_bounds(held, keys):
                group = held.slice(start, end - start)
                asks = group.column("asks").to_numpy()
                ids, vectors = group.column("id").to_numpy(), vector_matrix(group.column("vector"), width)
                if asks.all() or not asks.any():
                    continue
                q, r, s = nearest_in_block(vectors[asks], ids[asks], vectors[~asks], ids[~asks], top)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(r), pa.array(s)], ["query_id", "id", "score"])

    grouped = both.repartition(*keys).sortWithinPartitions(*keys)
    return map_batches(grouped, run, "query_id long, id long, score double")
