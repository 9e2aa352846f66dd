"""Exact top-k search by integer inner products, a block at a time (operator 11).

A vector is a document whose terms are its components, as integers. Documents are put in an order in which
those of equal strongest terms stand together, and cut into ranges, the blocks. A block keeps its
documents as rows of term weights (its forward index) and the largest and smallest weight of each term; the maxima
a query's terms can reach, summed, bound every score in the block. A query visits blocks by falling bound
and stops when a bound falls below its k-th score; a block that can only tie is left out if its ids are all larger.

Blocks lie in shards of ``shard_blocks``. First each query meets the bounds of all shards (a pair of vectors
a shard) and is scored in the few shards of highest bound; that sets a k-th score for it. Then it goes to
the other shards whose bound still reaches that score, and to no others. Shards and queries meet by key, a shard with
many queries in several pieces, so the work is dealt in bounded tasks whatever the data; nothing is left out, as
every shard either is scored or cannot hold one of the k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import map_batches, materialized

#: Weights and scores beyond these are cut to them.
MOST_WEIGHT, MOST_SCORE = 2**31 - 1, 2**63 - 1
#: Shard bytes of forward index; long vectors make shards of fewer documents.
SHARD_BYTES = 8 << 20


def integer_terms(column: pa.Array, scale: float) -> list[bytes | None]:
    """floor(scale * x) of each row's components as little-endian 32-bit integers; None if the row takes no part."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    holes = flat.is_null().to_numpy(zero_copy_only=False)
    x = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    bad = holes | ~np.isfinite(x)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.clip(np.nan_to_num(np.floor(scale * x)), -MOST_WEIGHT, MOST_WEIGHT).astype("<i4")
    stops = np.concatenate([[0], np.cumsum(lengths)])
    spoilt = np.concatenate([[0], np.cumsum(bad)])
    spoilt = spoilt[stops[1:]] > spoilt[stops[:-1]]
    null = lists.is_null().to_numpy(zero_copy_only=False)
    return [None if null[i] or spoilt[i] else whole[stops[i] : stops[i + 1]].tobytes() for i in range(len(lists))]


def weights(rows: list[bytes], width: int) -> np.ndarray:
    """Term weights of rows as doubles; missing terms weigh nothing, terms beyond ``width`` are cut off."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        got = np.frombuffer(row, "<i4")[:width]
        out[i, : len(got)] = got
    return out


def strongest_terms(w: np.ndarray, most: int = 4) -> np.ndarray:
    """A number for each row that names its strongest terms, their signs included, strongest first."""
    code = np.zeros(len(w), np.int64)
    order = np.argsort(-np.abs(w), axis=1, kind="stable")[:, :most]
    for place in range(most):
        code <<= 15
        if place < order.shape[1]:
            at = order[:, place]
            code += np.minimum(2 * at + (w[np.arange(len(w)), at] < 0), 2**15 - 1)
    return code


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``: doubles where all sums fit them, else Python integers."""
    largest = [float(np.abs(x).max(initial=0)) for x in (a, b)]
    if largest[0] * largest[1] * max(1, a.shape[1]) < 2.0**53:
        return a @ b.T
    whole = [np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (a, b)]
    out = np.empty((len(a), len(b)), object)
    for i, row in enumerate(whole[0]):
        for j, other in enumerate(whole[1]):
            out[i, j] = max(-MOST_SCORE, min(MOST_SCORE, sum(x * y for x, y in zip(row, other, strict=True))))
    return out


class Shard:
    """Consecutive blocks of documents: forward index, and by block the extreme weights of each term and the least id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, block_rows: int) -> None:
        self.ids, self.rows = ids, rows
        self.cuts = list(range(0, len(ids), block_rows)) + [len(ids)]
        self.high = np.maximum.reduceat(rows, self.cuts[:-1], axis=0)
        self.low = np.minimum.reduceat(rows, self.cuts[:-1], axis=0)
        self.least_id = np.minimum.reduceat(ids, self.cuts[:-1])


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each query and pair of rows of ``high`` and ``low``: the summed maxima of the query's terms."""
    return products(np.maximum(queries, 0), high) + products(np.minimum(queries, 0), low)


class Best:
    """The best (score, id) found for one query: at most ``top``, none below what it starts from."""

    __slots__ = ("found", "kth", "kth_id", "top")

    def __init__(self, top: int, kth: float | int, kth_id: int) -> None:
        self.found: list[tuple] = []
        self.kth, self.kth_id, self.top = kth, kth_id, top

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.top:
            scores, ids = (x[np.lexsort((ids, -scores))[: self.top]] for x in (scores, ids))
        found = sorted([*self.found, *zip((-scores).tolist(), ids.tolist(), strict=True)])[: self.top]
        self.found = found
        if len(found) == self.top and (found[-1][0], found[-1][1]) < (-self.kth, self.kth_id):
            self.kth, self.kth_id = -found[-1][0], found[-1][1]


def search_shard(shard: Shard, queries: np.ndarray, query_ids: np.ndarray, least: list[tuple], top: int) -> tuple[list[Best], np.ndarray]:
    """For each query what of the shard is among its ``top``, and how many blocks were scored for it.

    ``least`` holds each query's (k-th score, id) so far, (-inf, any) if it has none.
    """
    best = [Best(top, *start) for start in least]
    bound = bounds(queries, shard.high, shard.low)
    order = np.argsort(-bound, axis=1, kind="stable")
    scored = np.zeros(len(queries), np.int64)
    alive = list(range(len(queries)))
    for turn in range(order.shape[1]):
        visits: dict[int, list[int]] = {}
        still = []
        for q in alive:  # each query's next block; queries that take the same one are scored together
            block = order[q, turn]
            if bound[q, block] < best[q].kth:
                continue
            still.append(q)
            if bound[q, block] > best[q].kth or shard.least_id[block] < best[q].kth_id:
                visits.setdefault(int(block), []).append(q)
        alive = still
        if not alive:
            break
        for block, who in visits.items():
            at, end = shard.cuts[block], shard.cuts[block + 1]
            ids = shard.ids[at:end]
            scores = products(queries[who], shard.rows[at:end])
            kth = np.array([best[q].kth for q in who], scores.dtype)
            scored[who] += 1
            hits = (scores >= kth[:, None]) & (ids[None, :] != query_ids[who][:, None])
            for i in np.flatnonzero(hits.any(axis=1)):
                best[who[i]].add(scores[i][hits[i]], ids[hits[i]])
    return best, scored


def documents(table: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, terms, code) of the rows that take part."""
    source = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where("id IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = integer_terms(batch.column(1), scale)
            kept = [i for i, t in enumerate(terms) if t is not None]
            if not kept:
                continue
            terms = [terms[i] for i in kept]
            code = np.zeros(len(terms), np.int64)
            widths = np.array([len(t) // 4 for t in terms])
            for width in np.unique(widths):
                where = np.flatnonzero(widths == width)
                for at in range(0, len(where), 1024):
                    part = where[at : at + 1024]
                    code[part] = strongest_terms(weights([terms[i] for i in part], int(width)))
            ids = batch.column(0).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(terms, pa.binary()), pa.array(code)], ["id", "terms", "code"])

    return map_batches(source, run, "id long, terms binary, code long")


def _pack(held: list[tuple[int, bytes]], block_rows: int) -> pa.RecordBatch:
    width = max(len(t) for _, t in held) // 4
    ids = np.array([i for i, _ in held], np.int64)
    rows = weights([t for _, t in held], width)
    shard = Shard(ids, rows, block_rows)
    high, low = (x.astype("<i4").tobytes() for x in (shard.high.max(axis=0), shard.low.min(axis=0)))
    made = [[len(ids)], [width], [ids.astype("<i8").tobytes()], [rows.astype("<i4").tobytes()], [high], [low], [int(ids.min())]]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(m, k) for m, k in zip(made, kinds, strict=True)], ["n", "width", "ids", "rows", "high", "low", "least_id"])


def build_index(table: DataFrame, id_col: str, vector_col: str, scale: float, block_rows: int, shard_blocks: int) -> DataFrame:
    """A row a shard: (shard, n, width, ids, rows, high, low, least_id), in a written table."""
    docs = materialized(documents(table, id_col, vector_col, scale)).withColumn("row", F.monotonically_increasing_id())
    most = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("terms") + 24).alias("bytes")).first()
    shard_rows = block_rows * shard_blocks
    # several shards in a partition; equal rows are told apart by their number, so no range outgrows the others
    ranges = max(1, -(-most["n"] // (4 * shard_rows)), -(-(most["bytes"] or 0) // (4 * SHARD_BYTES)))
    ordered = docs.repartitionByRange(ranges, "code", "id", "row").sortWithinPartitions("code", "id", "row").select("id", "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        widest = 0
        for batch in batches:
            for i, terms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                widest = max(widest, len(terms))
                if held and (len(held) == shard_rows or (len(held) + 1) * widest > SHARD_BYTES):
                    yield _pack(held, block_rows)
                    held, widest = [], len(terms)
                held.append((i, terms))
        if held:
            yield _pack(held, block_rows)

    shards = map_batches(ordered, run, "n int, width int, ids binary, rows binary, high binary, low binary, least_id long")
    return materialized(shards.select(F.monotonically_increasing_id().alias("shard"), "*"))


def _met(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of both, those of ``right`` marked ``asks``: one partition for equal keys, ``left`` rows first."""
    both = left.withColumn("asks", F.lit(False)).unionByName(right.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    return both.repartition(*keys).sortWithinPartitions(*keys, "asks")


def shard_bounds(index: DataFrame, asked: DataFrame, shards: int, queries: int, batch: int = 1024) -> DataFrame:
    """(q, shard, bound, least_id): each query's bound for each shard that may hold a candidate."""
    session = index.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), 1)
    # shards and queries in batches; at least as many as there are tasks, so that few queries are dealt too
    shard_batches = max(1, -(-shards // batch))
    query_batches = max(1, -(-queries // (8 * batch)), min(queries, tasks // shard_batches))
    deal = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.select("shard", "width", "high", "low", "least_id").withColumn("sb", deal("shard", shard_batches)).withColumn("qb", all_of(query_batches))
    right = asked.select("q", "terms").withColumn("qb", deal("q", query_batches)).withColumn("sb", all_of(shard_batches))
    keys = ("qb", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, known, high, low = None, [], None, None
        for batch in batches:
            columns = batch.to_pydict()
            asking: list[int] = []

            def answer() -> Iterator[pa.RecordBatch]:
                nonlocal high, low
                if not asking or not known:
                    return
                width = max(k[1] for k in known)
                if high is None:
                    high, low = weights([k[2] for k in known], width), weights([k[3] for k in known], width)
                bound = bounds(weights([columns["terms"][i] for i in asking], width), high, low)
                flat = [max(-MOST_SCORE, min(MOST_SCORE, int(b))) for row in bound for b in row]
                q = np.repeat([columns["q"][i] for i in asking], len(known))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int64()), pa.array([k[0] for k in known] * len(asking), pa.int64()), pa.array(flat, pa.int64()),
                     pa.array([k[4] for k in known] * len(asking), pa.int64())], ["q", "shard", "bound", "least_id"])

            for i in range(batch.num_rows):
                here = (columns["qb"][i], columns["sb"][i])
                if here != unit:
                    yield from answer()
                    unit, known, high, low = here, [], None, None
                    asking.clear()
                if columns["asks"][i]:
                    asking.append(i)
                    if len(asking) == 256:
                        yield from answer()
                        asking.clear()
                else:
                    known.append([columns[c][i] for c in ("shard", "width", "high", "low", "least_id")])
            yield from answer()

    return map_batches(_met(left, right, keys), run, "q long, shard long, bound long, least_id long")


def score_pairs(index: DataFrame, asked: DataFrame, pairs: DataFrame, pieces: int, top: int, block_rows: int) -> DataFrame:
    """(q, id, score) of the best of each shard for each pair (q, shard, kth, kth_id); a row of null id has the blocks scored."""
    dealt = pairs.withColumn("piece", F.pmod(F.xxhash64("q"), F.lit(pieces)).cast("int"))
    right = dealt.join(asked.select("q", "query_id", "terms"), "q").select("shard", "piece", "q", "query_id", "terms", "kth", "kth_id")
    units = dealt.select("shard", "piece").distinct()
    left = units.join(index.select("shard", "width", "ids", "rows"), "shard")
    # shard rows are of some MB each: a partition holds a few units, whatever the sizes of other data
    keys = ("shard", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, unit = None, None
        for batch in batches:
            asks = batch.column("asks").to_pylist()
            where = list(zip(batch.column("shard").to_pylist(), batch.column("piece").to_pylist(), strict=True))
            at = 0
            while at < len(asks):
                if not asks[at]:
                    width = batch.column("width")[at].as_py()
                    ids = np.frombuffer(batch.column("ids")[at].as_py(), "<i8")
                    rows = np.frombuffer(batch.column("rows")[at].as_py(), "<i4").reshape(len(ids), width).astype(np.float64)
                    shard, unit = Shard(ids, rows, block_rows), where[at]
                    at += 1
                    continue
                end = at
                while end < len(asks) and asks[end] and where[end] == unit and end - at < 2048:
                    end += 1
                part = batch.slice(at, end - at).to_pydict()
                least = [(-np.inf, MOST_SCORE) if k is None else (k, i) for k, i in zip(part["kth"], part["kth_id"], strict=True)]
                asked_terms = weights(part["terms"], shard.rows.shape[1])
                best, scored = search_shard(shard, asked_terms, np.array(part["query_id"], np.int64), least, top)
                q = [x for x, b in zip(part["q"], best, strict=True) for _ in b.found] + part["q"]
                ids = [f[1] for b in best for f in b.found] + [None] * len(best)
                scores = [-int(f[0]) for b in best for f in b.found] + scored.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], ["q", "id", "score"])
                at = end

    return map_batches(_met(left, right, keys), run, "q long, id long, score long")


def search(
    table: DataFrame, queries: DataFrame, top: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding",
    block_rows: int = 128, shard_blocks: int = 64, first: int = 2, piece_queries: int = 8192, work: bool = False,
) -> DataFrame:
    """(query_id, rank, <id_col>, score): for each row of ``queries`` the ``top`` largest integer inner products in ``table``.

    Terms are floor(scale * component), in double precision, cut to 32 bits; scores are exact, cut to 64 bits. Rows of
    null id, and vectors that are null or hold null or non-finite components, take no part; missing components
    of a shorter vector weigh nothing, so empty and zero vectors score 0. A row of the query's own id is no candidate.
    Every other row is one, so a repeated row is listed as often as it occurs; equal query rows ask once, unlike rows
    of one query id each on their own. Ties go to the smaller id. An empty table gives no rows. With ``work``,
    a last column tells how many blocks were scored for the query.
    """
    index = build_index(table, id_col, vector_col, scale, block_rows, shard_blocks)
    wanted = documents(queries, id_col, vector_col, scale).select(F.col("id").alias("query_id"), "terms").distinct()
    asked = materialized(wanted.repartition("query_id", "terms")).withColumn("q", F.monotonically_increasing_id())
    n_shards, n_queries = index.count(), asked.count()  # two numbers
    pieces = max(1, -(-n_queries // piece_queries))
    bound = materialized(shard_bounds(index, asked, n_shards, n_queries))
    ranked = bound.withColumn("turn", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bound"), "shard")))
    nothing = F.lit(None).cast("bigint")
    opening = ranked.where(F.col("turn") <= first).select("q", "shard", nothing.alias("kth"), nothing.alias("kth_id"))
    found = materialized(score_pairs(index, asked, opening, pieces, top, block_rows))
    if n_shards > first:
        so_far = _ranked(found).where(F.col("rank") == top).select("q", F.col("score").alias("kth"), F.col("id").alias("kth_id"))
        rest = ranked.where(F.col("turn") > first).join(so_far, "q", "left")
        reaches = F.col("kth").isNull() | (F.col("bound") > F.col("kth")) | ((F.col("bound") == F.col("kth")) & (F.col("least_id") < F.col("kth_id")))
        closing = rest.where(reaches).select("q", "shard", "kth", "kth_id")
        found = found.unionByName(materialized(score_pairs(index, asked, closing, pieces, top, block_rows)))
    names = asked.select("q", "query_id")
    result = _ranked(found).where(F.col("rank") <= top).join(names, "q")
    if work:
        done = found.where("id IS NULL").groupBy("q").agg(F.sum("score").alias("blocks_scored"))
        return result.join(done, "q").select("query_id", "rank", F.col("id").alias(id_col), "score", "blocks_scored")
    return result.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _ranked(found: DataFrame) -> DataFrame:
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return found.where("id IS NOT NULL").withColumn("rank", F.row_number().over(best))
