"""Mixing sources to target weights by Sainte-Lague apportionment (operator 7), in DataFrame operations only.

Targets: sources in code point order (null last) weigh 1, 2, 3, repeating, and share all words by
weight; no target exceeds ``most`` times its source, and the excess is shared again by weight.

Quotas: words are counted in blocks of equal length. For every output shard, the blocks up to and
including it go to the sources with the highest quotients target / (2k + 1); a shard's quota is the
difference to the shard before. A source's seats can differ from its exact share by a known factor
only, so the quotients that could win or lose are a few for each source; the rest are not listed.

Selection: a source's documents, in seeded order, form a ring of words, cut into blocks. A keyed permutation gives each
block its place in the source's order, row by row and without a sort; seat i of a source takes the block at place
i mod blocks, so every block is taken once before any is taken again. The seats of a shard are those its quota gives it.
A document's share is the sum over the blocks it reaches into.

One row a source and shard is ordered in one task, so sources (not documents) must be fewer than some hundred
thousand. Documents are ordered by source and one of ``BUCKETS`` hash buckets, so a source that holds a third of
all rows spreads over all of them; rows of one id and size are counted in ``SALTS`` cells before they are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import WORD, materialized, row_number_of, scanned
from prefspark.operators.logsumexp import let
from prefspark.operators.permute import permuted

BUCKETS = 4096
SALTS = 256
WEIGHTS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _source_key(source: str) -> Column:
    """Never null, and in code point order with null last."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("t"))


def targets(totals: DataFrame, most: int = 3) -> DataFrame:
    """Add ``pos`` (1-based order), ``weight`` and ``target`` to ``totals`` (src, source_size): a row a source."""
    ordered = totals.withColumn("pos", F.row_number().over(Window.orderBy("src")))
    weighed = ordered.withColumn("weight", ((F.col("pos") - 1) % WEIGHTS + 1).cast("bigint"))
    everything = Window.partitionBy(F.lit(1))
    filling = Window.partitionBy(F.lit(1)).orderBy("ratio", "pos")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    full = (most * F.col("source_size")).cast("bigint")
    # sources in the order in which they reach their cap; level: the share of one weight if all before are capped
    levels = (
        weighed.withColumn("ratio", full.cast("double") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum(full).over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("rest").cast("double") / F.col("open"))
        .withColumn("fits", F.col("ratio") >= F.col("level"))
    )
    first = F.min(F.when(F.col("fits"), F.struct("ratio", "pos", "level"))).over(everything)
    return levels.withColumn("share", first["level"]).select(
        "src", "source_size", "pos", "weight", "total",
        F.least(full.cast("double"), F.col("share") * F.col("weight")).alias("target"),
    )


def quotas(aimed: DataFrame, shards: int = 8, block_words: int = 256) -> DataFrame:
    """(src, shard, quota, upto, block): Sainte-Lague seats of ``aimed`` (result of ``targets``).

    A block has ``block_words`` words, fewer if the smallest positive target has under 64 such blocks.
    """
    everything = Window.partitionBy(F.lit(1))
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything)
    voters = (
        aimed.where("target > 0")
        .withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(smallest / 64))).cast("bigint"))
        .withColumn("houses", F.floor(F.col("total") / F.col("block") + F.lit(0.5)).cast("bigint"))
        .withColumn("n", F.count(F.lit(1)).over(everything))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .withColumn("house", F.floor(F.col("houses") * (F.col("shard") + 1) / shards).cast("bigint"))
    )
    exact = F.col("target") * F.col("house") / F.sum("target").over(Window.partitionBy("shard"))
    slack = F.when(F.col("house") > 0, F.col("n") / (2 * F.col("house"))).otherwise(F.lit(0.0))
    ranged = (
        voters.withColumn("q", exact)
        .withColumn("low", F.greatest(F.lit(0), F.floor(F.col("q") * (1 - slack) - 0.5) - 1).cast("bigint"))
        .withColumn("high", (F.ceil(F.col("q") * (1 + slack) + 0.5) + 1).cast("bigint"))
        .withColumn("open", F.col("house") - F.sum("low").over(Window.partitionBy("shard")))
    )
    rivals = ranged.withColumn("k", F.explode(F.sequence(F.col("low"), F.col("high")))).withColumn(
        "quotient", F.col("target") / (2 * F.col("k") + 1)
    )
    best = Window.partitionBy("shard").orderBy(F.desc("quotient"), "pos", "k")
    seats = (
        rivals.withColumn("won", (F.row_number().over(best) <= F.col("open")).cast("bigint"))
        .groupBy("src", "shard").agg((F.max("low") + F.sum("won")).alias("upto"), F.max("block").alias("block"))
    )
    previous = F.lag("upto", 1, 0).over(Window.partitionBy("src").orderBy("shard"))
    return seats.select("src", "shard", (F.col("upto") - previous).alias("quota"), "upto", "block")


def mix(
    docs: DataFrame, size: str | Column, source_col: str = "source", id_col: str = "doc_id",
    shards: int = 8, block_words: int = 256, most: int = 3, seed: int = 42,
) -> DataFrame:
    """``docs`` with source_size, target, laps, cuts, shard_words and taken (existing columns of these names are replaced).

    A document gives its words ``laps`` times, and once more those inside ``cuts`` (an array of structs ``a``, ``b``:
    0-based, end excluded, ascending); taken = laps * size + the lengths of the cuts. ``shard_words`` splits taken by
    the shard whose seats take the blocks. Documents without words, and all documents if none has words, take 0.
    A null source is a source of its own, the last. Null ids and repeated rows take their place in the seeded order
    like any other; which of several rows of one id and size is cut is left open. An empty table stays empty.

    ``size`` is a column of ``docs`` or an expression on its columns. Only row numbers, keys and sizes are ordered, from a narrow
    table in the shared folder; ``docs`` is written there too unless it is a plain scan of files.
    """
    added = ("source_size", "target", "laps", "cuts", "shard_words", "taken")
    kept = [c for c in docs.columns if c not in added]
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    size = (F.col(size) if isinstance(size, str) else size).cast("bigint")
    lying = scanned(docs)
    narrow = materialized(lying.select(
        row_number_of(lying).alias("row_no"), size.alias("size"), _source_key(source_col).alias("src"),
        F.md5(F.concat_ws(":", ident, size.cast("string"), F.lit(str(seed)))).alias("draw"),
    ))
    cell = ["src", "bucket", "draw", "size", "salt"]
    keyed = (
        narrow.withColumn("bucket", F.conv(F.substring("draw", 1, 3), 16, 10).cast("int"))
        .withColumn("salt", F.pmod(F.xxhash64("row_no"), F.lit(SALTS)).cast("int"))
    )
    cells = keyed.groupBy(*cell).agg((F.count(F.lit(1)) * F.col("size")).alias("cell_size"))
    buckets = keyed.groupBy("src", "bucket").agg(F.sum("size").alias("bucket_size"))
    aimed = targets(buckets.groupBy("src").agg(F.sum("bucket_size").cast("bigint").alias("source_size")), most)
    seats = quotas(aimed, shards, block_words).groupBy("src").agg(
        F.array_sort(F.collect_list("upto")).alias("upto"), F.max("block").alias("block"))  # a number a shard; upto rises with it
    # a row a source
    plans = (
        aimed.join(seats, "src", "left").na.fill(1, ["block"])
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.col("block"))).cast("bigint"))
        .withColumn("upto", F.transform(
            F.coalesce("upto", F.array_repeat(F.lit(0).cast("bigint"), shards)), lambda u: F.least(u, most * F.col("blocks"))))
        .withColumn("seats", F.element_at("upto", -1))
        .select("src", "source_size", "target", "block", "blocks", "upto", "seats")
    )
    so_far = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("src", "bucket", F.coalesce(F.sum("bucket_size").over(so_far), F.lit(0)).alias("offset"))
    ahead = Window.partitionBy("src", "bucket").orderBy("draw", "salt").rowsBetween(Window.unboundedPreceding, -1)
    begins = cells.withColumn("begin", F.coalesce(F.sum("cell_size").over(ahead), F.lit(0))).drop("cell_size")
    nth = F.row_number().over(Window.partitionBy(*cell).orderBy("row_no")) - 1
    placed = (
        keyed.join(begins, cell).withColumn("nth", nth).join(offsets, ["src", "bucket"]).join(plans, "src")
        .withColumn("at", F.col("offset") + F.col("begin") + F.col("nth") * F.col("size"))
    )

    def reached(b: Column) -> Column:
        ends = F.least((b + 1) * F.col("block") - F.col("at"), "size")
        place = permuted(b, F.col("blocks"), seed, F.col("src"))
        return F.struct(F.greatest(b * F.col("block") - F.col("at"), F.lit(0).cast("bigint")).alias("a"), ends.alias("b"), place.alias("place"))

    whole = lambda x, y: F.floor(x / y).cast("bigint")
    numbers = F.sequence(whole(F.col("at"), F.col("block")), whole(F.col("at") + F.col("size") - 1, F.col("block")))
    touched = F.when((F.col("size") > 0) & (F.col("seats") > 0), F.transform(numbers, reached))
    # seats before x that take the block at a place
    times = lambda x, place: whole(x + F.col("blocks") - 1 - place, F.col("blocks"))
    none = F.lit(0).cast("bigint")
    before = lambda u: F.aggregate("touched", none, lambda sum_, t: sum_ + (t["b"] - t["a"]) * times(u, t["place"]))
    rising = F.transform("upto", before)
    per_shard = lambda r: F.transform(r, lambda v, i: v - F.when(i > 0, F.get(r, i - 1)).otherwise(none))
    extra = F.filter("touched", lambda t: t["place"] < F.col("seats") - F.col("laps") * F.col("blocks"))
    found = (
        placed.withColumn("touched", F.coalesce(touched, F.array().cast("array<struct<a:bigint,b:bigint,place:bigint>>")))
        .withColumn("laps", F.when(F.col("source_size") > 0, whole(F.col("seats"), F.col("blocks"))).otherwise(none))
        .select(
            "row_no", "source_size", "target", "laps", F.transform(extra, lambda t: F.struct(t["a"], t["b"])).alias("cuts"),
            let(rising, per_shard).alias("shard_words"),
        )
        .withColumn("taken", F.aggregate("shard_words", none, lambda sum_, v: sum_ + v))
    )
    # the row travels as one struct, so that its columns cannot clash with those added here
    rows = lying.select(row_number_of(lying).alias("row_no"), F.struct(*kept).alias("row"))
    return rows.join(found, "row_no").select("row.*", *added)


def take(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The mix itself: each document once a lap, and each stretch of its cuts as a row of its own; the columns of ``mix`` are dropped.

    Cuts that touch are one stretch, and it keeps the white space between its words. Documents of which nothing is taken go.
    """
    added = ("source_size", "target", "laps", "cuts", "shard_words", "taken")
    columns = [c for c in mixed.columns if c not in added]
    stretch = "array<struct<a:bigint,b:bigint>>"

    def grown(done: Column, cut: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["a"].alias("a"), cut["b"].alias("b"))))
        apart = F.concat(done, F.array(cut))
        return F.when(F.size(done) == 0, F.array(cut)).when(last["b"] == cut["a"], longer).otherwise(apart).cast(stretch)

    stretches = F.aggregate("cuts", F.array().cast(stretch), grown)
    words = F.regexp_extract_all(F.col(text_col), F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    text_of = lambda w: F.transform(
        stretches, lambda s: F.array_join(F.slice(w, s["a"].cast("int") + 1, (s["b"] - s["a"]).cast("int")), ""))
    copies = F.array_repeat(F.col(text_col), F.col("laps").cast("int"))
    pieces = F.when(F.size("cuts") == 0, copies).otherwise(F.concat(copies, let(words, text_of)))
    own = [F.col("piece").alias(c) if c == text_col else F.col(c) for c in columns]
    return mixed.where("taken > 0").withColumn("piece", F.explode(pieces)).select(*own)
