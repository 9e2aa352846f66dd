"""Vocabulary, encode / decode and sequence shaping as table jobs (TK1-TK11, U1).

The pretrained subword tokenizer of the reference is re-aimed as a word vocabulary
table plus an encode join: tokens are exploded with their positions, truncated
*before* the join, looked up (broadcast only when the counted vocabulary is small;
otherwise a shuffle join with the Zipf head salted, see ``_salted_lookup``), and
gathered back per row in position order. A user-supplied encoder plugs in through an Arrow
``pandas_udf`` instead (U1).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.functions.exprs import tokens
from prefspark.functions.workers import worker_cache
from prefspark.operators.indexing import global_index
from prefspark.operators.skew import frequent, lookup

# Special tokens, in id order (pad = 0, unk = 1, bos = 2, eos = 3, then the ChatML markers).
SPECIALS = ("<pad>", "<unk>", "<bos>", "<eos>", "<|im_start|>", "<|im_end|>")
PAD_ID, UNK_ID, BOS_ID, EOS_ID = 0, 1, 2, 3
IGNORE_INDEX = -100
BROADCAST_VOCAB_ROWS = 2_000_000
# Words have no length limit, so a row count alone bounds nothing: broadcasts also have a bound in bytes.
BROADCAST_BYTES = 256 << 20


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def build_vocab(texts: DataFrame, text_col: str = "text", specials: Sequence[str] = SPECIALS,
                min_count: int = 1, max_size: int | None = None) -> DataFrame:
    """TK1: ``(token, id, count)``; specials take ids 0..k-1, then tokens by (count desc, token).

    Counting is a partial + final hash aggregation; ids come from the global ordered
    index (no single-partition window). ``max_size`` bounds the vocabulary including
    specials, like a tokenizer's vocabulary size.
    """
    spark = texts.sparkSession
    counts = (
        texts.select(F.explode(tokens(text_col)).alias("token"))
        .where(~F.col("token").isin(list(specials)))
        .groupBy("token").agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") >= min_count)
    )
    k = len(specials)
    numbered = global_index(counts, [F.col("count").desc(), F.col("token")], "_i")
    if max_size is not None:
        numbered = numbered.where(F.col("_i") < max_size - k)
    words = numbered.select("token", (F.col("_i") + k).cast("int").alias("id"), F.col("count").cast("bigint"))
    special_rows = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("token"), F.lit(i).alias("id"), F.lit(0).cast("bigint").alias("count"))
        for i, s in enumerate(specials)])))
    return special_rows.unionByName(words)


def _small(vocab: DataFrame, max_rows: int) -> bool:
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in vocab.schema if f.dataType.typeName() == "string"]
    width = sum(text, F.lit(16))
    size = vocab.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return size["n"] <= max_rows and size["bytes"] <= BROADCAST_BYTES


def with_table(rows: DataFrame, table: DataFrame, deal: Sequence[str], on: str = "token", max_rows: int = BROADCAST_VOCAB_ROWS) -> DataFrame:
    """``rows`` left-joined with a table of one row per token: broadcast when its counted size is small, else a lookup
    that deals tokens with many rows, and rows without a token, over tasks by the columns ``deal``."""
    if _small(table, max_rows):
        return rows.join(F.broadcast(table), on, "left")
    named = table.withColumnRenamed(on, "_of")
    return lookup(rows, named, [(on, "_of")], deal).drop("_of")


def _salted_lookup(stream: DataFrame, vocab: DataFrame, on: str, keys: Sequence[str], salt_buckets: int,
                   hot_tokens: int) -> DataFrame:
    """Shuffle join of exploded tokens against a vocabulary too large to broadcast.

    Word frequencies are Zipfian: a handful of tokens can hold a large share of all rows
    and would land in one join task. A sketch of the stream (``skew.frequent``) names its ``hot_tokens`` most
    frequent tokens, specials and tokens outside the vocabulary alike -- a set of bounded size,
    broadcast to flag hot rows. Hot rows get a deterministic salt in [0, salt_buckets) from their
    (row, position), as do NULLs, which match nothing; the vocabulary rows of hot tokens are replicated once per
    salt. Every other row keeps salt 0, so the join is exact and only the head is spread.
    """
    hot = frequent(stream.select(on), on, hot_tokens).withColumn("_hot", F.lit(True))
    salt = F.pmod(F.xxhash64(*keys, "pos"), F.lit(salt_buckets))
    s = stream.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(on).isNull(), salt).otherwise(F.lit(0)))
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))
    v = vocab.join(F.broadcast(hot), on, "left").select(
        *[c for c in vocab.columns if c != "count"], F.explode(salts).alias("_salt"))
    return s.drop("_hot").join(v, [on, "_salt"], "left").drop("_salt")


def _spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash-partition the (compact) input rows on the grouping keys before exploding them.

    With a broadcast lookup the exploded rows then stay in place and the regrouping
    needs no second exchange, so the shuffle moves raw text instead of exploded
    (key, pos, id) tuples. The number of partitions is the session's; adaptive execution folds small ones.
    """
    return df.repartition(*keys)


def encode(df: DataFrame, text_col: str, vocab: DataFrame, keys: Sequence[str], out: str = "input_ids",
           max_length: int | None = None, side: str = "right", add_bos: bool = False,
           unk_id: int = UNK_ID, bos_id: int = BOS_ID,
           broadcast_max_rows: int = BROADCAST_VOCAB_ROWS, salt_buckets: int = 64,
           hot_tokens: int = 10_000, spread_keys: Sequence[str] | None = None) -> DataFrame:
    """TK2 (+ TK3 when ``max_length``): ``keys`` + ``out ARRAY<INT>`` + ``n_tokens`` (untruncated).

    ``spread_keys`` (a prefix of ``keys``) sets the hash partitioning of the text before
    the explode, so a later grouping on that prefix needs no further exchange.

    Whole texts are tokenized; truncation keeps the first (``side='right'``) or last
    (``'left'``) ``max_length`` ids, counting the optional BOS. Empty texts give ``[]``
    (or ``[bos]``), never a dropped row.
    """
    budget = None if max_length is None else max_length - (1 if add_bos else 0)
    small = _small(vocab, broadcast_max_rows)
    if small:
        df = _spread(df.select(*keys, text_col), list(spread_keys or keys))
    # Tokenize and count once per text, *before* the generator: a per-row expression left
    # above the Generate would be re-evaluated (and the text carried) for every token.
    split = df.select(*keys, tokens(text_col).alias("_toks")).select(
        *keys, F.size("_toks").alias("n_tokens"), "_toks")
    if budget is not None:  # cut before the generator: what truncation drops is never exploded
        if side not in ("left", "right"):
            raise ValueError(f"unknown truncation side {side!r}")
        split = split.withColumn("_toks", truncate("_toks", budget, side))
    exploded = split.select(*keys, "n_tokens", F.posexplode_outer("_toks").alias("pos", "token"))
    if small:
        looked = exploded.join(F.broadcast(vocab.select("token", F.col("id").alias("_id"))), "token", "left")
    else:
        looked = _salted_lookup(exploded, vocab.select("token", F.col("id").alias("_id"), "count"), "token",
                                keys, salt_buckets, hot_tokens)
    item = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("_id", F.lit(unk_id)).alias("id")))
    grouped = looked.groupBy(*keys).agg(
        F.sort_array(F.collect_list(item)).alias("_items"),
        F.count(F.lit(1)).alias("_rows"), F.max("pos").alias("_last"),
        F.min("n_tokens").alias("_least"), F.max("n_tokens").alias("n_tokens"),
    )
    # two texts of one key would be merged into one: lengths that disagree, or more rows than places, give them away
    places = F.greatest(F.coalesce(F.col("_last"), F.lit(0)) + 1, F.lit(1))
    merged = (F.col("_least") != F.col("n_tokens")) | (F.col("_rows") != places)
    repeated = F.raise_error(F.concat(F.lit("more than one text for key "), F.to_json(F.struct(*keys))))
    ids = F.when(merged, repeated).otherwise(F.transform("_items", lambda x: x["id"]))
    if add_bos:
        ids = F.concat(F.array(F.lit(bos_id)), ids)
    return grouped.select(*keys, ids.alias(out), (F.col("n_tokens") + (1 if add_bos else 0)).cast("int")
                          .alias("n_tokens"))


def truncate(ids, max_length: int, side: str = "right") -> Column:
    """TK3 on an id array: keep the first / last ``max_length`` ids."""
    ids = _c(ids)
    if side == "right":
        return F.slice(ids, 1, max_length)
    return F.when(F.size(ids) > max_length, F.slice(ids, -max_length, max_length)).otherwise(ids)


def token_count(text, add_bos: bool = False) -> Column:
    """TK9: untruncated length in tokens. Each word maps to exactly one id (unknown -> unk),
    so the length needs no vocabulary join."""
    return (F.size(tokens(text)) + F.lit(1 if add_bos else 0)).cast("int")


def attention_mask(ids, padded_length=None, mode: str = "tokens") -> Column:
    """TK4: 1 per real token, 0 per pad up to ``padded_length``; ``mode='all_ones'`` (PPO) masks nothing."""
    ids = _c(ids)
    n = F.size(ids)
    if padded_length is None or mode == "all_ones":
        return F.array_repeat(F.lit(1), n if padded_length is None else _c(padded_length))
    return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), _c(padded_length) - n))


def causal_labels(ids, pad_id: int = PAD_ID) -> Column:
    """TK7: labels for causal LM training -- the ids with every pad replaced by -100."""
    return F.transform(_c(ids), lambda x: F.when(x == F.lit(pad_id), F.lit(IGNORE_INDEX)).otherwise(x))


def response_tokens(prompt_ids, response_ids) -> tuple[Column, Column]:
    """TK10: ``(full_ids, new_ids)`` -- prompt ids + response ids, and the slice after the prompt."""
    full = F.concat(_c(prompt_ids), _c(response_ids))
    new = F.slice(full, F.size(_c(prompt_ids)) + 1, F.greatest(F.size(full) - F.size(_c(prompt_ids)), F.lit(0)))
    return full, new


def encode_columns(df: DataFrame, columns: dict[str, str], vocab: DataFrame, keys: Sequence[str],
                   max_length: int | None = None, carry: Sequence[str] = (), **encode_args) -> DataFrame:
    """Encode several text columns of each row in one pass: ``keys`` + ``carry`` + one id array per entry
    of ``columns`` (output name -> text column).

    The texts are stacked as rows, spread once on ``keys`` and encoded together; the pivot
    back to one row per key groups on the same keys, so the whole step has one exchange
    instead of one per column plus a zip join. ``carry`` columns ride along unchanged.
    """
    names = list(columns)
    stacked = df.select(*keys, *carry, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_col"), F.col(columns[n]).alias("_text")) for i, n in enumerate(names)
    ])).alias("_s")).select(*keys, *carry, "_s._col", "_s._text")
    enc = encode(stacked, "_text", vocab, [*keys, *carry, "_col"], "_ids", max_length, spread_keys=keys,
                 **encode_args)
    return enc.groupBy(*keys, *carry).agg(
        *[F.max(F.when(F.col("_col") == i, F.col("_ids"))).alias(n) for i, n in enumerate(names)])


def shape_pairs(pairs: DataFrame, vocab: DataFrame | EncoderFactory, keys: Sequence[str], max_length: int,
                chosen: str = "chosen", rejected: str = "rejected", add_bos: bool = False) -> DataFrame:
    """TK8: tokenize both sides independently (truncated) into the four RM columns (PR1).

    Also flags ``degenerate`` pairs that became identical after truncation (S16).
    Both sides are encoded in one pass (``encode_columns``), so the whole step has one exchange.
    """
    both = encode_any(pairs, {"input_ids_chosen": chosen, "input_ids_rejected": rejected}, vocab, keys,
                      max_length, add_bos=add_bos)
    return both.select(
        *keys,
        "input_ids_chosen", attention_mask("input_ids_chosen").alias("attention_mask_chosen"),
        "input_ids_rejected", attention_mask("input_ids_rejected").alias("attention_mask_rejected"),
        (F.col("input_ids_chosen") == F.col("input_ids_rejected")).alias("degenerate"),
    )


def decode(df: DataFrame, ids_col: str, vocab: DataFrame, keys: Sequence[str], out: str = "text",
           skip_special: bool = True, specials: Sequence[str] = SPECIALS,
           broadcast_max_rows: int = BROADCAST_VOCAB_ROWS, salt_buckets: int = 64,
           hot_tokens: int = 10_000) -> DataFrame:
    """TK11: ids -> text, tokens joined by one space, special tokens dropped when asked."""
    small = _small(vocab, broadcast_max_rows)
    if small:
        df = _spread(df.select(*keys, ids_col), keys)
    exploded = df.select(*keys, F.posexplode_outer(ids_col).alias("pos", "_id"))
    if small:
        looked = exploded.join(F.broadcast(vocab.select(F.col("id").alias("_id"), "token")), "_id", "left")
    else:
        looked = _salted_lookup(exploded, vocab.select(F.col("id").alias("_id"), "token", "count"), "_id",
                                keys, salt_buckets, hot_tokens)
    keep = F.col("pos").isNotNull()
    if skip_special:
        keep = keep & ~F.col("token").isin(list(specials))
    item = F.when(keep, F.struct("pos", "token"))
    return looked.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["token"]), " ").alias(out))


# ---------------------------------------------------------------- U1: user encoder hook


def encode_with(df: DataFrame, text_col: str, encoder_factory: Callable[[], Callable[[str], list[int]]],
                out: str = "input_ids", max_length: int | None = None) -> DataFrame:
    """Encode with a user tokenizer through an Arrow ``pandas_udf``.

    ``encoder_factory`` is called once per Python worker (see ``functions.workers``), not per
    row, batch or task; the UDF sees Arrow batches of texts and returns ``ARRAY<INT>``.
    """
    key = uuid.uuid4().hex

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _enc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = worker_cache(key, encoder_factory)
        for texts in batches:
            yield pd.Series([list(fn(t))[:max_length] if max_length else list(fn(t)) for t in texts])

    return df.withColumn(out, _enc(F.col(text_col)))


#: A user tokenizer: called once per Python worker, it gives a function from a text to its ids.
EncoderFactory = Callable[[], Callable[[str], list[int]]]


def encode_columns_with(df: DataFrame, columns: dict[str, str], encoder_factory: EncoderFactory, max_length: int | None = None,
                        side: str = "right", add_bos: bool = False, bos_id: int = BOS_ID) -> DataFrame:
    """U1 (+ TK3, TK9): ``df`` with, for each entry of ``columns`` (output name -> text column), its ids, cut to
    ``max_length``, as ``name``, the untruncated length as ``name_len`` and whether ids were cut off as ``name_cut``.

    All columns of a row are encoded in one Arrow pass, where the rows lie. NULL texts have no ids. ``add_bos`` puts
    ``bos_id`` before the ids, for encoders that do not add a begin token themselves; it counts as a token.
    """
    if side not in ("left", "right"):
        raise ValueError(f"unknown truncation side {side!r}")
    key = uuid.uuid4().hex
    names = list(columns)
    fields = []
    for n in names:
        fields += [T.StructField(n, T.ArrayType(T.IntegerType())), T.StructField(f"{n}_len", T.IntegerType()), T.StructField(f"{n}_cut", T.BooleanType())]
    head = [bos_id] if add_bos else []
    room = None if max_length is None else max(max_length - len(head), 0)

    def cut(ids: list[int]) -> list[int]:
        if room is None or len(ids) <= room:
            return head + ids
        return head + (ids[:room] if side == "right" else ids[len(ids) - room:])

    @F.pandas_udf(T.StructType(fields))
    def _enc(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:  # one column comes as a series
        fn = worker_cache(key, encoder_factory)
        for texts in batches:
            out = {}
            for n, series in zip(names, (texts,) if isinstance(texts, pd.Series) else texts, strict=True):
                whole = [list(fn(t)) if t is not None else [] for t in series]
                out[n] = [cut(ids) for ids in whole]
                out[f"{n}_len"] = [len(ids) + len(head) for ids in whole]
                out[f"{n}_cut"] = [room is not None and len(ids) > room for ids in whole]
            yield pd.DataFrame(out)

    # one call for all columns; its fields are taken from the written struct
    made = df.withColumn("_encoded", _enc(*[F.col(columns[n]) for n in names]))
    return made.select(*[c for c in df.columns if c not in {f.name for f in fields}], "_encoded.*")


def encode_any(df: DataFrame, columns: dict[str, str], vocab: DataFrame | EncoderFactory, keys: Sequence[str],
               max_length: int | None = None, carry: Sequence[str] = (), add_bos: bool = False) -> DataFrame:
    """``keys`` + ``carry`` + one id array per entry of ``columns``, by a word vocabulary (TK2) or a user's encoder."""
    if isinstance(vocab, DataFrame):
        return encode_columns(df, columns, vocab, keys, max_length, carry, add_bos=add_bos)
    return encode_columns_with(df, columns, vocab, max_length, add_bos=add_bos).select(*keys, *carry, *columns)
