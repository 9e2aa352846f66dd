"""Derived fixtures (C1-C5) built from the driver tables with Spark.

These are test inputs, not operators: the reference reads hub datasets that are not
available offline, so each fixture re-shapes a driver table into the input form an
operator expects. Every fixture grows with its source table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefspark.functions.exprs import tokens
from prefspark.operators.indexing import global_index
from prefspark.session import materialize, spread_scan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turn_id(conv_id="conv_id", turn="turn"):
    """One long for a (conversation, turn), unlike for all others: Cantor's pairing, in integers.

    It has room for conversation and turn numbers whose sum is below 2 ** 32; a larger one raises (overflow).
    """
    s = f"({conv_id} + {turn})"
    half = f"IF({s} % 2 = 0, ({s} DIV 2) * ({s} + 1), {s} * (({s} + 1) DIV 2))"
    return F.expr(f"CAST({half} + {turn} AS BIGINT)")


def c1_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency trees ``(tree_id, id, parent_id, ord, role, text)`` from ``conversations``.

    Conversations are grouped by ``floor(conv_id / 4)``; system rows dropped; user ->
    prompter. The lowest conversation's first turn is the root, other conversations'
    first turns reply to it (ord = dense rank of conv_id in the tree), later turns
    reply to the turn before (ord = 1). The windows here span at most four conversations.
    """
    conv = table(spark, sf_dir, "conversations").where(F.col("role") != "system")
    base = conv.select(
        F.floor(F.col("conv_id") / 4).cast("bigint").alias("tree_id"),
        "conv_id", "turn", "text",
        F.when(F.col("role") == "user", F.lit("prompter")).otherwise(F.col("role")).alias("role"),
    )
    by_conv = Window.partitionBy("conv_id").orderBy("turn")
    by_tree = Window.partitionBy("tree_id")
    ranked = (
        base.withColumn("rn", F.row_number().over(by_conv))
        .withColumn("prev_turn", F.lag("turn").over(by_conv))
        .withColumn("conv_rank", F.dense_rank().over(Window.partitionBy("tree_id").orderBy("conv_id")))
        .withColumn("root_conv", F.min("conv_id").over(by_tree))
    )
    is_root = (F.col("rn") == 1) & (F.col("conv_id") == F.col("root_conv"))
    ranked = ranked.withColumn(
        "root_id", F.min(F.when(is_root, turn_id())).over(by_tree))
    return ranked.select(
        "tree_id",
        turn_id().alias("id"),
        F.when(is_root, F.lit(None).cast("bigint"))
        .when(F.col("rn") == 1, F.col("root_id"))
        .otherwise(turn_id("conv_id", "prev_turn")).cast("bigint").alias("parent_id"),
        F.when(is_root, F.lit(0)).when(F.col("rn") == 1, F.col("conv_rank")).otherwise(F.lit(1))
        .cast("int").alias("ord"),
        "role", "text",
    )


def c2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pair_id, conv_id, turn, prompt, chosen, rejected)``.

    prompt = a user turn, chosen = the next turn when it is the assistant's, rejected =
    the next pair's chosen in (conv_id, turn) order, cyclic. The cyclic successor is an
    equi-join on a global index (no single-partition ``lead``).
    """
    conv = table(spark, sf_dir, "conversations")
    users = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    answers = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("chosen"))
    pairs = users.join(answers, ["conv_id", "turn"]).withColumn(
        "pair_id", turn_id())
    # only the keys are sorted and numbered; texts join in once, by key
    indexed = global_index(pairs.select("conv_id", "turn"), ["conv_id", "turn"], "_i")
    n = indexed.count()
    following = indexed.select((F.pmod(F.col("_i") - 1, F.lit(n))).alias("_i"), F.col("conv_id").alias("_c"), F.col("turn").alias("_t"))
    after = indexed.join(following, "_i").select("conv_id", "turn", "_c", "_t")
    others = answers.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("chosen").alias("rejected"))
    return pairs.join(after, ["conv_id", "turn"]).join(others, ["_c", "_t"]).select(
        "pair_id", "conv_id", "turn", "prompt", "chosen", "rejected")


def c2_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pair_id`` of every C2 pair, without its texts."""
    conv = table(spark, sf_dir, "conversations")
    users = conv.where(F.col("role") == "user").select("conv_id", "turn")
    answers = conv.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"))
    return users.join(answers, ["conv_id", "turn"]).select(turn_id().alias("pair_id"))


def c2_message_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 in the message-list shape (D6): chosen / rejected as ``[user, assistant]`` lists."""
    p = c2_pairs(spark, sf_dir)

    def msgs(answer):
        return F.array(
            F.struct(F.col("prompt").alias("content"), F.lit("user").alias("role")),
            F.struct(F.col(answer).alias("content"), F.lit("assistant").alias("role")),
        )

    return p.select("pair_id", "prompt", msgs("chosen").alias("chosen"), msgs("rejected").alias("rejected"))


def c3_unigram_logps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, float, float]:
    """Add-one unigram log-probs ``(token, policy_lp, ref_lp)`` over the union vocabulary.

    Policy counts come from assistant turns, reference counts from ``documents``. Returns
    the table plus the log-probs of an unseen token for each model. The three scalars
    (two corpus sizes, vocabulary size) are the only values that reach the driver.
    """
    conv = spread_scan(table(spark, sf_dir, "conversations").where(F.col("role") == "assistant").select("text"))
    docs = spread_scan(table(spark, sf_dir, "documents").select("text"))
    # One aggregation over both corpora (a source flag per token), not two counts and a
    # full outer join: a single partial-aggregated shuffle on token.
    flagged = conv.select(F.explode(tokens("text")).alias("token"), F.lit(1).alias("_p")).unionByName(
        docs.select(F.explode(tokens("text")).alias("token"), F.lit(0).alias("_p")))
    joined = materialize(flagged.groupBy("token").agg(
        F.sum("_p").cast("long").alias("n_policy"), F.sum(1 - F.col("_p")).cast("long").alias("n_ref")))
    stats = joined.agg(F.sum("n_policy").alias("np"), F.sum("n_ref").alias("nr"),
                       F.count(F.lit(1)).alias("v")).first()
    npol, nref, v = float(stats["np"]), float(stats["nr"]), float(stats["v"])
    lps = joined.select(
        "token",
        F.log((F.col("n_policy") + 1) / F.lit(npol + v)).alias("policy_lp"),
        F.log((F.col("n_ref") + 1) / F.lit(nref + v)).alias("ref_lp"),
    )
    import math

    return lps, math.log(1.0 / (npol + v)), math.log(1.0 / (nref + v))


def c5_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq_id, logits ARRAY<DOUBLE>, label)`` from ``embeddings`` (label = vec_id mod width)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("seq_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("logits"),
        F.pmod(F.col("vec_id"), F.size("embedding")).cast("int").alias("label"),
    )


def c5_long_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 in the long layout ``(seq_id, item, logit)``."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("seq_id"), F.posexplode("embedding").alias("item", "logit")).select(
        "seq_id", F.col("item").cast("int").alias("item"), F.col("logit").cast("double").alias("logit"))



def c4_rollouts(spark: SparkSession, sf_dir: str, batch_size: int = 2, seed: int = 42) -> DataFrame:
    """C4: a padded rollout table ``(batch_id, seq_id, pos, token, policy_lp, ref_lp, value, is_pad, reward)``.

    Responses are all words of C2 chosen; reward = distinct / total words; batches of ``batch_size`` by md5(pair_id:seed) order; each batch is padded to
    its longest response and, as in the reference, its last column is dropped (S9), so
    positions run 0..width-2. Log-probs come from C3 (0 at pads); value = word length / 10
    at tokens and 0.5 at pads (masked later by RO7).
    """
    from prefspark.operators.batching import with_batches
    from prefspark.operators.rollout import expand_responses
    from prefspark.operators.tokens import with_table

    pairs = c2_pairs(spark, sf_dir)
    lps, dp, dr = c3_unigram_logps(spark, sf_dir)
    seqs = pairs.select(F.col("pair_id").alias("seq_id"), tokens("chosen").alias("toks"))
    seqs = seqs.withColumn("n", F.size("toks")).withColumn(
        "reward", F.coalesce(F.try_divide(F.size(F.array_distinct("toks")), F.col("n")), F.lit(0.0)).cast("double"))
    keys = c2_keys(spark, sf_dir).withColumnRenamed("pair_id", "seq_id")
    b = materialize(with_batches(seqs, keys, batch_size, "seq_id", seed=seed))
    rows = expand_responses(b.select("batch_id", "seq_id", "reward", "toks"), "toks")
    looked = with_table(rows, lps, ["seq_id", "pos"])
    return looked.select(
        "batch_id", "seq_id", "pos", "token",
        F.when(F.col("is_pad"), F.lit(0.0)).otherwise(F.coalesce("policy_lp", F.lit(dp))).alias("policy_lp"),
        F.when(F.col("is_pad"), F.lit(0.0)).otherwise(F.coalesce("ref_lp", F.lit(dr))).alias("ref_lp"),
        F.when(F.col("is_pad"), F.lit(0.5)).otherwise(F.length("token") / F.lit(10.0)).alias("value"),
        "is_pad", "reward",
    )


def c1_nested_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested-tree input (D1) built by Spark from ``conversations``: one VARIANT tree per
    conversation, each turn replying to the one before (system rows dropped, user ->
    prompter). Texts are JSON-escaped by ``to_json``; the tree is parsed with ``parse_json``.
    """
    conv = table(spark, sf_dir, "conversations").where(F.col("role") != "system")
    node = F.to_json(F.struct(
        F.when(F.col("role") == "user", F.lit("prompter")).otherwise(F.col("role")).alias("role"),
        F.col("text").alias("text")))
    opening = F.concat(F.expr("substring(_node, 1, length(_node) - 1)"), F.lit(',"replies":['))
    parts = conv.select("conv_id", "turn", node.alias("_node")).select("conv_id", "turn", opening.alias("_open"))
    trees = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "_open"))).alias("_o"), F.count(F.lit(1)).alias("_n"))
    text = F.concat(F.lit('{"prompt":'), F.array_join(F.col("_o").getField("_open"), ""),
                    F.repeat(F.lit("]}"), F.col("_n").cast("int")), F.lit("}"))
    return trees.select("conv_id", F.parse_json(text).alias("tree"))


def c1_nested_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 as nested trees: one VARIANT tree per four conversations.

    The root is the lowest conversation's first turn. Its replies are the rest of that conversation,
    if any, and then each other conversation; later turns reply to the turn before.
    """
    conv = table(spark, sf_dir, "conversations").where(F.col("role") != "system")
    node = F.to_json(F.struct(
        F.when(F.col("role") == "user", F.lit("prompter")).otherwise(F.col("role")).alias("role"),
        F.col("text").alias("text")))
    opening = F.concat(F.expr("substring(_node, 1, length(_node) - 1)"), F.lit(',"replies":['))
    parts = conv.select("conv_id", "turn", node.alias("_node")).select("conv_id", "turn", opening.alias("_open"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "_open"))).getField("_open")
    chains = parts.groupBy("conv_id").agg(turns.alias("_o")).withColumn("_n", F.size("_o"))

    def chain(opens, n):
        return F.concat(F.array_join(opens, ""), F.repeat(F.lit("]}"), n))

    chains = chains.select(
        F.floor(F.col("conv_id") / 4).cast("bigint").alias("tree_id"), "conv_id", F.col("_o")[0].alias("_root"),
        chain(F.col("_o"), F.col("_n")).alias("_all"),
        F.when(F.col("_n") > 1, chain(F.slice("_o", 2, F.col("_n")), F.col("_n") - 1)).alias("_rest"))
    grouped = chains.groupBy("tree_id").agg(F.sort_array(F.collect_list(F.struct("conv_id", "_root", "_all", "_rest"))).alias("_c"))
    others = F.slice(F.col("_c"), 2, F.size("_c")).getField("_all")
    children = F.concat(F.filter(F.array(F.col("_c")[0]["_rest"]), lambda x: x.isNotNull()), others)
    text = F.concat(F.lit('{"prompt":'), F.col("_c")[0]["_root"], F.array_join(children, ","), F.lit("]}}"))
    return grouped.select("tree_id", F.parse_json(text).alias("tree"))


def c6_sequences(spark: SparkSession, sf_dir: str, max_length: int = 512) -> DataFrame:
    """The scored sequences of C2 ``(pair_id, side, prompt_len, length, n_tokens, toks, sizes)``: the S3-literal inputs cut to
    ``max_length`` tokens, in shuffled batches of 2, each side as long as its longest row of the batch. ``sizes`` has the length of each token."""
    from prefspark.operators import batching, chat
    from prefspark.operators.tokens import token_count

    texts = chat.preference_texts(c2_message_pairs(spark, sf_dir), keep=("pair_id",))
    batches = batching.assign_batches(c2_keys(spark, sf_dir), 2, "pair_id", seed=42, step_col=None).select("pair_id", "batch_id")
    inputs = chat.model_inputs(texts, "conversation")
    # tokens are measured where the texts lie: who does not ask for ``toks`` shuffles numbers, not words
    sides = inputs.select("pair_id", token_count(F.col("prompt")).alias("prompt_len"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("side"), F.slice(tokens(F.col(c)), 1, max_length).alias("toks"))
        for i, c in enumerate(("chosen_input", "rejected_input"))])).alias("s")).select("pair_id", "prompt_len", "s.*")
    sides = sides.withColumns({"n_tokens": F.size("toks"), "sizes": F.transform("toks", lambda t: F.length(t))}).join(batches, "pair_id")
    return sides.withColumn("length", F.max("n_tokens").over(Window.partitionBy("batch_id", "side")))


def c6_models(spark: SparkSession, sf_dir: str, slices: int = 4) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]:
    """Both models of C6, each a function from rows of ``c6_sequences`` to the logits of their positions (``c6_logits``).

    The vectors are numbered once for all calls.
    """
    vectors = global_index(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), ["vec_id"], "_e")
    n = vectors.count()
    width = F.size("embedding")
    step = F.ceil(width / slices).cast("int")
    # vectors are scaled and cut once each, not once for every position that names them
    scaled = vectors.select("_e", width.alias("_w"), step.alias("_s"), F.transform("embedding", lambda x: x.cast("double") * 10).alias("_x"))
    cut = scaled.select("_e", "_w", F.transform(F.sequence(F.lit(0), F.col("_w") - 1, F.col("_s")), lambda at: F.struct(
        at.alias("offset"), F.slice("_x", at + 1, F.col("_s")).alias("logits"))).alias("_cuts"))

    def model(a: int, b: int) -> Callable[[DataFrame], DataFrame]:
        def logits(sequences: DataFrame) -> DataFrame:
            placed = sequences.select("pair_id", "side", "sizes", F.explode(F.sequence(F.lit(0), F.col("length") - 2)).alias("pos")) \
                .where("pos >= 0")
            rows = placed.select(
                "pair_id", "side", "pos", F.coalesce(F.get("sizes", F.col("pos") + 1), F.lit(0)).alias("_l"),
                F.pmod(F.col("pair_id") + F.col("pos") * a + F.col("side") * b, F.lit(max(1, n))).alias("_e"))
            joined = rows.join(cut, "_e").select("pair_id", "side", "pos", (F.col("_l") % F.col("_w")).alias("label"), F.inline("_cuts"))
            return joined.select("pair_id", "side", "pos", "offset", "label", "logits")

        return logits

    return model(31, 17), model(29, 11)


def c6_logits(spark: SparkSession, sf_dir: str, sequences: DataFrame, model: int, slices: int = 4) -> DataFrame:
    """C6 logits ``(pair_id, side, pos, offset, logits, label)`` of every position of ``sequences``, in vocabulary slices.

    The vocabulary is the width of the embeddings; a position's logits are ten times an embedding that pair, side and
    position name by its number in id order, another one for each ``model``. Its label is the next token's
    length modulo the width, 0 for a pad.
    """
    return c6_models(spark, sf_dir, slices)[model](sequences)
