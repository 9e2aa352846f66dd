"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Each query reads the driver tables (or fixtures Spark derives from them) in full, so
its work grows with the data. Output columns are aliased to match ``oracle.SQL``;
doubles are rounded to 6 decimals and arrays rendered as space-joined strings so
value hashes are engine-independent.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefspark.functions.exprs import MARKER_PATTERN, TOKEN_PATTERN, ids_string, last_segment, round6
from prefspark.functions.exprs import tokens as word_tokens
from prefspark.operators import batching, chat, logps, losses, rollout, sampling, tokens, tour, trees
from prefspark.operators.indexing import rank_within
from prefspark.operators.skew import lookup
from prefspark.plans import fixtures as fx
from prefspark.plans import jobs
from prefspark.plans.jobs import MAX_LENGTH
from prefspark.session import Scratch, ensure_checkpoint_dir, materialize, shuffles_released
from prefspark.sources import io

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


@query("chatml_conversations")
def q_chatml_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TR4 + TR5 + TR6 on the flat conversations table (the flagship)."""
    conv = fx.table(spark, sf_dir, "conversations")
    return chat.conversations_to_chatml(conv)


@query("tree_preorder")
def q_tree_preorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TR2 (+ JN3): adjacency trees -> paths -> pre-order rank inside each tree."""
    msgs = trees.linearize_messages(fx.c1_tree_nodes(spark, sf_dir))
    ranked = rank_within(msgs.select("tree_id", "id", "parent_id", "depth", "path"), ["tree_id"], ["path"],
                         "preorder")
    return ranked.select("tree_id", "id", "parent_id", F.col("depth").cast("bigint").alias("depth"),
                         F.col("preorder").cast("bigint").alias("preorder"))


@query("chatml_trees")
def q_chatml_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TR2 -> PR4 -> TR3 -> TR4 -> TR5: one ChatML text per tree, system prompt first."""
    msgs = trees.linearize_messages(fx.c1_tree_nodes(spark, sf_dir))
    return chat.trees_to_chatml(msgs, system=chat.DEFAULT_SYSTEM_PROMPT)


@query("role_map")
def q_role_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR2 + PR4: row-wise role mapping of tree nodes."""
    nodes = fx.c1_tree_nodes(spark, sf_dir)
    return nodes.select("tree_id", "id", trees.map_role(F.col("role")).alias("role"))


@query("render_prompt")
def q_render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT1 / CT5 / JB7: prompts rendered for generation with the ChatML template."""
    bench = fx.table(spark, sf_dir, "benchmark")
    return bench.select("item_id", chat.render_prompt(F.col("text")).alias("prompt"))


@query("preference_texts")
def q_preference_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT2-CT4 + PR5 + CT6 (S3 literal): message-list pairs -> prompt / chosen / rejected texts."""
    pairs = fx.c2_message_pairs(spark, sf_dir)
    texts = chat.preference_texts(pairs, keep=("pair_id",))
    return chat.model_inputs(texts, "conversation")


# ---------------------------------------------------------------- tokens and batching


def _vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word vocabulary over all rendered conversation turns (so role names are words), tokens seen at least twice."""
    turns = fx.table(spark, sf_dir, "conversations").select(chat.chatml_block("role", "text").alias("text"))
    return tokens.build_vocab(turns, "text", min_count=2)


@query("vocab")
def q_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK1: specials first, then tokens by (count desc, token)."""
    v = _vocab(spark, sf_dir)
    return v.select("token", F.col("id").cast("bigint").alias("id"), "count")


@query("encode")
def q_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK2: every turn encoded in full (unknown words -> unk)."""
    conv = fx.table(spark, sf_dir, "conversations")
    enc = tokens.encode(conv, "text", _vocab(spark, sf_dir), ["conv_id", "turn"])
    return enc.select("conv_id", "turn", ids_string("input_ids").alias("input_ids"),
                      F.col("n_tokens").cast("bigint").alias("n_tokens"))


@query("truncate")
def q_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK3: encode with truncation to 32 ids (truncated before the vocabulary join)."""
    conv = fx.table(spark, sf_dir, "conversations")
    enc = tokens.encode(conv, "text", _vocab(spark, sf_dir), ["conv_id", "turn"], max_length=32)
    return enc.select("conv_id", "turn", ids_string("input_ids").alias("input_ids"),
                      F.size("input_ids").cast("bigint").alias("length"),
                      F.col("n_tokens").cast("bigint").alias("n_tokens"))


@query("decode")
def q_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK11: encode then decode, skipping special tokens (so unknown words drop out)."""
    conv = fx.table(spark, sf_dir, "conversations")
    v = _vocab(spark, sf_dir)
    enc = tokens.encode(conv, "text", v, ["conv_id", "turn"])
    return tokens.decode(enc, "input_ids", v, ["conv_id", "turn"])


@query("prompt_length")
def q_prompt_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK9: untruncated token length of the rendered prompt."""
    pairs = fx.c2_pairs(spark, sf_dir)
    return pairs.select("pair_id", tokens.token_count(chat.render_prompt(F.col("prompt")))
                        .cast("bigint").alias("prompt_len"))


@query("pad_batch")
def q_pad_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB1 tail: ChatML texts -> encode (whole texts) -> shuffled batches of 4 -> pad, mask, LM labels
    (TK4, TK5, TK7, BA2, WN3)."""
    conv = fx.table(spark, sf_dir, "conversations")
    enc = tokens.encode(chat.conversations_to_chatml(conv), "text", _vocab(spark, sf_dir), ["conv_id"])
    b = batching.with_batches(enc, conv.select("conv_id").distinct(), 4, "conv_id", seed=42)
    padded = batching.pad_batch(b)
    return padded.select(
        "conv_id", "batch_id", ids_string("input_ids").alias("input_ids"),
        ids_string("attention_mask").alias("attention_mask"),
        ids_string(tokens.causal_labels("input_ids")).alias("labels"),
    )


def _pair_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fx.c2_message_pairs(spark, sf_dir)
    return chat.preference_texts(pairs, keep=("pair_id",))


@query("shape_pairs")
def q_shape_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK8: both sides of a pair tokenized independently (max 512) into four columns."""
    shaped = tokens.shape_pairs(_pair_texts(spark, sf_dir), _vocab(spark, sf_dir), ["pair_id"], MAX_LENGTH)
    return shaped.select("pair_id", *[ids_string(c).alias(c) for c in (
        "input_ids_chosen", "attention_mask_chosen", "input_ids_rejected", "attention_mask_rejected")],
        F.col("degenerate").cast("bigint").alias("degenerate"))


@query("pad_pairs")
def q_pad_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB2: shaped pairs -> shuffled batches of 4 -> shared per-batch padding (TK6)."""
    shaped = tokens.shape_pairs(_pair_texts(spark, sf_dir), _vocab(spark, sf_dir), ["pair_id"], MAX_LENGTH)
    b = batching.with_batches(shaped, fx.c2_keys(spark, sf_dir), 4, "pair_id", seed=42)
    padded = batching.pad_pairs(b)
    return padded.select("pair_id", "batch_id", *[ids_string(c).alias(c) for c in (
        "input_ids_chosen", "attention_mask_chosen", "input_ids_rejected", "attention_mask_rejected")])


@query("degenerate_pairs")
def q_degenerate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs identical after independent truncation to 8 ids."""
    shaped = tokens.shape_pairs(_pair_texts(spark, sf_dir), _vocab(spark, sf_dir), ["pair_id"], 8)
    return shaped.select("pair_id", F.col("degenerate").cast("bigint").alias("degenerate"))


@query("response_tokens")
def q_response_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK10: prompt ids + response ids, and the new tokens sliced back out."""
    pairs = fx.c2_pairs(spark, sf_dir)
    v = _vocab(spark, sf_dir)
    both = tokens.encode_columns(pairs, {"prompt_ids": "prompt", "response_ids": "chosen"}, v, ["pair_id"])
    full, new = tokens.response_tokens("prompt_ids", "response_ids")
    return both.select("pair_id", ids_string(full).alias("full_ids"),
                       ids_string(new).alias("new_ids"), F.size(new).cast("bigint").alias("n_new"))


@query("assign_batches")
def q_assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BA1 + BA2 + WN4: two epochs, each shuffled by md5(pair_id:42:epoch), sliced into batches of 4."""
    pairs = fx.c2_keys(spark, sf_dir)
    e = batching.with_epochs(pairs, 2).withColumn("epoch", F.col("epoch").cast("bigint"))
    return batching.assign_batches(e, 4, "pair_id", seed=42, epoch_col="epoch").select(
        "pair_id", "epoch", "idx", "batch_id", "step")


@query("plan_steps")
def q_plan_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BA3 + SF6: ceil(N / batch) * epochs for batch 2, 10 epochs."""
    return batching.plan_steps(fx.c2_keys(spark, sf_dir), 2, 10)


# ---------------------------------------------------------------- sampling, log-probs, losses, rollouts


@query("nucleus")
def q_nucleus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BA4: top-p 0.9 / temperature 0.7 candidate sets over every embedding row as logits."""
    n = sampling.nucleus(fx.c5_long_logits(spark, sf_dir), top_p=0.9, temperature=0.7)
    return n.select("seq_id", F.col("item").cast("bigint").alias("item"), round6("prob").alias("prob"),
                    F.col("rank").cast("bigint").alias("rank"))


@query("sample_one")
def q_sample_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BA5: one seeded Gumbel-max draw per row from its nucleus."""
    n = sampling.nucleus(fx.c5_long_logits(spark, sf_dir), top_p=0.9, temperature=0.7)
    s = sampling.sample_one(n, seed=42)
    return s.select("seq_id", F.col("item").cast("bigint").alias("item"))


@query("nucleus_rows")
def q_nucleus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BA4 on rows of logits: the candidate sets of ``nucleus`` without exploding, shuffling or sorting across rows."""
    rows = fx.c5_logits(spark, sf_dir).select("seq_id", F.posexplode(sampling.nucleus_of("logits")).alias("_at", "_c"))
    return rows.select("seq_id", F.col("_c.item").cast("bigint").alias("item"), round6("_c.prob").alias("prob"),
                       (F.col("_at") + 1).cast("bigint").alias("rank"))


@query("draw_rows")
def q_draw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BA5 on rows of logits: the draw of ``sample_one`` as an expression."""
    rows = fx.c5_logits(spark, sf_dir).select("seq_id", sampling.nucleus_of("logits").alias("c"))
    return rows.select("seq_id", sampling.drawn_of("c", "seq_id").cast("bigint").alias("item"))


@query("token_logps")
def q_token_logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LP1 + JN2: log-softmax of each logits row gathered at its label (row layout, no shuffle)."""
    t = logps.token_logps(fx.c5_logits(spark, sf_dir))
    return t.select("seq_id", F.col("label").cast("bigint").alias("label"), round6("logp").alias("logp"))


@query("shift_labels")
def q_shift_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LP2 + WN1: next-token labels over every encoded turn."""
    conv = fx.table(spark, sf_dir, "conversations")
    enc = tokens.encode(conv, "text", _vocab(spark, sf_dir), ["conv_id", "turn"])
    long = enc.select("conv_id", "turn", F.posexplode("input_ids").alias("pos", "token"))
    s = logps.shift_labels(long, ["conv_id", "turn"])
    return s.select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"),
                    F.col("token").cast("bigint").alias("token"), F.col("label").cast("bigint").alias("label"))


def _sequence_logps(spark: SparkSession, sf_dir: str, max_length: int = MAX_LENGTH) -> DataFrame:
    """LP3/LP4 on C2 with C3 scorers: the S3-literal DPO inputs, truncated, prompt length untruncated.

    With a context-free scorer, the shifted log-prob at position j is the token log-prob
    at j+1, so the response mean needs no window: it averages the tokens after the
    first response token (S4) -- the response slice is cut out *before* the scorer join.
    """
    texts = chat.preference_texts(fx.c2_message_pairs(spark, sf_dir), keep=("pair_id",))
    inputs = chat.model_inputs(texts, "conversation")
    sides = inputs.select(
        "pair_id", "prompt",
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.col("chosen_input").alias("inp")),
            F.struct(F.lit(1).alias("side"), F.col("rejected_input").alias("inp")),
        )).alias("s"),
    )
    sides = tokens._spread(sides, ["pair_id"])
    seqs = sides.select(
        "pair_id", F.col("s.side").alias("side"),
        tokens.token_count(F.col("prompt")).alias("prompt_len"),
        F.slice(word_tokens(F.col("s.inp")), 1, max_length).alias("toks"),
    ).withColumn("length", F.size("toks"))
    resp = seqs.select("pair_id", "side", "prompt_len", "length",
                       F.posexplode_outer(F.slice("toks", F.col("prompt_len") + 2, F.col("length"))).alias("pos", "token"))
    lps, dp, dr = fx.c3_unigram_logps(spark, sf_dir)
    scored = tokens.with_table(resp, lps, ["pair_id", "side", "pos"]).select(
        "pair_id", "side", "prompt_len", "length",
        F.when(F.col("token").isNotNull(), F.coalesce("policy_lp", F.lit(dp))).alias("policy_lp"),
        F.when(F.col("token").isNotNull(), F.coalesce("ref_lp", F.lit(dr))).alias("ref_lp"),
    )
    return scored.groupBy("pair_id", "side").agg(
        F.coalesce(F.avg("policy_lp"), F.lit(0.0)).alias("policy_logp"),
        F.coalesce(F.avg("ref_lp"), F.lit(0.0)).alias("ref_logp"),
        (F.first("prompt_len") >= F.first("length") - 1).alias("response_cut"),
    )


@query("sequence_logps")
def q_sequence_logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LP3 + LP4 + S4 + S7: mean response log-prob per side, 0.0 when the response was cut off."""
    s = _sequence_logps(spark, sf_dir)
    return s.select("pair_id", F.col("side").cast("bigint").alias("side"), round6("policy_logp").alias("policy_logp"),
                    round6("ref_logp").alias("ref_logp"), F.col("response_cut").cast("bigint").alias("response_cut"))


def _dpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _sequence_logps(spark, sf_dir)
    side0, side1 = F.col("side") == 0, F.col("side") == 1
    per_pair = s.groupBy("pair_id").agg(
        F.max(F.when(side0, F.col("policy_logp"))).alias("policy_chosen"),
        F.max(F.when(side1, F.col("policy_logp"))).alias("policy_rejected"),
        F.max(F.when(side0, F.col("ref_logp"))).alias("ref_chosen"),
        F.max(F.when(side1, F.col("ref_logp"))).alias("ref_rejected"),
    )
    return losses.dpo_loss(per_pair, beta=0.1)


@query("dpo_loss")
def q_dpo_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LS3: per-pair DPO margin and loss (beta 0.1)."""
    d = _dpo(spark, sf_dir)
    return d.select("pair_id", *[round6(c).alias(c) for c in (
        "policy_chosen", "policy_rejected", "ref_chosen", "ref_rejected", "margin", "loss")])


@query("eval_loss")
def q_eval_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LS4 + IO6 + U4: mean DPO loss per split; the split is a hash bucket of pair_id (all rows kept)."""
    d = _dpo(spark, sf_dir)
    bucket = F.conv(F.substring(F.md5(F.col("pair_id").cast("string")), 1, 2), 16, 10).cast("int")
    d = d.withColumn("split", F.when(bucket < 51, F.lit("test")).otherwise(F.lit("train")))
    e = losses.eval_loss(d)
    return e.select("split", round6("mean_loss").alias("mean_loss"), "n_rows")


def _doc_score(text) -> Column:
    toks = word_tokens(text)
    return F.coalesce(F.lit(10.0) * F.try_divide(F.size(F.array_distinct(toks)), F.size(toks)), F.lit(0.0))


@query("pairwise_loss")
def q_pairwise_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LS1 + LS2: every labelled document, k-th good vs (k mod bad)-th bad (doc_id order), stable -log sigmoid.

    The smaller class repeats until each document of the larger one has a partner.
    """
    docs = fx.table(spark, sf_dir, "documents").join(fx.table(spark, sf_dir, "labels"), "doc_id")
    scored = docs.select("doc_id", "quality", _doc_score(F.col("text")).alias("score"))
    ranked = rank_within(scored, ["quality"], ["doc_id"], "k")
    good = ranked.where(F.col("quality") == 1).select("k", F.col("doc_id").alias("chosen_doc"),
                                                       F.col("score").alias("reward_chosen"))
    bad = ranked.where(F.col("quality") == 0).select("k", F.col("doc_id").alias("rejected_doc"),
                                                      F.col("score").alias("reward_rejected"))
    n_good, n_bad = good.count(), bad.count()
    fewer, more = (bad, good) if n_bad <= n_good else (good, bad)
    at = fewer.withColumnRenamed("k", "_k")
    turn = more.withColumn("_turn", F.pmod(F.col("k"), F.lit(max(1, min(n_good, n_bad)))))
    paired = lookup(turn, at, [("_turn", "_k")], ["k"], how="inner")  # few partners meet many documents each
    pl = losses.pairwise_loss(paired)
    return pl.select(F.col("k").cast("bigint").alias("pair_id"), "chosen_doc", "rejected_doc",
                     round6("reward_chosen").alias("reward_chosen"),
                     round6("reward_rejected").alias("reward_rejected"), round6("loss").alias("loss"))


def _distinct_ratio_model():
    """Fixture scorer for the LP5 hook: distinct / total words of each text (numpy, per batch)."""
    pat, marker = re.compile(TOKEN_PATTERN), re.compile(MARKER_PATTERN)

    def predict(texts: np.ndarray) -> np.ndarray:
        out = np.empty(len(texts), dtype=np.float64)
        for i, t in enumerate(texts):
            w = pat.findall(marker.sub(r" \1 ", t))
            out[i] = len(set(w)) / len(w) if w else 0.0
        return out

    return predict


@query("score_texts")
def q_score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LP5 + U5 + CT6: prompt and response of every pair scored as one text by a user model
    through ``predict_batch_udf``."""
    pairs = fx.c2_pairs(spark, sf_dir).select("pair_id", chat.concat_text("prompt", "chosen").alias("text"))
    s = logps.score_texts(pairs, "text", _distinct_ratio_model)
    return s.select("pair_id", round6("score").alias("score"))


def _rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollout.advantages(fx.c4_rollouts(spark, sf_dir))


@query("center_rewards")
def q_center_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RO1: batch-centred rewards, one row per sequence."""
    r = rollout.center_rewards(fx.c4_rollouts(spark, sf_dir)).where(F.col("pos") == 0)
    return r.select("batch_id", "seq_id", round6("reward").alias("reward"),
                    round6("reward_centered").alias("reward_centered"))


@query("td_residuals")
def q_td_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RO2 + RO3 + RO7: reward on the last column, masked values, TD residuals."""
    r = fx.c4_rollouts(spark, sf_dir)
    r = rollout.td_residuals(rollout.place_reward(rollout.mask_values(rollout.center_rewards(r))))
    return r.select("batch_id", "seq_id", F.col("pos").cast("bigint").alias("pos"), round6("mask").alias("mask"),
                    round6("value").alias("value"), round6("reward_t").alias("reward_t"),
                    round6("delta").alias("delta"))


@query("gae")
def q_gae(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RO4 + RO5 + WN2: generalized advantages (gamma 0.99, lam 0.95) and returns."""
    r = _rollouts(spark, sf_dir)
    return r.select("batch_id", "seq_id", F.col("pos").cast("bigint").alias("pos"),
                    round6("advantage").alias("advantage"), round6("returns").alias("returns"))


@query("ppo_loss")
def q_ppo_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RO8-RO12 + PR6 + SF7/SF8: clipped surrogate, value loss, masked KL and total per batch."""
    p = rollout.ppo_loss(_rollouts(spark, sf_dir))
    return p.select("batch_id", *[round6(c).alias(c) for c in ("policy_loss", "value_loss", "kl", "loss")])


@query("rollout_metrics")
def q_rollout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RO13 + PR7: per-step loss, KL and mean reward; ``logged`` marks every 10th step."""
    m = rollout.rollout_metrics(_rollouts(spark, sf_dir)).withColumn("step", F.col("batch_id") + 1)
    return m.select(F.col("step").cast("bigint").alias("step"), round6("loss").alias("loss"), round6("kl").alias("kl"),
                    round6("reward_mean").alias("reward_mean"), round6("raw_reward_mean").alias("raw_reward_mean"),
                    batching.logged("step", 10).cast("bigint").alias("logged"))


@query("tree_explode")
def q_tree_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TR1 + SF2 + SF4: nested, branched VARIANT trees (built from conversations) -> message rows with paths."""
    msgs = trees.explode_tree(fx.c1_nested_trees(spark, sf_dir))
    return msgs.select("tree_id", F.size("path").cast("bigint").alias("depth"), ids_string("path").alias("path"),
                       trees.map_role(F.col("role")).alias("role"), "text")


# ---------------------------------------------------------------- jobs on splits


def _split(key: str) -> Column:
    """A fifth of the rows is the test split, by a hash of the key."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 2), 16, 10).cast("int")
    return F.when(bucket < 51, F.lit("test")).otherwise(F.lit("train"))


@query("prepare_rm")
def q_prepare_rm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB2 on both splits of C2, each batched on its own."""
    pairs = fx.c2_pairs(spark, sf_dir).select("pair_id", "chosen", "rejected").withColumn("split", _split("pair_id"))
    vocab = _vocab(spark, sf_dir)
    both = [jobs.prepare_rm(pairs, vocab, split=s) for s in ("train", "test")]
    return both[0].unionByName(both[1]).select("pair_id", "split", "batch_id", *[ids_string(c).alias(c) for c in (
        "input_ids_chosen", "attention_mask_chosen", "input_ids_rejected", "attention_mask_rejected")])


@query("prepare_dpo")
def q_prepare_dpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB3 on both splits of C2 message lists, each batched on its own, with a begin token: padded ids, prompt length, cut flags."""
    pairs = fx.c2_message_pairs(spark, sf_dir).withColumn("split", _split("pair_id"))
    vocab = _vocab(spark, sf_dir)
    return _dpo_rows(*[jobs.prepare_dpo(pairs, vocab, split=s, add_bos=True) for s in ("train", "test")])


def _dpo_rows(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.unionByName(test).select(
        "pair_id", "split", "batch_id", F.col("prompt_len").cast("bigint").alias("prompt_len"),
        *[ids_string(c).alias(c) for c in ("chosen_ids", "rejected_ids")],
        *[F.col(c).cast("bigint").alias(c) for c in ("chosen_cut", "rejected_cut")])


def _length_encoder():
    """Fixture encoder for the U1 hook: a word's id is its length, after the special ids."""
    pat, marker = re.compile(TOKEN_PATTERN), re.compile(MARKER_PATTERN)
    return lambda text: [len(w) + len(tokens.SPECIALS) for w in pat.findall(marker.sub(r" \1 ", text))]


@query("prepare_dpo_encoder")
def q_prepare_dpo_encoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB3 with a user's encoder (U1) in place of a vocabulary, on both splits: three texts of a row in one pass."""
    pairs = fx.c2_message_pairs(spark, sf_dir).withColumn("split", _split("pair_id"))
    return _dpo_rows(*[jobs.prepare_dpo(pairs, _length_encoder, split=s) for s in ("train", "test")])


@query("prepare_sft")
def q_prepare_sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB1 on nested trees: TR1 -> TR6 -> TK2 / TK3 -> BA2 -> TK5 / TK7, batches of 4."""
    trees_ = fx.c1_nested_trees(spark, sf_dir)
    p = jobs.prepare_sft(spark, trees_, None, _vocab(spark, sf_dir))
    return p.select("tree_id", "batch_id", *[ids_string(c).alias(c) for c in ("input_ids", "attention_mask", "labels")])


@query("prepare_prompts")
def q_prepare_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB4 on the benchmark prompts: three epochs of padded batches of 2."""
    prompts = fx.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("prompt_id"), F.col("text").alias("prompt"))
    p = jobs.prepare_prompts(prompts, _vocab(spark, sf_dir), num_epochs=3)
    return p.select("prompt_id", F.col("epoch").cast("bigint").alias("epoch"), "batch_id", "step",
                    ids_string("input_ids").alias("input_ids"))


@query("log_steps")
def q_log_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB6 with the PR7 filter: every tenth step of the rollout evaluation."""
    m = jobs.evaluate_rollouts(fx.c4_rollouts(spark, sf_dir))
    return m.select(F.col("step").cast("bigint").alias("step"), round6("loss").alias("loss"))


@query("simple_advantages")
def q_simple_advantages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RO6: masked reward minus value, and masked reward."""
    r = rollout.mask_values(rollout.center_rewards(fx.c4_rollouts(spark, sf_dir)))
    g = rollout.gae(r, method="simple")
    return g.select("batch_id", "seq_id", F.col("pos").cast("bigint").alias("pos"),
                    round6("advantage").alias("advantage"), round6("returns").alias("returns"))


def _padded_token_logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifted rows (pair_id, side, pos, policy_lp, ref_lp, prompt_len, length, is_pad) of C2 in padded batches of 2.

    Row ``pos`` scores token ``pos + 1``; each side is padded to its longest row in the batch. A pad
    scores -0.5 under the policy and -0.25 under the reference, so that means over pads show.
    """
    texts = chat.preference_texts(fx.c2_message_pairs(spark, sf_dir), keep=("pair_id",))
    batches = batching.assign_batches(fx.c2_keys(spark, sf_dir), 2, "pair_id", seed=42, step_col=None).select("pair_id", "batch_id")
    inputs = chat.model_inputs(texts, "conversation").join(batches, "pair_id")
    sides = inputs.select("pair_id", "batch_id", tokens.token_count(F.col("prompt")).alias("prompt_len"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("side"), F.slice(word_tokens(F.col(c)), 1, MAX_LENGTH).alias("toks"))
        for i, c in enumerate(("chosen_input", "rejected_input"))])).alias("s")).select("pair_id", "batch_id", "prompt_len", "s.*")
    length = F.max(F.size("toks")).over(Window.partitionBy("batch_id", "side"))
    padded = sides.withColumn("length", length).withColumn(
        "row", F.concat("toks", F.array_repeat(F.lit(None).cast("string"), F.col("length") - F.size("toks"))))
    rows = padded.select("pair_id", "side", "prompt_len", "length", F.posexplode(F.slice("row", 2, F.col("length"))).alias("pos", "token"))
    lps, dp, dr = fx.c3_unigram_logps(spark, sf_dir)
    scored = tokens.with_table(rows, lps, ["pair_id", "side", "pos"]).withColumn("is_pad", F.col("token").isNull())
    keys = ["pair_id", "side", "pos"]
    policy = scored.select(*keys, "prompt_len", "length", "is_pad",
                           F.when(F.col("is_pad"), -0.5).otherwise(F.coalesce("policy_lp", F.lit(dp))).alias("logp"))
    ref = scored.select(*keys, F.when(F.col("is_pad"), -0.25).otherwise(F.coalesce("ref_lp", F.lit(dr))).alias("logp"))
    return logps.pair_logp_tables(policy, ref, keys)


@query("padded_logps")
def q_padded_logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LP3 + LP4 + JN4 on padded batches: S5 literal (pads in the mean) and masked, S7 against the padded width."""
    table = _padded_token_logps(spark, sf_dir)
    both = logps.response_mean(table, ["pair_id", "side"], ["policy_lp", "ref_lp"], pad_col="is_pad", mask_padding=None)
    return both.select(
        "pair_id", F.col("side").cast("bigint").alias("side"), F.col("masked").cast("bigint").alias("masked"), round6("policy_lp").alias("policy_logp"),
        round6("ref_lp").alias("ref_logp"), F.col("response_cut").cast("bigint").alias("response_cut"))


@query("evaluate_dpo")
def q_evaluate_dpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB5: token log-probs -> LP3 -> LP4 -> LS3 -> LS4 per split, with an own loss expression too (U4)."""
    means = logps.response_mean(_padded_token_logps(spark, sf_dir), ["pair_id", "side"], ["policy_lp", "ref_lp"])
    side = lambda i, c: F.max(F.when(F.col("side") == i, F.col(c)))
    per_pair = means.groupBy("pair_id").agg(
        side(0, "policy_lp").alias("policy_chosen"), side(1, "policy_lp").alias("policy_rejected"),
        side(0, "ref_lp").alias("ref_chosen"), side(1, "ref_lp").alias("ref_rejected")).withColumn("split", _split("pair_id"))
    e = jobs.evaluate_dpo(per_pair)
    wrong = losses.eval_loss(losses.dpo_loss(per_pair), loss=F.when(F.col("margin") > 0, 0.0).otherwise(1.0))
    return e.join(wrong.select("split", F.col("mean_loss").alias("error_rate")), "split").select(
        "split", round6("mean_loss").alias("mean_loss"), round6("error_rate").alias("error_rate"), "n_rows")


@query("evaluate_dpo_logits")
def q_evaluate_dpo_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB5 from logits in vocabulary slices (LP1, D11): both models' logits of every position to the mean loss of each split."""
    with Scratch(spark) as scratch:
        with shuffles_released(spark):
            sequences = scratch.written(fx.c6_sequences(spark, sf_dir).drop("toks").withColumn("split", _split("pair_id")))
        e = jobs.evaluate_dpo_logits(*fx.c6_models(spark, sf_dir), sequences)
        return materialize(e.select("split", round6("mean_loss").alias("mean_loss"), "n_rows"))


@query("logit_logps")
def q_logit_logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LP1 -> LP3 -> JN4 from sliced logits: both models' mean response log-prob of every sequence, pads masked."""
    with Scratch(spark) as scratch:
        with shuffles_released(spark):
            sequences = scratch.written(fx.c6_sequences(spark, sf_dir).drop("toks"))
        means = jobs.sequence_logps(*fx.c6_models(spark, sf_dir), sequences, mask_padding=True)
    return means.select("pair_id", F.col("side").cast("bigint").alias("side"), round6("policy_lp").alias("policy_logp"),
                        round6("ref_lp").alias("ref_logp"), F.col("response_cut").cast("bigint").alias("response_cut"))


@query("evaluate_rm")
def q_evaluate_rm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB5 (RM): one reward logit per side of every C2 pair to the mean ranking loss of each split (LS1, LS2, LS4)."""
    pairs = fx.c2_pairs(spark, sf_dir).withColumn("split", _split("pair_id"))
    sides = pairs.select("pair_id", "split", F.explode(F.array(*[
        F.struct(F.lit(i).alias("side"), F.array(_doc_score(F.col(c))).alias("logits")) for i, c in enumerate(("chosen", "rejected"))])).alias("s"))
    e = jobs.evaluate_rm_logits(sides.select("pair_id", "split", "s.*"))
    return e.select("split", round6("mean_loss").alias("mean_loss"), "n_rows")


@query("epoch_batches")
def q_epoch_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BA1 + BA2 by permutation: ten epochs of batches of 2 over all C2 pairs, one index and no sort per epoch."""
    return batching.epoch_batches(fx.c2_keys(spark, sf_dir), 2, "pair_id", num_epochs=10)


@query("tour_preorder")
def q_tour_preorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TR2 + JN3 by Euler tour and list ranking: pre-order and depth of every node, without a key that can be hot."""
    return tour.preorder(fx.c1_tree_nodes(spark, sf_dir)).select("tree_id", "id", "depth", "preorder")


@query("evaluate_rollouts")
def q_evaluate_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JB6 from texts (LP5 -> RO1 .. RO13): rewards of a user's model for prompt + response cut to 512 words, every step."""
    texts = fx.c2_pairs(spark, sf_dir).select(F.col("pair_id").alias("seq_id"), "prompt", F.col("chosen").alias("response"))
    m = jobs.evaluate_texts(fx.c4_rollouts(spark, sf_dir).drop("reward"), texts, _distinct_ratio_model, max_length=MAX_LENGTH, logging_steps=None)
    return m.select(F.col("step").cast("bigint").alias("step"), *[round6(c).alias(c) for c in ("loss", "kl", "reward_mean", "raw_reward_mean")])


@query("gae_long")
def q_gae_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RO1 .. RO5 by scans over pieces of 64 positions: the advantages of ``gae`` without a window over a sequence or batch."""
    r = rollout.long_advantages(fx.c4_rollouts(spark, sf_dir), piece=64)
    return r.select("batch_id", "seq_id", F.col("pos").cast("bigint").alias("pos"),
                    round6("advantage").alias("advantage"), round6("returns").alias("returns"))


@query("batch_files")
def q_batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO8 + D10: shaped pairs written as batch-sorted bucket files, read back and padded per batch without an exchange (TK6)."""
    shaped = tokens.shape_pairs(_pair_texts(spark, sf_dir), _vocab(spark, sf_dir), ["pair_id"], MAX_LENGTH)
    path = f"{ensure_checkpoint_dir(spark)}/batches-{uuid.uuid4().hex}"
    io.write_batches(batching.with_batches(shaped, fx.c2_keys(spark, sf_dir), 4, "pair_id", seed=42), path)
    padded = batching.pad_pairs(io.read_batches(spark, path))
    return padded.select("pair_id", "batch_id", *[ids_string(c).alias(c) for c in (
        "input_ids_chosen", "attention_mask_chosen", "input_ids_rejected", "attention_mask_rejected")])


@query("ordered_texts")
def q_ordered_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO7 in input order, read back with line numbers (IO3): line n over all parts is conversation n."""
    texts = chat.conversations_to_chatml(fx.table(spark, sf_dir, "conversations"))
    path = f"{ensure_checkpoint_dir(spark)}/texts-{uuid.uuid4().hex}"
    io.write_texts_ordered(texts, path, order="conv_id")
    parts = io.read_manifest(spark, path)["parts"]
    firsts = spark.createDataFrame([(p["file"], p["first"]) for p in parts], "_name string, _first long")
    lines = io.line_numbers(io.read_texts(spark, path))
    named = lines.withColumn("_name", last_segment("file"))
    return named.join(F.broadcast(firsts), "_name").select((F.col("_first") + F.col("line")).alias("line"), F.col("text"))


def _tree_rows(msgs: DataFrame, tree_id: Column) -> DataFrame:
    return msgs.select(tree_id.cast("bigint").alias("tree_id"), F.size("path").cast("bigint").alias("depth"), ids_string("path").alias("path"),
                       trees.map_role(F.col("role")).alias("role"), "text")


def _tree_lines(spark: SparkSession, sf_dir: str, indent: str = "") -> str:
    """A folder of tree JSONL: every nested tree of C1 with its number as ``k``, one a line."""
    nested = fx.c1_nested_trees(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"
    line = F.concat(F.lit(indent + '{"k":"'), F.col("tree_id"), F.lit('",'), F.expr("substring(to_json(tree), 2)"), F.lit(indent))
    nested.select(line.alias("value")).write.text(path)
    return path


@query("tree_files")
def q_tree_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO1 + IO2 -> TR1: tree JSONL files read as one VARIANT a line, keyed by a field, to message rows."""
    raw = io.read_trees(spark, _tree_lines(spark, sf_dir), key="k")
    return _tree_rows(trees.explode_tree(raw), F.col("tree_id"))


@query("tree_lines")
def q_tree_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO2 + SF1 -> TR1: the same trees from lines of text with white space around them."""
    raw = io.trees_from_lines(spark.read.text(_tree_lines(spark, sf_dir, indent=" \t")))
    keyed = raw.withColumn("tree_id", F.variant_get("tree", "$.k", "string"))
    return _tree_rows(trees.explode_tree(keyed), F.col("tree_id"))


@query("pair_files")
def q_pair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO4 + IO6: C2 as a multi-split pair dataset in files, read back by split; ``n_keys`` distinct keys of ``n_rows`` rows."""
    pairs = fx.c2_pairs(spark, sf_dir).select("chosen", "rejected", _split("pair_id").alias("split"))
    path = f"{ensure_checkpoint_dir(spark)}/pairs-{uuid.uuid4().hex}"
    pairs.write.partitionBy("split").parquet(path)
    read = io.read_pairs(spark, path)
    both = io.select_split(read, "train").unionByName(io.select_split(read, "test"))
    return both.groupBy("split", "chosen", "rejected").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("pair_id").alias("n_keys"))


@query("prompt_files")
def q_prompt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO5 + IO6: benchmark prompts as a JSON dataset of two splits, read back with keys of file and line number."""
    prompts = fx.table(spark, sf_dir, "benchmark").select(F.col("text").alias("prompt"), _split("item_id").alias("split"))
    path = f"{ensure_checkpoint_dir(spark)}/prompts-{uuid.uuid4().hex}"
    prompts.write.partitionBy("split").json(path)
    read = io.read_prompts(spark, path, fmt="json")
    return read.groupBy("split", "prompt").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("prompt_id").alias("n_keys"))


@query("token_logps_long")
def q_token_logps_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LP1 + JN2 on the long layout: a row per item, the label's log-softmax by windows."""
    rows = fx.c5_logits(spark, sf_dir).select("seq_id", F.lit(0).alias("pos"), "label", F.posexplode("logits").alias("item", "logit"))
    t = logps.token_logps_long(rows)
    return t.select("seq_id", F.col("label").cast("bigint").alias("label"), round6("logp").alias("logp"))


#: Queries that run a user's Python by design (U1, U5); all others stay in the JVM.
USER_HOOKS = ("score_texts", "prepare_dpo_encoder", "evaluate_rollouts")
