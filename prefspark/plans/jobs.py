"""Composite jobs (JB1-JB7): the user-level pipelines, each a chain of operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefspark.operators import batching, chat, logps, logsumexp, losses, rollout, skew, tokens, trees
from prefspark.session import Scratch, materialize, shuffles_released
from prefspark.sources import io

#: A model's logits: a table, or a function from sequences to the logits of their positions.
Logits = DataFrame | Callable[[DataFrame], DataFrame]

# Default run settings of the pipelines -- maximum length, batch sizes
# (SFT / RM 4, DPO / PPO 2), PPO epochs and the PPO logging cadence.
MAX_LENGTH = 512
SFT_BATCH, RM_BATCH, DPO_BATCH, PPO_BATCH = 4, 4, 2, 2
PPO_EPOCHS, LOGGING_STEPS = 10, 10


def prepare_sft(spark: SparkSession, trees_path: str | DataFrame, text_path: str | None,
                vocab: DataFrame | tokens.EncoderFactory,
                max_length: int = MAX_LENGTH, batch_size: int = SFT_BATCH, system: str | None = chat.DEFAULT_SYSTEM_PROMPT,
                seed: int = 42, key: str = "tree_id", pad_id: int = tokens.PAD_ID) -> DataFrame:
    """JB1: IO1 -> TR1 -> TR6 -> IO7, then IO3 -> TK2/TK3 -> BA2 -> TK5/TK7.

    ``trees_path`` is a JSONL path or an already loaded VARIANT tree frame (column
    ``tree`` plus ``key``). Returns ``(key, batch_id, input_ids, attention_mask, labels)``;
    with ``text_path`` the ChatML texts are also written as JSONL on the way (the
    reference's hand-over file). ``vocab`` is a word vocabulary, or the factory of an encoder (U1) whose pad is ``pad_id``.
    """
    raw = io.read_trees(spark, trees_path) if isinstance(trees_path, str) else trees_path
    msgs = trees.explode_tree(raw, key=key)
    texts = chat.trees_to_chatml(msgs, system=system, key=key).withColumnRenamed(key, "tree_id")
    if text_path is not None:
        io.write_texts(texts, text_path)
    keyed = texts.select("tree_id", "text")
    enc = tokens.encode_any(keyed, {"input_ids": "text"}, vocab, ["tree_id"], max_length)
    b = batching.with_batches(enc, raw.select(F.col(key).alias("tree_id")), batch_size, "tree_id", seed=seed)
    padded = batching.pad_batch(b, pad_id=pad_id)
    return padded.select("tree_id", "batch_id", "input_ids", "attention_mask",
                         tokens.causal_labels("input_ids", pad_id).alias("labels"))


def prepare_rm(pairs: DataFrame, vocab: DataFrame | tokens.EncoderFactory, split: str | None = None, key: str = "pair_id",
               max_length: int = MAX_LENGTH, batch_size: int = RM_BATCH, seed: int = 42, add_bos: bool = False,
               pad_id: int = tokens.PAD_ID) -> DataFrame:
    """JB2: IO4/IO6 -> TK8 (four columns) -> BA2 -> TK6 shared padding.

    ``pairs`` with a ``split`` column must name the split to prepare, so that no batch mixes
    splits; the column stays in the result. A split without rows raises. ``vocab`` as in ``prepare_sft``.
    """
    pairs, kept = _one_split(pairs, split)
    shaped = tokens.shape_pairs(pairs, vocab, [key], max_length, add_bos=add_bos)
    b = batching.with_batches(shaped, pairs, batch_size, key, seed=seed)
    return batching.pad_pairs(b, pad_id=pad_id).withColumns(kept)


def _one_split(rows: DataFrame, split: str | None) -> tuple[DataFrame, dict]:
    """The rows of ``split`` and the constant column that names it; rows without a split column pass as they are."""
    if "split" not in rows.columns:
        if split is not None:
            raise ValueError("the input has no split column")
        return rows, {}
    if split is None:
        raise ValueError("the input has splits: name the one to prepare")
    chosen = io.select_split(rows, split)
    if chosen.isEmpty():
        raise ValueError(f"no rows in split {split!r}")
    return chosen.drop("split"), {"split": F.lit(split)}


def prepare_dpo(pairs: DataFrame, vocab: DataFrame | tokens.EncoderFactory, split: str | None = None, key: str = "pair_id",
                template: chat.ChatTemplate = chat.CHATML, max_length: int = MAX_LENGTH, batch_size: int = DPO_BATCH,
                chosen_scope: str = "conversation", seed: int = 42, add_bos: bool = False, pad_id: int = tokens.PAD_ID) -> DataFrame:
    """JB3: IO6 -> CT4 -> CT6 -> TK2/TK3 + TK9 -> BA2 -> TK5.

    Returns per pair: padded chosen / rejected ids with masks, the untruncated prompt
    length (counting a begin token if ``add_bos``) and whether either side lost its whole response
    to truncation (S7). Splits as in ``prepare_rm``, ``vocab`` as in ``prepare_sft``; an encoder also gives the prompt's length.
    """
    pairs, kept = _one_split(pairs, split)
    texts = chat.preference_texts(pairs, template, keep=(key,))
    inputs = chat.model_inputs(texts, chosen_scope, template, raw=pairs if chosen_scope == "completion" else None)
    # Both sides encoded in one pass; the untruncated prompt length rides along.
    sides = {"chosen_ids": "chosen_input", "rejected_ids": "rejected_input"}
    if isinstance(vocab, DataFrame):
        with_len = inputs.withColumn("prompt_len", tokens.token_count(F.col("prompt"), add_bos))
        joined = tokens.encode_columns(with_len, sides, vocab, [key], max_length, carry=["prompt_len"], add_bos=add_bos)
    else:
        made = tokens.encode_columns_with(inputs, {**sides, "prompt_ids": "prompt"}, vocab, max_length, add_bos=add_bos)
        joined = made.select(key, F.col("prompt_ids_len").alias("prompt_len"), *sides)
    b = batching.with_batches(joined, pairs, batch_size, key, seed=seed)
    # Each side is padded to its own batch maximum, as the two tokenizer calls do; the
    # response is cut off when the untruncated prompt fills the padded width.
    batch_w = Window.partitionBy("batch_id")
    out = (
        b.withColumn("chosen_cut", F.col("prompt_len") >= F.max(F.size("chosen_ids")).over(batch_w) - 1)
        .withColumn("rejected_cut", F.col("prompt_len") >= F.max(F.size("rejected_ids")).over(batch_w) - 1)
    )
    out = batching.pad_batch(out, "chosen_ids", pad_id=pad_id, mask_col="chosen_mask")
    return batching.pad_batch(out, "rejected_ids", pad_id=pad_id, mask_col="rejected_mask").withColumns(kept)


def prepare_prompts(prompts: DataFrame, vocab: DataFrame | tokens.EncoderFactory, key: str = "prompt_id", text_col: str = "prompt",
                    max_length: int = MAX_LENGTH, batch_size: int = PPO_BATCH, num_epochs: int = PPO_EPOCHS,
                    seed: int = 42, split: str | None = None, add_bos: bool = False, order: str = "sorted",
                    pad_id: int = tokens.PAD_ID) -> DataFrame:
    """JB4: IO5 -> BA1/BA2 per epoch -> TK2/TK3 -> TK5 (prompt batches for rollouts).

    Only the keys are shuffled and numbered for each epoch; texts are encoded once and meet
    their batches by key. ``order``: ``"sorted"`` sorts every epoch by its seeded hashes, ``"permuted"`` numbers the keys
    once and permutes the numbers (``batching.epoch_batches``). Splits as in ``prepare_rm``, ``vocab`` as in ``prepare_sft``.
    """
    prompts, kept = _one_split(prompts, split)
    if order == "permuted":
        b = batching.epoch_batches(prompts, batch_size, key, num_epochs, seed)
    elif order == "sorted":
        e = batching.with_epochs(prompts.select(key), num_epochs)
        b = batching.assign_batches(e, batch_size, key, seed=seed, epoch_col="epoch")
    else:
        raise ValueError(f"unknown order {order!r}")
    enc = tokens.encode_any(prompts, {"input_ids": text_col}, vocab, [key], max_length, add_bos=add_bos)
    return batching.pad_batch(b.join(enc, key), batch_col="step", pad_id=pad_id).withColumns(kept)


def evaluate_rm(scores: DataFrame, split: str = "split") -> DataFrame:
    """JB5 (RM): pairwise loss per pair (LS1/LS2), then mean per split (LS4)."""
    return losses.eval_loss(losses.pairwise_loss(scores), split=split)


def evaluate_dpo(seq_logps: DataFrame, beta: float = 0.1, split: str = "split") -> DataFrame:
    """JB5 (DPO): per-pair log-prob columns -> LS3 -> LS4."""
    return losses.eval_loss(losses.dpo_loss(seq_logps, beta), split=split)


def evaluate_rm_logits(logits: DataFrame, key: str = "pair_id", split: str = "split") -> DataFrame:
    """JB5 (RM) from the scorer's logits: rows ``(key, split, side, logits)``, side 0 chosen and 1 rejected.

    A reward head has one logit (it raises on more or fewer). A pair without one of its sides, or with one twice, raises.
    """
    one = F.when(F.size("logits") == 1, F.col("logits")[0].cast("double")).otherwise(F.raise_error(F.lit("a reward head has one logit")))
    scores = _sides(logits.select(key, split, "side", one.alias("reward")), [key, split], {"reward": ("reward_chosen", "reward_rejected")})
    return evaluate_rm(scores, split)


def evaluate_texts(rollouts: DataFrame, texts: DataFrame, make_predict_fn, max_length: int | None = None, **options) -> DataFrame:
    """JB6 from texts: LP5 -> ``evaluate_rollouts``. ``rollouts`` has no reward yet; ``texts`` has ``(seq_id, prompt, response)``.

    The reward of a sequence is the model's score of prompt + response (CT6), cut to ``max_length`` words; equal texts are
    scored once (``logps.score_distinct``). A sequence without a text raises. ``options`` go to ``evaluate_rollouts``.
    """
    joined = texts.select("seq_id", chat.concat_text("prompt", "response").alias("_text"))
    rewards = logps.score_distinct(joined, "_text", make_predict_fn, ["seq_id"], out="_reward", max_length=max_length).select(
        F.col("seq_id").alias("_seq"), "_reward")
    found = skew.lookup(rollouts, rewards, [("seq_id", "_seq")], ["pos"])
    lost = F.raise_error(F.concat(F.lit("no text for sequence "), F.coalesce(F.col("seq_id").cast("string"), F.lit("NULL"))))
    scored = found.withColumn("reward", F.when(F.col("_seq").isNull(), lost).otherwise(F.col("_reward"))).drop("_seq", "_reward")
    return evaluate_rollouts(scored, **options)


def _sides(rows: DataFrame, keys: list[str], columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows of sides 0 and 1 pivoted to one row per key: ``columns`` names a value's columns of both sides."""
    whole = (F.count(F.lit(1)) == 2) & (F.min("side") == 0) & (F.max("side") == 1)
    pivoted = rows.groupBy(*keys).agg(whole.alias("_whole"), *[
        F.max(F.when(F.col("side") == i, F.col(c))).alias(name) for c, names in columns.items() for i, name in enumerate(names)])
    broken = F.raise_error(F.concat(F.lit("not one row per side for "), F.to_json(F.struct(*keys))))
    names = [n for pair in columns.values() for n in pair]
    return pivoted.select(*keys, *[F.when(F.col("_whole"), F.col(n)).otherwise(broken).alias(n) for n in names])


def sequence_logps(policy: Logits, reference: Logits, sequences: DataFrame, key: str = "pair_id",
                   skip_first: bool = True, mask_padding: bool = False, turn_positions: int = 1 << 20, most_turns: int = 32) -> DataFrame:
    """LP1 -> JN4 -> LP3 from logits: ``(key, side, policy_lp, ref_lp, response_cut)`` for every row of ``sequences``.

    ``policy`` and ``reference`` are logits ``(key, side, pos, logits, label)`` (D11), row ``pos`` scoring token
    ``pos + 1`` (LP2); with a column ``offset`` they are slices of the vocabulary, any number a position. They are
    reduced to mergeable states where they lie, so no logits are shuffled. ``sequences`` has ``(key, side,
    prompt_len, length, n_tokens)``: untruncated prompt length, padded width, tokens without pads. A position
    that one model scores and the other does not raises; a sequence without scored positions has mean 0.0 (S7).

    Logits that are not stored come from two functions, from rows of ``sequences`` to the logits of their positions. Sequences
    are then scored in turns of about ``turn_positions`` positions, at most ``most_turns``: what a turn shuffles is
    removed when it ends, so that disk holds a turn's positions and the means. Every sequence is in one turn.
    """
    if isinstance(policy, DataFrame) != isinstance(reference, DataFrame):
        raise ValueError("policy and reference are both tables or both functions")
    if isinstance(policy, DataFrame):
        return _sequence_means(policy, reference, sequences, key, skip_first, mask_padding)
    spark = sequences.sparkSession
    with Scratch(spark) as scratch:
        with shuffles_released(spark):
            dealt = scratch.written(sequences.withColumn("_turn", F.pmod(F.xxhash64(key, "side"), F.lit(most_turns)).cast("int")), by="_turn")
            positions = dealt.agg(F.coalesce(F.sum(F.greatest(F.col("length") - 1, F.lit(0))), F.lit(0)).alias("n")).first().n
            turns = min(most_turns, max(1, -(-positions // turn_positions)))
            for turn in range(turns):
                part = dealt.where(F.col("_turn").isin(list(range(turn, most_turns, turns)))).drop("_turn")
                means = _sequence_means(policy(part), reference(part), part, key, skip_first, mask_padding)
                means.write.mode("append").parquet(f"{scratch.path}/means")
        return materialize(spark.read.schema(means.schema).parquet(f"{scratch.path}/means"))


def _sequence_means(policy: DataFrame, reference: DataFrame, sequences: DataFrame, key: str, skip_first: bool, mask_padding: bool) -> DataFrame:
    """``sequence_logps`` of two tables of logits, in one go."""
    keys = [key, "side", "pos"]

    def scored(logits: DataFrame, out: str) -> DataFrame:
        whole = logits if "offset" in logits.columns else logits.withColumn("offset", F.lit(0))
        return logsumexp.sliced_token_logps(whole, keys, out=out)

    both = scored(policy, "policy_lp").join(scored(reference, "ref_lp"), keys, "full")
    lone = F.raise_error(F.concat(F.lit("scored by one model only: "), F.to_json(F.struct(*keys))))
    table = both.select(*keys, *[F.when(F.col("policy_lp").isNull() | F.col("ref_lp").isNull(), lone).otherwise(F.col(c)).alias(c)
                                 for c in ("policy_lp", "ref_lp")])
    rows = sequences.select(key, "side", "prompt_len", "length", "n_tokens").join(table, [key, "side"], "left")
    rows = rows.withColumn("is_pad", F.col("pos") + 1 >= F.col("n_tokens"))
    return logps.response_mean(rows, [key, "side"], ["policy_lp", "ref_lp"], skip_first=skip_first, pad_col="is_pad", mask_padding=mask_padding)


def evaluate_dpo_logits(policy: Logits, reference: Logits, sequences: DataFrame, beta: float = losses.DPO_BETA,
                        key: str = "pair_id", split: str = "split", skip_first: bool = True, mask_padding: bool = False) -> DataFrame:
    """JB5 (DPO) from logits: LP1 -> LP3 -> LP4 -> LS3 -> LS4, inputs as in ``sequence_logps``; ``sequences`` also has ``split``."""
    means = sequence_logps(policy, reference, sequences, key, skip_first, mask_padding)
    per_pair = _sides(means, [key], {"policy_lp": ("policy_chosen", "policy_rejected"), "ref_lp": ("ref_chosen", "ref_rejected")})
    splits = sequences.where(F.col("side") == 0).select(key, split)
    return evaluate_dpo(per_pair.join(splits, key), beta, split)


def evaluate_rollouts(rollouts: DataFrame, gamma: float = rollout.GAMMA, lam: float = rollout.LAM,
                      clip: float = rollout.CLIP, kl_coef: float = rollout.KL_COEF,
                      logging_steps: int | None = LOGGING_STEPS, reward_at: str = "last_column") -> DataFrame:
    """JB6: RO1 -> RO2-RO7 -> RO8-RO13 per batch, keeping the logged steps (PR7) when asked."""
    adv = rollout.advantages(rollouts, gamma, lam, reward_at)
    m = rollout.rollout_metrics(adv, clip, kl_coef).withColumn("step", F.col("batch_id") + 1)
    return batching.log_steps(m, logging_steps) if logging_steps else m


def render_prompts(prompts: DataFrame, text_col: str = "prompt", template: chat.ChatTemplate = chat.CHATML,
                   out: str = "input_text") -> DataFrame:
    """JB7: prompts rendered for batch inference (CT1)."""
    return prompts.withColumn(out, chat.render_prompt(F.col(text_col), template))
