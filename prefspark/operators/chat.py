"""Chat rendering: ChatML blocks, tree texts, prompt / pair rendering (TR3-TR6, CT1-CT6, PR5).

Templates are data (CT5): a role's prefix is ``role_open + role + role_close``, every
message ends with ``suffix``, messages are joined with ``separator``. All rendering is
``concat`` / ``transform`` / ``array_join`` on columns -- no UDF.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.operators.trees import map_role

# ChatML markers and the default system prompt of the tree converter.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant."


@dataclass(frozen=True)
class ChatTemplate:
    role_open: str
    role_close: str
    suffix: str
    separator: str = ""
    bos: str = ""
    generation_header: str = ""

    def prefix(self, role: Column) -> Column:
        return F.concat(F.lit(self.role_open), role, F.lit(self.role_close))

    def message(self, role: Column, content: Column) -> Column:
        return F.concat(self.prefix(role), content, F.lit(self.suffix))


# ChatML as a template, and the plain Llama-3 header format
# (the dated system block some Llama-3.x templates inject is not reproduced).
CHATML = ChatTemplate(
    role_open=IM_START,
    role_close="\n",
    suffix=IM_END + "\n",
    generation_header=IM_START + "assistant\n",
)
LLAMA3 = ChatTemplate(
    role_open="<|start_header_id|>",
    role_close="<|end_header_id|>\n\n",
    suffix="<|eot_id|>",
    bos="<|begin_of_text|>",
    generation_header="<|start_header_id|>assistant<|end_header_id|>\n\n",
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- TR3-TR6


def chatml_block(role, content) -> Column:
    """TR4: ``<|im_start|>{role}\\n{content}<|im_end|>`` -- markers inside content are not escaped.
    A NULL role or text raises (a block of NULL would vanish from the joined text)."""
    role, content = (F.when(c.isNull(), F.raise_error(F.lit(f"message without {what}"))).otherwise(c)
                     for c, what in ((_c(role), "role"), (_c(content), "text")))
    return F.concat(F.lit(IM_START), role, F.lit("\n"), content, F.lit(IM_END))


def with_system(messages, system: str | None = DEFAULT_SYSTEM_PROMPT) -> Column:
    """TR3 on a message list: prepend ``{role: system, content: system}`` when the setting is
    truthy (None or '' leaves the list unchanged)."""
    m = _c(messages)
    if not system:
        return m
    return F.concat(F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content"))), m)


def system_block(system: str | None) -> str:
    """TR3 as a literal: the rendered system block, or '' when the setting is None / empty."""
    return f"{IM_START}system\n{system}{IM_END}\n" if system else ""


def join_blocks(df: DataFrame, key: list[str], position: str, block: str = "block", out: str = "text",
                system: str | None = None) -> DataFrame:
    """TR5: blocks of each group in ``position`` order, joined by '\n', plus one trailing '\n'.

    ``collect_list`` has no order guarantee, so lists are sorted on a struct whose first
    field is the position (an int or an ARRAY<INT> tree path: arrays sort prefix-first).

    A group is one output text, so its final row is whole by definition; the work to
    build it need not be. Rows are range-partitioned on (key, position), so a hot group
    spans many tasks in contiguous position ranges; each range is rendered in parallel, and
    the final step only concatenates one partial string per range in partition (= position) order.
    """
    head = F.lit(system_block(system))
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranged = (
        df.select(*key, F.col(position).alias("_pos"), F.col(block).alias("_b"))
        .repartitionByRange(n, *[F.col(k) for k in key], F.col("_pos"))
        .withColumn("_part", F.spark_partition_id())
    )
    partial = ranged.groupBy(*key, "_part").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("_pos", "_b"))).getField("_b"), "\n").alias("_s"),
        F.count(F.lit(1)).alias("_n"),
    )
    return partial.groupBy(*key).agg(
        F.concat(head, F.array_join(F.sort_array(F.collect_list(F.struct("_part", "_s"))).getField("_s"), "\n"),
                 F.lit("\n")).alias(out),
        F.sum("_n").alias("n_messages"),
    )


def conversations_to_chatml(conv: DataFrame, system: str | None = None) -> DataFrame:
    """TR6 on the flat table ``(conv_id, turn, role, text)``: one ChatML text per conversation."""
    blocks = conv.select("conv_id", "turn", chatml_block("role", "text").alias("block"))
    return join_blocks(blocks, ["conv_id"], "turn", system=system)


def trees_to_chatml(messages: DataFrame, system: str | None = DEFAULT_SYSTEM_PROMPT,
                    key: str = "tree_id") -> DataFrame:
    """TR6: message rows ``(tree_id, path, role, text)`` (TR1/TR2 output) -> one text per tree.

    Roles are mapped prompter->user (PR4, unknown roles raise); the system block is added
    once per tree before the root (S2); siblings are flattened in pre-order (S1).
    """
    blocks = messages.select(key, "path", chatml_block(map_role(F.col("role")), F.col("text")).alias("block"))
    return join_blocks(blocks, [key], "path", system=system)


# ---------------------------------------------------------------- CT1-CT6, PR5


def message(role: str, content) -> Column:
    return F.struct(F.lit(role).alias("role"), _c(content).alias("content"))


def render_messages(messages, template: ChatTemplate = CHATML, add_generation_prompt: bool = False) -> Column:
    """Render an ``ARRAY<STRUCT<role, content>>`` column with a template."""
    body = F.array_join(F.transform(_c(messages), lambda m: template.message(m["role"], m["content"])),
                        template.separator)
    parts = [F.lit(template.bos), body]
    if add_generation_prompt:
        parts.append(F.lit(template.separator + template.generation_header if template.separator
                           else template.generation_header))
    return F.concat(*parts)


def render_prompt(prompt, template: ChatTemplate = CHATML) -> Column:
    """CT1: one user message followed by the generation header."""
    return render_messages(F.array(message("user", prompt)), template, add_generation_prompt=True)


def answer_content(messages, index: int = 1) -> Column:
    """PR5: ``messages[index].content``; a shorter list raises instead of yielding NULL."""
    m = _c(messages)
    return F.when(F.size(m) > index, m[index]["content"]).otherwise(
        F.raise_error(F.lit(f"preference message list has fewer than {index + 1} messages"))
    )


def preference_texts(pairs: DataFrame, template: ChatTemplate = CHATML, keep: tuple[str, ...] = ()) -> DataFrame:
    """CT2-CT4: message-list pairs ``(prompt, chosen[], rejected[])`` -> ``(prompt, chosen, rejected)`` texts.

    The prompt is rendered with the generation header; chosen and rejected are each
    the two-message conversation (user prompt, element 1 of the list) without it.
    All original columns are replaced (PR1) except those named in ``keep``.
    """
    user = message("user", F.col("prompt"))
    chosen = F.array(user, message("assistant", answer_content("chosen")))
    rejected = F.array(user, message("assistant", answer_content("rejected")))
    return pairs.select(
        *keep,
        render_prompt(F.col("prompt"), template).alias("prompt"),
        render_messages(chosen, template).alias("chosen"),
        render_messages(rejected, template).alias("rejected"),
    )


def model_inputs(texts: DataFrame, chosen_scope: str = "conversation", template: ChatTemplate = CHATML,
                 raw: DataFrame | None = None) -> DataFrame:
    """CT6: the strings the DPO scorer tokenizes.

    ``conversation`` (literal, S3): ``prompt + chosen`` where chosen already holds the
    rendered prompt, so the prompt text appears twice. ``completion``: prompt + the
    answer's content + suffix, i.e. the conversation once.
    """
    if chosen_scope == "conversation":
        return texts.withColumn("chosen_input", F.concat("prompt", "chosen")).withColumn(
            "rejected_input", F.concat("prompt", "rejected"))
    if chosen_scope == "completion":
        if raw is None:
            raise ValueError("chosen_scope='completion' needs the raw pairs (answer contents)")
        return raw.select(
            *[c for c in raw.columns if c != "prompt"],
            render_prompt(F.col("prompt"), template).alias("prompt"),
            F.concat(render_prompt(F.col("prompt"), template), answer_content("chosen"),
                     F.lit(template.suffix)).alias("chosen_input"),
            F.concat(render_prompt(F.col("prompt"), template), answer_content("rejected"),
                     F.lit(template.suffix)).alias("rejected_input"),
        )
    raise ValueError(f"unknown chosen_scope {chosen_scope!r}")


def concat_text(prompt, response) -> Column:
    """CT6 / S15: plain ``prompt + response`` (the reward input; no template)."""
    return F.concat(_c(prompt), _c(response))
