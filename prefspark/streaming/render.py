"""Incremental conversion of arriving data (the reference itself has no streams, see README).

Stateless operators (PR2, PR4, TR4, CT1-CT6) run unchanged on a streaming DataFrame;
the tree flattening loop and batch-scoped operators (BA2, TK5, RO1) need a bounded
input, so they run per micro-batch inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.operators import chat, trees


def chatml_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_location: str,
                  system: str | None = chat.DEFAULT_SYSTEM_PROMPT, available_now: bool = True):
    """Convert tree JSONL files as they land in ``input_dir`` into ChatML JSONL in ``output_dir``.

    Each micro-batch is flattened (TR1) and rendered (TR6) as a bounded job and written
    under ``batch=<id>`` with overwrite, so a replayed batch after a failure rewrites
    the same folder instead of duplicating rows.
    """
    src = (
        spark.readStream.option("singleVariantColumn", "tree")
        .option("mode", "FAILFAST")
        .json(input_dir)
    )

    def _one(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn("tree_id", F.concat_ws(":", F.lit(batch_id).cast("string"),
                                                        F.monotonically_increasing_id().cast("string")))
        msgs = trees.explode_tree(keyed)
        texts = chat.trees_to_chatml(msgs, system=system)
        texts.select("text").write.mode("overwrite").json(f"{output_dir}/batch={batch_id}")

    w = src.writeStream.foreachBatch(_one).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def render_turns_stream(turns: DataFrame) -> DataFrame:
    """Stateless TR4 on a streaming (or batch) table of turns: one ChatML block per row."""
    return turns.withColumn("block", chat.chatml_block(F.col("role"), F.col("text")))
