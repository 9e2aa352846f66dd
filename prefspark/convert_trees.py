"""Convert conversation trees (JSONL, one tree per line) into ChatML training text (JSONL).

    spark-submit -m prefspark.convert_trees --input_file trees.jsonl --output_dir out/
    python -m prefspark.convert_trees --input_file trees.jsonl.gz --output_dir out/ --system ""

Output is a folder of JSON-lines part files with one ``{"text": ...}`` per input tree, in input order: line n of the
parts, taken by name, is tree n.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from prefspark.operators import chat, trees
from prefspark.session import ensure_checkpoint_dir
from prefspark.sources import io


def run(spark: SparkSession, input_file: str, output_dir: str, system: str | None = chat.DEFAULT_SYSTEM_PROMPT) -> int:
    """IO1 -> TR1 -> TR6 -> IO7 in input order; returns the number of texts written."""
    ensure_checkpoint_dir(spark)
    texts = chat.trees_to_chatml(trees.explode_tree(io.read_trees(spark, input_file)), system=system or None)
    return io.write_texts_ordered(texts, output_dir, order="tree_id")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="conversation trees (JSONL) -> ChatML text (JSONL)")
    p.add_argument("--input_file", required=True)
    p.add_argument("--output_dir", required=True)
    p.add_argument("--system", default=chat.DEFAULT_SYSTEM_PROMPT, help="system prompt; empty string omits it")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("prefspark-convert-trees").getOrCreate()
    n = run(spark, a.input_file, a.output_dir, a.system)
    print(f"wrote {n} texts to {a.output_dir}")


if __name__ == "__main__":
    main()
