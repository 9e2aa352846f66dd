"""Stateless operators on a real streaming source (readStream -> memory sink)."""

import os

from pyspark.sql import functions as F

from prefspark.operators import chat, tokens
from prefspark.streaming import render_turns_stream
from tests.conftest import SF001


def test_stateless_render_on_stream(spark, tmp):
    src = os.path.join(tmp, "turns")
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    conv.write.parquet(src)
    stream = spark.readStream.schema(conv.schema).parquet(src)
    out = render_turns_stream(stream).withColumn(
        "prompt", chat.render_prompt(F.col("text"))).withColumn("n_words", tokens.token_count("text"))
    q = out.writeStream.format("memory").queryName("pf_turns").option(
        "checkpointLocation", os.path.join(tmp, "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r["conv_id"], r["turn"]): (r["block"], r["n_words"]) for r in spark.table("pf_turns").collect()}
    want = {(r["conv_id"], r["turn"]): (r["block"], r["n_words"]) for r in render_turns_stream(conv).withColumn(
        "n_words", tokens.token_count("text")).collect()}
    assert got == want and len(got) == conv.count()
