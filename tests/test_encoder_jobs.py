"""Every job with a user's encoder in place of a vocabulary (U1), and rewards from a user's model (LP5, JB6)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefspark.operators import logps, tokens
from prefspark.plans import fixtures as fx
from prefspark.plans import jobs
from prefspark.plans.queries import _length_encoder
from tests.conftest import SF001


@pytest.fixture(scope="module")
def vocab(spark):
    return tokens.build_vocab(fx.table(spark, SF001, "conversations"), "text", min_count=2)


@pytest.fixture(scope="module")
def same_encoder(vocab):
    """An encoder that does what the vocabulary does."""
    ids = {r["token"]: r["id"] for r in vocab.collect()}

    def factory():
        import re

        pat, marker = re.compile(r"[^ \t\r\n]+"), re.compile(r"(<\|[a-z_]+\|>)")
        return lambda text: [ids.get(w, 1) for w in pat.findall(marker.sub(r" \1 ", text))]

    return factory


def same(a, b):
    columns = sorted(a.columns)
    assert sorted(b.columns) == columns
    rows = [sorted(str([r[c] for c in columns]) for r in df.collect()) for df in (a, b)]
    assert rows[0] == rows[1] and rows[0]


def test_rm_and_dpo(spark, vocab, same_encoder):
    flat = fx.c2_pairs(spark, SF001).select("pair_id", "chosen", "rejected")
    same(*[jobs.prepare_rm(flat, v, max_length=20) for v in (vocab, same_encoder)])
    lists = fx.c2_message_pairs(spark, SF001)
    for scope, bos in (("conversation", False), ("completion", True)):
        same(*[jobs.prepare_dpo(lists, v, max_length=40, chosen_scope=scope, add_bos=bos) for v in (vocab, same_encoder)])


def test_sft_and_prompts(spark, vocab, same_encoder):
    nested = fx.c1_nested_trees(spark, SF001)
    same(*[jobs.prepare_sft(spark, nested, None, v, max_length=30) for v in (vocab, same_encoder)])
    bench = fx.table(spark, SF001, "benchmark").select(F.col("item_id").alias("prompt_id"), F.col("text").alias("prompt"))
    for order in ("sorted", "permuted"):
        same(*[jobs.prepare_prompts(bench, v, num_epochs=2, order=order, add_bos=True) for v in (vocab, same_encoder)])


def test_pad_of_the_encoder(spark):
    flat = spark.createDataFrame([(1, "aa b", "ccc"), (2, "d", "e f g")], "pair_id long, chosen string, rejected string")
    rows = jobs.prepare_rm(flat, _length_encoder, pad_id=99).collect()
    assert {r["pair_id"]: (r["input_ids_chosen"], r["input_ids_rejected"]) for r in rows} == {
        1: ([8, 7, 99], [9, 99, 99]), 2: ([7, 99, 99], [7, 7, 7])}


@pytest.mark.parametrize("side, kept", [("right", [2, 7, 8]), ("left", [2, 8, 9])])
def test_lengths_and_cut_flags(spark, side, kept):
    df = spark.createDataFrame([(1, "a bb ccc", "x"), (2, None, ""), (3, "a bb", "a a a a")], "k long, one string, two string")
    out = tokens.encode_columns_with(df, {"i": "one", "j": "two"}, _length_encoder, max_length=3, side=side, add_bos=True)
    assert out.columns == ["k", "one", "two", "i", "i_len", "i_cut", "j", "j_len", "j_cut"]
    got = {r["k"]: r for r in out.collect()}
    assert (got[1]["i"], got[1]["i_len"], got[1]["i_cut"]) == (kept, 4, True)
    assert (got[2]["i"], got[2]["i_len"], got[2]["i_cut"], got[2]["j"]) == ([2], 1, False, [2])
    assert (got[3]["i_cut"], got[3]["j_len"], got[3]["j_cut"]) == (False, 5, True)
    with pytest.raises(ValueError, match="side"):
        tokens.encode_columns_with(df, {"i": "one"}, _length_encoder, side="middle")


def test_equal_texts_are_scored_once(spark, tmp):
    log = f"{tmp}/scored"

    def make():
        def predict(texts):
            with open(log, "a") as f:
                f.writelines(f"{t}\n" for t in texts)
            return np.array([float(len(t)) for t in texts])

        return predict

    rows = [(i, "the same") for i in range(50)] + [(50, "another text here"), (51, None), (52, "")]
    df = spark.createDataFrame(rows, "k long, t string")
    got = {r["k"]: r["s"] for r in logps.score_distinct(df, "t", make, ["k"], out="s", max_length=2).collect()}
    assert got == {**{i: 8.0 for i in range(50)}, 50: float(len("another text")), 51: None, 52: 0.0}
    assert sorted(open(log).read().split("\n")[:-1]) == ["", "another text", "the same"]


def test_rollouts_from_texts(spark):
    def make():
        return lambda texts: np.array([float(len(t)) for t in texts])

    texts = fx.c2_pairs(spark, SF001).select(F.col("pair_id").alias("seq_id"), "prompt", F.col("chosen").alias("response"))
    bare = fx.c4_rollouts(spark, SF001).drop("reward")
    got = jobs.evaluate_texts(bare, texts, make, logging_steps=None)
    rewards = texts.select("seq_id", F.length(F.concat("prompt", "response")).cast("double").alias("reward"))
    want = jobs.evaluate_rollouts(bare.join(rewards, "seq_id"), logging_steps=None)
    key = lambda df: sorted((r["step"], round(r["loss"], 6), round(r["raw_reward_mean"], 6)) for r in df.collect())
    assert key(got) == key(want)
    with pytest.raises(Exception, match="no text for sequence"):
        jobs.evaluate_texts(bare, texts.where("seq_id % 2 = 0"), make, logging_steps=None).collect()
