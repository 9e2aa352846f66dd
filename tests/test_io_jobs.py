import gzip
import json
import os

from pyspark.sql import functions as F

from prefspark.operators import rollout, tokens
from prefspark.plans import fixtures as fx
from prefspark.plans import jobs
from prefspark.sources import io
from prefspark.streaming import chatml_stream, render_turns_stream
from tests.conftest import SF001

TREES = [
    {"prompt": {"role": "prompter", "text": "Wie geht's? ü", "replies": [{"role": "assistant", "text": "Gut."}]}},
    {"prompt": {"role": "prompter", "text": "one", "replies": [{"role": "assistant", "text": "two", "replies": [
        {"role": "prompter", "text": "three"}]}]}},
]


def _jsonl(path, objs, gz=False):
    op = gzip.open if gz else open
    with op(path, "wt", encoding="utf-8") as f:
        for o in objs:
            f.write(json.dumps(o, ensure_ascii=False) + "\n")
    return path


def test_texts_round_trip_keeps_non_ascii(spark, tmp):
    df = spark.createDataFrame([("é ü <|im_end|>",)], "text string")
    out = os.path.join(tmp, "texts")
    io.write_texts(df, out)
    raw = "".join(open(os.path.join(out, f), encoding="utf-8").read() for f in os.listdir(out) if f.endswith(".json"))
    assert "é ü" in raw  # not escaped
    back = io.read_texts(spark, out, "train").first()
    assert back["text"] == "é ü <|im_end|>" and back["split"] == "train"


def test_pairs_split_pruning_and_shaped_sink(spark, tmp):
    root = os.path.join(tmp, "pairs")
    df = spark.createDataFrame([("a", "b", "train"), ("c", "d", "test")], "chosen string, rejected string, split string")
    df.write.partitionBy("split").parquet(root)
    pairs = io.read_pairs(spark, root)
    test = io.select_split(pairs, "test")
    assert [r["chosen"] for r in test.collect()] == ["c"]
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan
    io.write_shaped(pairs.withColumn("n", F.length("chosen")), os.path.join(tmp, "shaped"))
    assert sorted(os.listdir(os.path.join(tmp, "shaped")))[-2:] == ["split=test", "split=train"]
    prompts = os.path.join(tmp, "prompts")
    spark.createDataFrame([("q", "train")], "prompt string, split string").write.partitionBy("split").json(prompts)
    assert io.read_prompts(spark, prompts, fmt="json").first()["prompt"] == "q"


def test_gzip_trees(spark, tmp):
    p = _jsonl(os.path.join(tmp, "t.jsonl.gz"), TREES, gz=True)
    df = io.read_trees(spark, p)
    from prefspark.operators import trees

    assert trees.explode_tree(df).count() == 5


def test_prepare_sft_end_to_end(spark, tmp):
    p = _jsonl(os.path.join(tmp, "t.jsonl"), TREES)
    vocab = tokens.build_vocab(spark.createDataFrame([("one two three Gut.",)], "text string"), "text")
    out = jobs.prepare_sft(spark, p, os.path.join(tmp, "chatml"), vocab, max_length=6, batch_size=4)
    rows = out.collect()
    assert len(rows) == 2 and len({len(r["input_ids"]) for r in rows}) == 1
    for r in rows:
        assert [x for x, m in zip(r["labels"], r["attention_mask"]) if m == 0] == [-100] * r["attention_mask"].count(0)
    assert io.read_texts(spark, os.path.join(tmp, "chatml")).count() == 2


def test_prepare_rm_dpo_prompts_and_render(spark):
    pairs = fx.c2_message_pairs(spark, SF001)
    vocab = tokens.build_vocab(fx.table(spark, SF001, "conversations"), "text", min_count=2)
    dpo = jobs.prepare_dpo(pairs, vocab, split=None, max_length=64, batch_size=2)
    r = dpo.first()
    assert len(r["chosen_ids"]) == len(r["chosen_mask"]) and "chosen_cut" in dpo.columns
    flat = fx.c2_pairs(spark, SF001).select("pair_id", "chosen", "rejected")
    rm = jobs.prepare_rm(flat, vocab, max_length=16)
    for x in rm.collect():
        assert len(x["input_ids_chosen"]) == len(x["input_ids_rejected"])
    bench = fx.table(spark, SF001, "benchmark").select(F.col("item_id").alias("prompt_id"), F.col("text").alias("prompt"))
    pp = jobs.prepare_prompts(bench, vocab, max_length=32, batch_size=2, num_epochs=2)
    n = bench.count()
    assert pp.count() == 2 * n and pp.agg(F.max("step")).first()[0] == 2 * ((n + 1) // 2)
    assert jobs.render_prompts(bench).first()["input_text"].endswith("<|im_start|>assistant\n")


def test_evaluate_rollouts_logs_every_tenth(spark):
    roll = fx.c4_rollouts(spark, SF001)
    m = jobs.evaluate_rollouts(roll, logging_steps=10).collect()
    assert all(r["step"] % 10 == 0 for r in m)
    allm = jobs.evaluate_rollouts(roll, logging_steps=None)
    assert allm.count() == roll.select("batch_id").distinct().count()
    assert abs(allm.agg(F.sum("reward_mean")).first()[0]) < 1e-9  # centred rewards (S11)
    assert rollout.GAMMA == 0.99


def test_streaming_tree_conversion(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    _jsonl(os.path.join(src, "a.jsonl"), TREES)
    out = os.path.join(tmp, "out")
    q = chatml_stream(spark, src, out, os.path.join(tmp, "ck"))
    q.awaitTermination(120)
    texts = io.read_texts(spark, out + "/batch=0").collect()
    assert len(texts) == 2 and all(t["text"].startswith("<|im_start|>system") for t in texts)
    turns = spark.createDataFrame([("user", "x")], "role string, text string")
    assert render_turns_stream(turns).first()["block"] == "<|im_start|>user\nx<|im_end|>"


def test_prepare_dpo_values_match_direct_encode(spark):
    from prefspark.operators import chat

    pairs = fx.c2_message_pairs(spark, SF001)
    vocab = tokens.build_vocab(fx.table(spark, SF001, "conversations"), "text", min_count=2)
    out = {r["pair_id"]: r for r in jobs.prepare_dpo(pairs, vocab, split=None, max_length=40).collect()}
    inputs = chat.model_inputs(chat.preference_texts(pairs, keep=("pair_id",)), "conversation")
    direct_c = {r["pair_id"]: r["input_ids"] for r in tokens.encode(inputs, "chosen_input", vocab, ["pair_id"],
                                                                    max_length=40).collect()}
    direct_r = {r["pair_id"]: r["input_ids"] for r in tokens.encode(inputs, "rejected_input", vocab, ["pair_id"],
                                                                    max_length=40).collect()}
    plen = {r["pair_id"]: r["n"] for r in inputs.select("pair_id", tokens.token_count("prompt").alias("n")).collect()}
    assert set(out) == set(direct_c)
    for k, r in out.items():
        assert r["chosen_ids"][:sum(r["chosen_mask"])] == direct_c[k]
        assert r["rejected_ids"][:sum(r["rejected_mask"])] == direct_r[k]
        assert r["prompt_len"] == plen[k]


def test_convert_trees_entry_point(spark, tmp):
    from prefspark import convert_trees

    p = _jsonl(os.path.join(tmp, "t.jsonl"), TREES)
    out = os.path.join(tmp, "chatml")
    assert convert_trees.run(spark, p, out) == 2
    texts = sorted(r["text"] for r in io.read_texts(spark, out).collect())
    assert texts[0].startswith("<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n<|im_start|>user\n")
    out2 = os.path.join(tmp, "chatml_nosys")
    convert_trees.run(spark, p, out2, system="")
    assert all(not r["text"].startswith("<|im_start|>system") for r in io.read_texts(spark, out2).collect())


def test_evaluate_rm_and_dpo(spark):
    import math

    scores = spark.createDataFrame([(1.0, 0.0, "train"), (0.0, 0.0, "train"), (2.0, -2.0, "test")],
                                   "reward_chosen double, reward_rejected double, split string")
    rm = {r["split"]: (r["mean_loss"], r["n_rows"]) for r in jobs.evaluate_rm(scores).collect()}
    assert rm["train"][1] == 2 and abs(rm["train"][0] - (math.log1p(math.exp(-1)) + math.log(2)) / 2) < 1e-12
    assert abs(rm["test"][0] - math.log1p(math.exp(-4))) < 1e-12
    seq = spark.createDataFrame([(-1.0, -2.0, -1.0, -2.0, "test"), (-1.0, -3.0, -2.0, -2.0, "test")],
                                "policy_chosen double, policy_rejected double, ref_chosen double, "
                                "ref_rejected double, split string")
    d = jobs.evaluate_dpo(seq, beta=0.1).first()
    want = (math.log(2) + math.log1p(math.exp(-0.2))) / 2
    assert d["n_rows"] == 2 and abs(d["mean_loss"] - want) < 1e-12
