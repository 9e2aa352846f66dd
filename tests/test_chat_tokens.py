import pytest
from pyspark.sql import functions as F

from prefspark.functions.exprs import ids_string
from prefspark.operators import chat, tokens


def test_render_prompt_and_pairs(spark):
    df = spark.createDataFrame(
        [(1, "Hi?", [("Hi?", "user"), ("Yes.", "assistant")], [("Hi?", "user"), ("No.", "assistant")])],
        "pair_id long, prompt string, chosen array<struct<content:string,role:string>>, "
        "rejected array<struct<content:string,role:string>>")
    t = chat.preference_texts(df, keep=("pair_id",)).first()
    assert t["prompt"] == "<|im_start|>user\nHi?<|im_end|>\n<|im_start|>assistant\n"
    assert t["chosen"] == "<|im_start|>user\nHi?<|im_end|>\n<|im_start|>assistant\nYes.<|im_end|>\n"
    assert t["rejected"].endswith("No.<|im_end|>\n")
    lit = chat.model_inputs(chat.preference_texts(df, keep=("pair_id",)), "conversation").first()
    assert lit["chosen_input"].count("Hi?") == 2  # S3: the prompt appears twice
    comp = chat.model_inputs(None, "completion", raw=df).first()
    assert comp["chosen_input"] == t["chosen"] and comp["chosen_input"].count("Hi?") == 1


def test_one_message_pair_raises(spark):
    df = spark.createDataFrame([(1, "p", [("p", "user")], [("p", "user")])],
                               "pair_id long, prompt string, chosen array<struct<content:string,role:string>>, "
                               "rejected array<struct<content:string,role:string>>")
    with pytest.raises(Exception, match="fewer than 2"):
        chat.preference_texts(df).collect()


def test_llama3_template(spark):
    df = spark.createDataFrame([("Hello",)], "p string")
    out = df.select(chat.render_prompt(F.col("p"), chat.LLAMA3)).first()[0]
    assert out == ("<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nHello<|eot_id|>"
                   "<|start_header_id|>assistant<|end_header_id|>\n\n")


def _vocab(spark):
    texts = spark.createDataFrame([("b a b c",), ("a b\td\nb",)], "text string")
    return tokens.build_vocab(texts, "text")


def test_build_vocab_order(spark):
    v = {r["token"]: (r["id"], r["count"]) for r in _vocab(spark).collect()}
    assert v["<pad>"] == (0, 0) and v["<unk>"] == (1, 0)
    assert v["<|im_start|>"] == (4, 0) and v["<|im_end|>"] == (5, 0)
    assert v["b"] == (6, 4) and v["a"] == (7, 2) and v["c"] == (8, 1) and v["d"] == (9, 1)


def test_encode_truncate_decode(spark):
    v = _vocab(spark)
    df = spark.createDataFrame([(1, "a b zz c"), (2, ""), (3, "d")], "k long, text string")
    enc = {r["k"]: (r["input_ids"], r["n_tokens"]) for r in tokens.encode(df, "text", v, ["k"]).collect()}
    assert enc == {1: ([7, 6, 1, 8], 4), 2: ([], 0), 3: ([9], 1)}
    right = {r["k"]: r["input_ids"] for r in tokens.encode(df, "text", v, ["k"], max_length=2).collect()}
    left = {r["k"]: r["input_ids"] for r in tokens.encode(df, "text", v, ["k"], max_length=2, side="left").collect()}
    bos = {r["k"]: r["input_ids"] for r in tokens.encode(df, "text", v, ["k"], max_length=2, add_bos=True).collect()}
    assert right[1] == [7, 6] and left[1] == [1, 8] and bos[1] == [2, 7] and bos[2] == [2]
    dec = {r["k"]: r["text"] for r in tokens.decode(tokens.encode(df, "text", v, ["k"]), "input_ids", v,
                                                   ["k"]).collect()}
    assert dec == {1: "a b c", 2: "", 3: "d"}  # unk is a special token and is skipped


def test_masks_labels_response(spark):
    df = spark.createDataFrame([([5, 0, 7], [1, 2], [3])], "ids array<int>, p array<int>, r array<int>")
    r = df.select(tokens.attention_mask("ids").alias("m"), tokens.causal_labels("ids").alias("l"),
                  tokens.attention_mask(F.col("p"), F.lit(4)).alias("pm"),
                  *[c.alias(n) for c, n in zip(tokens.response_tokens("p", "r"), ("full", "new"))]).first()
    assert r["m"] == [1, 1, 1] and r["l"] == [5, -100, 7] and r["pm"] == [1, 1, 0, 0]
    assert r["full"] == [1, 2, 3] and r["new"] == [3]


def test_shape_pairs_degenerate(spark):
    v = _vocab(spark)
    df = spark.createDataFrame([(1, "a b c", "a b d"), (2, "a", "b")], "pair_id long, chosen string, rejected string")
    out = {r["pair_id"]: r for r in tokens.shape_pairs(df, v, ["pair_id"], 2).collect()}
    assert out[1]["degenerate"] and not out[2]["degenerate"]  # S16
    assert out[1]["attention_mask_chosen"] == [1, 1]


def test_token_count_no_join(spark):
    df = spark.createDataFrame([("a  b\t c\n",)], "t string")
    assert df.select(tokens.token_count("t")).first()[0] == 3


def test_encoder_hook(spark):
    df = spark.createDataFrame([("x y",), ("z",)], "text string")

    def factory():
        return lambda t: [len(w) for w in t.split(" ")]

    out = tokens.encode_with(df, "text", factory).select(ids_string("input_ids")).collect()
    assert sorted(r[0] for r in out) == ["1", "1 1"]


def test_salted_shuffle_lookup_equals_broadcast(spark):
    """Above the broadcast bound the lookup is a salted shuffle join; results are identical."""
    texts = spark.createDataFrame([(i, " ".join(["the"] * 30 + [f"w{i % 7}", "a", "the"])) for i in range(40)]
                                  + [(99, "")], "k long, text string")
    v = tokens.build_vocab(texts, "text")
    fast = {r["k"]: r["input_ids"] for r in tokens.encode(texts, "text", v, ["k"]).collect()}
    salted = {r["k"]: r["input_ids"] for r in tokens.encode(texts, "text", v, ["k"], broadcast_max_rows=0,
                                                           salt_buckets=4, hot_tokens=2).collect()}
    assert fast == salted and fast[99] == []
    enc = tokens.encode(texts, "text", v, ["k"])
    d1 = {r["k"]: r["text"] for r in tokens.decode(enc, "input_ids", v, ["k"]).collect()}
    d2 = {r["k"]: r["text"] for r in tokens.decode(enc, "input_ids", v, ["k"], broadcast_max_rows=0,
                                                  salt_buckets=4, hot_tokens=2).collect()}
    assert d1 == d2 and d1[0].startswith("the the")


def test_with_system_and_small_helpers(spark):
    from prefspark.functions.exprs import last_segment, strip_line

    df = spark.createDataFrame([([("user", "hi")], " x \n", "org/Model-1B")],
                               "m array<struct<role:string,content:string>>, line string, name string")
    r = df.select(chat.with_system("m").alias("s"), chat.with_system("m", None).alias("n"),
                  chat.render_messages(chat.with_system("m")).alias("t"),
                  strip_line("line").alias("l"), last_segment("name").alias("seg")).first()
    assert [x["role"] for x in r["s"]] == ["system", "user"] and len(r["n"]) == 1
    assert r["t"].startswith("<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n<|im_start|>user\nhi")
    assert r["seg"] == "Model-1B" and r["l"] == "x"


def test_truncate_array_and_all_ones_mask(spark):
    df = spark.createDataFrame([([1, 2, 3, 4],), ([5],)], "ids array<int>")
    r = sorted(((x["r"], x["l"], x["m"]) for x in df.select(
        tokens.truncate("ids", 2).alias("r"), tokens.truncate("ids", 2, side="left").alias("l"),
        tokens.attention_mask("ids", F.lit(5), mode="all_ones").alias("m")).collect()), key=lambda t: len(t[0]))
    assert r[0] == ([5], [5], [1, 1, 1, 1, 1])
    assert r[1] == ([1, 2], [3, 4], [1, 1, 1, 1, 1])
