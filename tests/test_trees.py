import json
import os

import pytest
from pyspark.sql import functions as F

from prefspark.operators import chat, trees
from prefspark.plans import fixtures as fx
from prefspark.sources import io
from tests.conftest import SF001


def _write(tmp, lines, name="t.jsonl"):
    p = os.path.join(tmp, name)
    with open(p, "w", encoding="utf-8") as f:
        for line in lines:
            f.write(line if isinstance(line, str) else json.dumps(line, ensure_ascii=False))
            f.write("\n")
    return p


TREE = {"prompt": {"role": "prompter", "text": "Bonjour é", "replies": [
    {"role": "assistant", "text": "a1", "replies": [
        {"role": "prompter", "text": "q2 <|im_end|> literal", "replies": [{"role": "assistant", "text": "a3"}]}]},
    {"role": "assistant", "text": "a2"},
]}}


def test_explode_tree_preorder_and_paths(spark, tmp):
    p = _write(tmp, [TREE, {"prompt": {"role": "prompter", "text": "solo"}}])
    msgs = trees.explode_tree(io.read_trees(spark, p))
    got = [(r["path"], r["role"], r["text"]) for r in msgs.orderBy("tree_id", "path").collect()]
    assert got[:5] == [([], "prompter", "Bonjour é"), ([0], "assistant", "a1"),
                       ([0, 0], "prompter", "q2 <|im_end|> literal"), ([0, 0, 0], "assistant", "a3"),
                       ([1], "assistant", "a2")]
    assert got[5] == ([], "prompter", "solo")


SYSTEM_TEXT = "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"
TREE_TEXT = (
    "<|im_start|>user\nBonjour é<|im_end|>\n<|im_start|>assistant\na1<|im_end|>\n"
    "<|im_start|>user\nq2 <|im_end|> literal<|im_end|>\n<|im_start|>assistant\na3<|im_end|>\n"
    "<|im_start|>assistant\na2<|im_end|>\n"
)


def test_trees_to_chatml_texts(spark, tmp):
    trees_in = [TREE, {"prompt": {"role": "prompter", "text": "solo"}},
                {"prompt": {"role": "prompter", "text": "x", "replies": None}}]
    out = chat.trees_to_chatml(trees.explode_tree(io.read_trees(spark, _write(tmp, trees_in))))
    # replies: null is accepted leniently (no children), see S17
    assert sorted(r["text"] for r in out.collect()) == [
        SYSTEM_TEXT + TREE_TEXT,
        SYSTEM_TEXT + "<|im_start|>user\nsolo<|im_end|>\n",
        SYSTEM_TEXT + "<|im_start|>user\nx<|im_end|>\n",
    ]


def test_system_prompt_omitted_when_none(spark, tmp):
    out = chat.trees_to_chatml(trees.explode_tree(io.read_trees(spark, _write(tmp, [TREE]))), system=None)
    assert out.first()["text"] == TREE_TEXT


def test_unknown_role_raises(spark, tmp):
    p = _write(tmp, [{"prompt": {"role": "narrator", "text": "x"}}])
    with pytest.raises(Exception, match="unknown role"):
        chat.trees_to_chatml(trees.explode_tree(io.read_trees(spark, p))).collect()


def test_missing_text_raises(spark, tmp):
    p = _write(tmp, [{"prompt": {"role": "prompter"}}])
    with pytest.raises(Exception, match="without text"):
        trees.explode_tree(io.read_trees(spark, p)).collect()


def test_malformed_line_raises(spark, tmp):
    p = _write(tmp, ['{"prompt": {"role": "prompter", "text": "x"}', json.dumps(TREE)])
    with pytest.raises(Exception):
        trees.explode_tree(io.read_trees(spark, p)).collect()


def test_deep_tree(spark, tmp):
    node = {"role": "assistant", "text": "leaf"}
    for i in range(120):
        node = {"role": "prompter" if i % 2 else "assistant", "text": f"n{i}", "replies": [node]}
    p = _write(tmp, [{"prompt": node}])
    msgs = trees.explode_tree(io.read_trees(spark, p))
    assert msgs.count() == 121
    assert msgs.agg(F.max(F.size("path"))).first()[0] == 120


def _c1_python(spark):
    nodes = [r.asDict() for r in fx.c1_tree_nodes(spark, SF001).collect()]
    kids = {}
    for n in nodes:
        kids.setdefault(n["parent_id"], []).append(n)
    order = {}
    for root in kids[None]:
        stack, seq = [root], []
        while stack:
            n = stack.pop()
            seq.append(n["id"])
            stack.extend(sorted(kids.get(n["id"], []), key=lambda c: c["ord"], reverse=True))
        for i, nid in enumerate(seq):
            order[nid] = (root["tree_id"], i)
    return nodes, kids, order


def test_linearize_matches_recursive_dfs(spark):
    nodes, _, order = _c1_python(spark)
    msgs = trees.linearize_messages(fx.c1_tree_nodes(spark, SF001))
    got = {}
    for r in msgs.select("tree_id", "id", "path").collect():
        got[r["id"]] = (r["tree_id"], r["path"])
    by_tree = {}
    for nid, (t, path) in got.items():
        by_tree.setdefault(t, []).append((path, nid))
    ranks = {nid: (t, i) for t, lst in by_tree.items() for i, (_, nid) in enumerate(sorted(lst))}
    assert ranks == order and len(got) == len(nodes)


def test_nested_and_adjacency_forms_agree(spark, tmp):
    """TR1 on nested JSON built from C1 equals TR2 on the adjacency rows."""
    nodes, kids, _ = _c1_python(spark)

    def nest(n):
        out = {"role": n["role"], "text": n["text"]}
        ch = sorted(kids.get(n["id"], []), key=lambda c: c["ord"])
        if ch:
            out["replies"] = [nest(c) for c in ch]
        return out

    roots = sorted(kids[None], key=lambda r: r["tree_id"])
    p = _write(tmp, [{"tree": str(r["tree_id"]), "prompt": nest(r)} for r in roots])
    nested = chat.trees_to_chatml(trees.explode_tree(io.read_trees(spark, p, key="tree")))
    adj = chat.trees_to_chatml(trees.linearize_messages(fx.c1_tree_nodes(spark, SF001)))
    a = {str(r["tree_id"]): r["text"] for r in nested.collect()}
    b = {str(r["tree_id"]): r["text"] for r in adj.collect()}
    assert a == b and len(a) == len(roots)


def test_orphan_raises(spark):
    df = spark.createDataFrame([(1, 1, None, 0, "prompter", "a"), (1, 2, 99, 1, "assistant", "b")],
                               "tree_id long, id long, parent_id long, ord int, role string, text string")
    with pytest.raises(Exception, match="orphan"):
        trees.linearize_messages(df).collect()


def test_single_node_tree(spark):
    df = spark.createDataFrame([(7, 1, None, 0, "prompter", "only")],
                               "tree_id long, id long, parent_id long, ord int, role string, text string")
    out = chat.trees_to_chatml(trees.linearize_messages(df)).first()
    assert out["text"] == ("<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"
                           "<|im_start|>user\nonly<|im_end|>\n")


def test_map_role(spark):
    df = spark.createDataFrame([("prompter",), ("assistant",)], "role string")
    assert [r[0] for r in df.select(trees.map_role(F.col("role"))).collect()] == ["user", "assistant"]


def test_hot_group_is_rendered_in_pieces(spark):
    """One conversation that holds nearly all rows comes out in order, next to small ones."""
    rows = [(1, t, "user", f"m{t}") for t in range(3000)] + [(2, 0, "user", "x"), (2, 1, "assistant", "y")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r["conv_id"]: (r["text"], r["n_messages"]) for r in chat.conversations_to_chatml(conv).collect()}
    assert got[2] == ("<|im_start|>user\nx<|im_end|>\n<|im_start|>assistant\ny<|im_end|>\n", 2)
    assert got[1][0].split("\n")[1::2] == [f"m{t}<|im_end|>" for t in range(3000)] and got[1][1] == 3000


def test_ids_may_restart_in_each_tree(spark):
    rows = [(t, i, None if i == 1 else 1, i, "prompter", f"{t}.{i}") for t in (10, 11, 12) for i in (1, 2, 3)]
    df = spark.createDataFrame(rows, "tree_id long, id long, parent_id long, ord int, role string, text string")
    got = trees.linearize_messages(df).collect()
    assert sorted((r["tree_id"], r["id"], r["path"]) for r in got) == [
        (t, i, [] if i == 1 else [i]) for t in (10, 11, 12) for i in (1, 2, 3)]
    with pytest.raises(ValueError, match="twice"):
        trees.linearize_messages(df.unionAll(df.limit(1)))


@pytest.mark.parametrize("role, text", [(None, "x"), ("user", None)])
def test_message_without_role_or_text_raises(spark, role, text):
    conv = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, role, text)], "conv_id long, turn long, role string, text string")
    with pytest.raises(Exception, match="message without"):
        chat.conversations_to_chatml(conv).collect()


def test_cycle_raises(spark):
    df = spark.createDataFrame([(1, 1, None, 0, "prompter", "r"), (1, 2, 3, 1, "assistant", "a"),
                                (1, 3, 2, 1, "prompter", "b")],
                               "tree_id long, id long, parent_id long, ord int, role string, text string")
    with pytest.raises(Exception, match="cycle"):
        trees.linearize_messages(df, max_rounds=6).collect()


def test_blank_line_is_skipped(spark, tmp):
    """The JSON reader skips blank lines (the reference would raise); documented as lenient."""
    p = _write(tmp, [TREE, "", {"prompt": {"role": "prompter", "text": "solo"}}])
    assert chat.trees_to_chatml(trees.explode_tree(io.read_trees(spark, p))).count() == 2


def test_replies_not_a_list_raises(spark, tmp):
    p = _write(tmp, [{"prompt": {"role": "prompter", "text": "x", "replies": {"role": "assistant", "text": "y"}}}])
    with pytest.raises(Exception):
        trees.explode_tree(io.read_trees(spark, p)).collect()


def test_chain_of_400_and_star_in_one_pass(spark, tmp):
    """No checkpoint, shuffle or join per level, however deep or wide a tree is."""
    node = {"role": "assistant", "text": "leaf"}
    for i in range(400):
        node = {"role": "prompter" if i % 2 else "assistant", "text": f"n{i}", "replies": [node]}
    star = {"role": "prompter", "text": "root", "replies": [{"role": "assistant", "text": f"r{i}", "replies": []} for i in range(50_000)]}
    msgs = trees.explode_tree(io.read_trees(spark, _write(tmp, [{"prompt": node, "k": "chain"}, {"prompt": star, "k": "star"}]), key="k"))
    plan = msgs._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Join", "ExistingRDD", "Union"))
    got = {}
    for r in msgs.collect():
        got.setdefault(r["tree_id"], []).append((r["path"], r["text"]))
    assert sorted(got["chain"]) == sorted(([0] * d, "leaf" if d == 400 else f"n{399 - d}") for d in range(401))
    assert sorted(got["star"]) == sorted([([], "root")] + [([i], f"r{i}") for i in range(50_000)])


def test_branching_levels_and_max_depth(spark, tmp):
    def grow(depth):
        node = {"role": "prompter" if depth % 2 else "assistant", "text": f"{depth} \"replies\": ["}
        return node | ({"replies": [grow(depth - 1) for _ in range(3)]} if depth else {})

    raw = io.read_trees(spark, _write(tmp, [{"prompt": grow(5)}]))
    paths = sorted(tuple(r["path"]) for r in trees.explode_tree(raw).collect())
    assert len(paths) == sum(3**d for d in range(6)) == len(set(paths)) and max(map(len, paths)) == 5
    assert trees.explode_tree(raw, max_depth=5).count() == len(paths)
    with pytest.raises(Exception, match="max_depth"):
        trees.explode_tree(raw, max_depth=3).collect()
