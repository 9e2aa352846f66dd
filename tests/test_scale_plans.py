"""Plan-shape checks for the scale claims in the README (run on the smallest tables)."""

from pyspark.sql import functions as F

from __spark_entry__ import queries
from prefspark.operators import tokens
from prefspark.plans import fixtures as fx
from prefspark.plans import jobs
from tests.conftest import SF001


def _final(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan


def test_rollout_chain_has_one_exchange(spark):
    plan = _final(queries()["ppo_loss"](spark, SF001))
    final = plan[plan.find("Final Plan"):plan.find("Initial Plan")]
    shuffles = [ln for ln in final.splitlines() if "Exchange hashpartitioning" in ln]
    # every window, the GAE carry and the per-batch aggregate reuse one exchange on batch_id
    assert len(shuffles) == 1 and "batch_id" in shuffles[0]


def test_encode_broadcasts_counted_vocab_and_regroups_without_second_exchange(spark):
    conv = fx.table(spark, SF001, "conversations")
    v = tokens.build_vocab(conv, "text", min_count=2)
    enc = tokens.encode(conv, "text", v, ["conv_id", "turn"], max_length=16)
    plan = _final(enc)
    final = plan[plan.find("Final Plan"):plan.find("Initial Plan")]
    assert "BroadcastHashJoin" in final
    top = final[:final.find("BroadcastExchange")]
    # one exchange (the text spread) below the aggregate, none between explode and regroup
    assert top.count("Exchange hashpartitioning") == 1
    assert "slice(" in top and "Filter (isnull(pos" not in top  # truncation happens before the explode


def test_filters_and_columns_reach_the_scan(spark):
    df = fx.table(spark, SF001, "conversations").where(F.col("role") == "user").select("conv_id", "text")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)]" in plan
    assert "ReadSchema: struct<conv_id:bigint,role:string,text:string>" in plan


def test_jobs_move_ids_once_and_sort_keys_only(spark):
    """Wide rows are exchanged by batch for padding and not sorted; the key order is numbered before, on keys alone."""
    vocab = tokens.build_vocab(fx.table(spark, SF001, "conversations"), "text", min_count=2)
    flat = fx.c2_pairs(spark, SF001).select("pair_id", "chosen", "rejected")
    runs = {
        "JB1": jobs.prepare_sft(spark, fx.c1_nested_trees(spark, SF001), None, vocab),
        "JB2": jobs.prepare_rm(flat, vocab), "JB3": jobs.prepare_dpo(fx.c2_message_pairs(spark, SF001), vocab),
    }
    for name, df in runs.items():
        plan = _final(df)
        final = plan[plan.find("Final Plan"):plan.find("Initial Plan")]
        by_batch = [ln for ln in final.splitlines() if "Exchange hashpartitioning(batch_id" in ln]
        assert len(by_batch) == 1, name
        # above the padding exchange nothing moves; below it, only JB1's rendering of whole trees is ranged
        assert "Exchange" not in final[:final.index(by_batch[0])], name
        assert final.count("Exchange rangepartitioning") == (1 if name == "JB1" else 0), name
