import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefspark.operators import logps, losses, rollout, sampling


def test_nucleus_minimal_and_draw(spark):
    rows = [(1, i, float(v)) for i, v in enumerate([2.0, 1.0, 0.5, -1.0, -3.0])]
    df = spark.createDataFrame(rows, "seq_id long, item int, logit double")
    n = sampling.nucleus(df, top_p=0.9, temperature=0.7)
    kept = sorted((r["rank"], r["prob"]) for r in n.collect())
    probs = [p for _, p in kept]
    assert sum(probs) >= 0.9 and sum(probs[:-1]) < 0.9  # reaches p, and minimal
    z = np.exp(np.array([2.0, 1.0, 0.5, -1.0, -3.0]) / 0.7)
    assert probs[0] == pytest.approx(z[0] / z.sum())
    drawn = sampling.sample_one(n, seed=3).first()["item"]
    assert drawn in {r["item"] for r in n.collect()}


def test_token_logps_row_and_long(spark):
    lg = [0.5, -1.0, 2.0]
    df = spark.createDataFrame([(1, lg, 2)], "seq_id long, logits array<double>, label int")
    got = logps.token_logps(df).first()["logp"]
    want = lg[2] - math.log(sum(math.exp(x) for x in lg))
    assert got == pytest.approx(want, abs=1e-12)
    long = spark.createDataFrame([(1, 0, i, v, 2) for i, v in enumerate(lg)],
                                 "seq_id long, pos int, item int, logit double, label int")
    assert logps.token_logps_long(long).first()["logp"] == pytest.approx(want, abs=1e-12)


def test_shift_and_response_mean(spark):
    df = spark.createDataFrame([(1, p, t) for p, t in enumerate([10, 11, 12, 13])], "seq_id long, pos int, token int")
    s = [(r["pos"], r["label"]) for r in logps.shift_labels(df).orderBy("pos").collect()]
    assert s == [(0, 11), (1, 12), (2, 13)]
    # shifted rows: pos j holds lp of token j+1; prompt_len 2, length 5 -> j in {2, 3}
    lp = spark.createDataFrame([(1, j, float(j), 2, 5) for j in range(4)] + [(2, j, 1.0, 4, 5) for j in range(4)],
                               "seq_id long, pos int, lp double, prompt_len int, length int")
    out = {r["seq_id"]: (r["lp"], r["response_cut"]) for r in logps.response_mean(lp, "seq_id", ["lp"]).collect()}
    assert out[1] == (2.5, False)
    assert out[2] == (0.0, True)  # S7: prompt fills the sequence -> 0.0
    out2 = {r["seq_id"]: r["lp"] for r in logps.response_mean(lp, "seq_id", ["lp"], skip_first=False).collect()}
    assert out2[1] == pytest.approx(2.0)


def test_pair_logp_tables_and_score_hook(spark):
    a = spark.createDataFrame([(1, 0, -1.0)], "seq_id long, pos int, logp double")
    b = spark.createDataFrame([(1, 0, -2.0)], "seq_id long, pos int, logp double")
    r = logps.pair_logp_tables(a, b).first()
    assert (r["policy_lp"], r["ref_lp"]) == (-1.0, -2.0)

    def make():
        return lambda texts: np.array([float(len(t)) for t in texts])

    df = spark.createDataFrame([("abc",), ("de",)], "t string")
    assert sorted(r["score"] for r in logps.score_texts(df, "t", make).collect()) == [2.0, 3.0]


def test_losses(spark):
    df = spark.createDataFrame([(1, 400.0, -400.0), (2, -400.0, 400.0), (3, 1.0, 1.0)],
                               "k long, reward_chosen double, reward_rejected double")
    out = {r["k"]: r["loss"] for r in losses.pairwise_loss(df).collect()}
    assert out[1] == pytest.approx(0.0) and out[2] == pytest.approx(800.0) and out[3] == pytest.approx(math.log(2))
    d = spark.createDataFrame([(1, -1.0, -2.0, -1.0, -2.0, "test")],
                              "k long, policy_chosen double, policy_rejected double, ref_chosen double, "
                              "ref_rejected double, split string")
    r = losses.dpo_loss(d).first()
    assert r["margin"] == 0.0 and r["loss"] == pytest.approx(math.log(2))
    e = losses.eval_loss(losses.dpo_loss(d)).first()
    assert e["split"] == "test" and e["n_rows"] == 1


def _gae_np(delta, gl):
    out, acc = np.zeros(len(delta)), 0.0
    for t in reversed(range(len(delta))):
        acc = delta[t] + gl * acc
        out[t] = acc
    return out


def _roll(spark, seqs, pads=None):
    rows = []
    pads = pads or {}
    for sid, (batch, reward, values, lps) in seqs.items():
        for p, (v, (a, b)) in enumerate(zip(values, lps)):
            rows.append((batch, sid, p, a, b, v, p in pads.get(sid, ()), reward))
    return spark.createDataFrame(rows, "batch_id long, seq_id long, pos int, policy_lp double, ref_lp double, "
                                       "value double, is_pad boolean, reward double")


@pytest.mark.parametrize("chunk", [None, 256, 700])
def test_gae_matches_recursion_across_blocks(spark, chunk):
    rng = np.random.default_rng(0)
    n = 1300
    vals = rng.normal(size=n).tolist()
    df = _roll(spark, {1: (0, 0.7, vals, [(0.0, 0.0)] * n)})
    out = rollout.gae(rollout.td_residuals(rollout.place_reward(rollout.mask_values(
        rollout.center_rewards(df)))), chunk=chunk).orderBy("pos").collect()
    delta = np.array([r["delta"] for r in out])
    want = _gae_np(delta, 0.99 * 0.95)
    got = np.array([r["advantage"] for r in out])
    assert np.max(np.abs(got - want)) < 1e-9
    assert all(abs(r["returns"] - r["advantage"] - r["value"]) < 1e-12 for r in out)


def test_gae_exact_carries_near_one(spark):
    # gamma*lam close to 1: blocks are capped and the exact per-sequence carry path runs
    vals = np.linspace(-1, 1, 40).tolist()
    df = _roll(spark, {1: (0, 0.3, vals, [(0.0, 0.0)] * 40)})
    base = rollout.td_residuals(rollout.place_reward(rollout.mask_values(rollout.center_rewards(df)), ),
                                gamma=0.9999)
    out = rollout.gae(base, gamma=0.9999, lam=0.9999, chunk=7).orderBy("pos").collect()
    delta = np.array([r["delta"] for r in out])
    want = _gae_np(delta, 0.9999 * 0.9999)
    assert np.max(np.abs(np.array([r["advantage"] for r in out]) - want)) < 1e-9


def test_ppo_invariants(spark):
    seqs = {1: (0, 1.0, [0.1, 0.2, 0.3], [(-1.0, -1.0)] * 3), 2: (0, 3.0, [0.3, 0.1, 0.5], [(-2.0, -2.0)] * 3),
            3: (1, 5.0, [0.2, 0.2, 0.2], [(-1.0, -1.5)] * 3)}
    df = _roll(spark, seqs, pads={2: (2,)})
    adv = rollout.advantages(df)
    cent = {r["seq_id"]: r["reward_centered"] for r in adv.where("pos = 0").collect()}
    assert cent[1] + cent[2] == pytest.approx(0.0) and cent[3] == 0.0  # batch of one centres to 0
    placed = adv.where("reward_t != 0").select("seq_id", "pos").collect()
    assert {(r["seq_id"], r["pos"]) for r in placed} <= {(1, 2), (2, 2)}  # last column, even on a pad (S6)
    m = {r["batch_id"]: r for r in rollout.ppo_loss(adv).collect()}
    a2 = adv.groupBy("batch_id").agg(F.avg(F.col("advantage") ** 2).alias("a2")).collect()
    for r in a2:
        assert m[r["batch_id"]]["value_loss"] == pytest.approx(r["a2"])  # S10
    assert m[0]["kl"] == pytest.approx(0.0)  # policy == ref -> KL 0, ratio 1
    assert m[1]["kl"] == pytest.approx(0.5)


def test_lam_zero_and_simple_and_all_pad(spark):
    seqs = {1: (0, 1.0, [0.1, 0.2, 0.3], [(-1.0, -1.2)] * 3)}
    df = _roll(spark, seqs)
    z = rollout.advantages(df, lam=0.0).collect()
    assert all(r["advantage"] == pytest.approx(r["delta"]) for r in z)
    s = rollout.advantages(df, method="simple").collect()
    assert all(r["returns"] == pytest.approx(r["reward_centered"]) for r in s)
    pad = _roll(spark, {5: (9, 1.0, [0.1, 0.1], [(-1.0, -1.0)] * 2)}, pads={5: (0, 1)})
    assert rollout.ppo_loss(rollout.advantages(pad)).first()["kl"] is None  # 0/0 -> NULL


def test_expand_responses_drop_last(spark):
    df = spark.createDataFrame([(0, 1, [5, 6, 7]), (0, 2, [8])], "batch_id long, seq_id long, response_ids array<int>")
    rows = sorted((r["seq_id"], r["pos"], r["token"], r["is_pad"]) for r in rollout.expand_responses(df).collect())
    assert rows == [(1, 0, 5, False), (1, 1, 6, False), (2, 0, 8, False), (2, 1, None, True)]  # S9: last column dropped
    full = rollout.expand_responses(df, pad_id=0, drop_last=False).where("seq_id = 2").count()
    assert full == 3


def test_response_mean_mask_padding(spark):
    lp = spark.createDataFrame([(1, j, float(j), 0, 4, j >= 2) for j in range(4)],
                               "seq_id long, pos int, lp double, prompt_len int, length int, pad boolean")
    lit = logps.response_mean(lp, "seq_id", ["lp"]).first()["lp"]
    masked = logps.response_mean(lp, "seq_id", ["lp"], pad_col="pad", mask_padding=True).first()["lp"]
    assert lit == pytest.approx(1.5) and masked == pytest.approx(0.5)  # S5 literal averages over pads


def test_reward_placement_and_mask_padding_flags(spark):
    seqs = {1: (0, 1.0, [0.1, 0.2, 0.3], [(-1.0, -1.5)] * 3), 2: (0, 3.0, [0.3, 0.1, 0.5], [(-2.0, -2.0)] * 3)}
    df = _roll(spark, seqs, pads={2: (1, 2)})
    col = rollout.place_reward(rollout.mask_values(rollout.center_rewards(df)), at="last_column")
    tok = rollout.place_reward(rollout.mask_values(rollout.center_rewards(df)), at="last_token")
    at_col = {(r["seq_id"], r["pos"]) for r in col.where("reward_t != 0").collect()}
    at_tok = {(r["seq_id"], r["pos"]) for r in tok.where("reward_t != 0").collect()}
    assert at_col == {(1, 2), (2, 2)}  # S6 literal: last column, a pad for the short sequence
    assert at_tok == {(1, 2), (2, 0)}  # last real token
    adv = rollout.advantages(df)
    lit = rollout.ppo_loss(adv).first()
    masked = rollout.ppo_loss(adv, mask_padding=True).first()
    assert lit["value_loss"] != pytest.approx(masked["value_loss"])  # S13: pads count in the literal mean
    real = adv.where("mask > 0").agg(F.avg((F.col("value") - F.col("returns")) ** 2)).first()[0]
    assert masked["value_loss"] == pytest.approx(real)
