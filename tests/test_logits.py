"""Log-sum-exp states over vocabulary slices, and the evaluation jobs that start from logits."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefspark.operators import logps, logsumexp
from prefspark.plans import fixtures as fx
from prefspark.plans import jobs
from tests.conftest import SF001

LOGITS = "seq_id long, pos int, offset int, logits array<double>, label int"


def lse(x):
    top = np.max(x)
    return top + math.log(np.exp(np.asarray(x) - top).sum())


@pytest.mark.parametrize("size", [1, 7, 100])
def test_slices_of_any_size_and_range(spark, size):
    rng = np.random.default_rng(size)
    rows, want = [], {}
    for k, spread in enumerate([1, 50, 700, 1e5, 1e-3] * 3):
        x = rng.standard_normal(100) * spread
        x[rng.integers(0, 100, 5)] = -np.inf
        label = int(np.argmax(x) if k % 2 else rng.integers(0, 100))
        want[k] = x[label] - lse(x)
        rows += [(k, 0, at, [float(v) for v in x[at : at + size]], label) for at in range(0, 100, size)]
    got = {r.seq_id: r.logp for r in logsumexp.sliced_token_logps(spark.createDataFrame(rows, LOGITS)).collect()}
    for k, v in want.items():
        assert got[k] == v if math.isinf(v) else got[k] == pytest.approx(v, rel=1e-9, abs=1e-9)


def test_masked_slices_and_row_form_agree(spark):
    rows = [(1, 0, 0, [-math.inf] * 3, 4), (1, 0, 3, [0.5, 1.5], 4), (2, 0, 0, [1000.0, None, 0.0], 0), (2, 0, 3, [-1000.0], 0)]
    df = spark.createDataFrame(rows, LOGITS)
    got = {r.seq_id: r.logp for r in logsumexp.sliced_token_logps(df).collect()}
    assert got[1] == pytest.approx(1.5 - lse([0.5, 1.5])) and got[2] == pytest.approx(0.0)
    whole = spark.createDataFrame([(1, 0, 0, [0.3, -2.0, 1.1], 2)], LOGITS)
    assert logsumexp.sliced_token_logps(whole).first().logp == pytest.approx(logps.token_logps(whole).first().logp)
    assert logsumexp.log_sum_exp(df, ["seq_id"]).where("seq_id = 2").first().lse == pytest.approx(1000.0)


@pytest.mark.parametrize("rows", [[(1, 0, 0, [1.0], 5)], [(1, 0, 0, [1.0, 2.0], 1), (1, 0, 1, [2.0], 1)]])
def test_label_in_no_or_two_slices_raises(spark, rows):
    with pytest.raises(Exception, match="label in"):
        logsumexp.sliced_token_logps(spark.createDataFrame(rows, LOGITS)).collect()


def test_logits_are_reduced_before_the_shuffle(spark):
    df = fx.c5_logits(spark, SF001).withColumn("pos", F.col("label")).withColumn("offset", F.lit(0))
    plan = logsumexp.sliced_token_logps(df)._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "partial_sum" in first and "logits" not in plan[:plan.rindex("Exchange hashpartitioning")]


def _dpo_inputs(spark, slices):
    rng = np.random.default_rng(5)
    seqs = [("a", "train", 3, 7, 7), ("b", "train", 2, 7, 5), ("c", "test", 9, 6, 6), ("d", "test", 1, 1, 1)]
    tables, raw = [], {}
    for model in (0, 1):
        rows = []
        for key, _, _, length, _ in seqs:
            for side in (0, 1):
                for pos in range(length - 1):
                    x, label = rng.standard_normal(12) * 5, int((pos * 5 + side) % 12)
                    raw[model, key, side, pos] = x[label] - lse(x)
                    step = 12 // slices
                    rows += [(key, side, pos, at, [float(v) for v in x[at : at + step]], label) for at in range(0, 12, step)]
        tables.append(spark.createDataFrame(rows, "pair_id string, side int, pos int, offset int, logits array<double>, label int"))
    sequences = spark.createDataFrame([(k, side, *rest) for k, sp, *more in seqs for side in (0, 1) for rest in [(sp, *more)]],
                                      "pair_id string, side int, split string, prompt_len int, length int, n_tokens int")
    return seqs, raw, tables, sequences


@pytest.mark.parametrize("slices, mask, skip", [(1, False, True), (3, False, False), (4, True, True)])
def test_dpo_from_logits(spark, slices, mask, skip):
    seqs, raw, (policy, reference), sequences = _dpo_inputs(spark, slices)
    if slices == 1:
        policy, reference = policy.drop("offset"), reference.drop("offset")
    losses, cut = {}, {}
    for key, split, prompt, length, n in seqs:
        mean = {}
        for model in (0, 1):
            for side in (0, 1):
                at = [p for p in range(length - 1) if p >= prompt - (not skip) and not (mask and p + 1 >= n)]
                mean[model, side] = np.mean([raw[model, key, side, p] for p in at]) if at else 0.0
        margin = (mean[0, 0] - mean[0, 1]) - (mean[1, 0] - mean[1, 1])
        losses.setdefault(split, []).append(math.log1p(math.exp(-0.1 * margin)))
        cut[key] = prompt >= length - 1
    got = {r.split: (r.mean_loss, r.n_rows) for r in
           jobs.evaluate_dpo_logits(policy, reference, sequences, mask_padding=mask, skip_first=skip).collect()}
    assert got == {s: (pytest.approx(np.mean(v)), len(v)) for s, v in losses.items()}
    flags = jobs.sequence_logps(policy, reference, sequences).collect()
    assert len(flags) == 8 and all(r.response_cut == cut[r.pair_id] for r in flags)


def test_position_of_one_model_raises(spark):
    _, _, (policy, reference), sequences = _dpo_inputs(spark, 1)
    with pytest.raises(Exception, match="one model only"):
        jobs.sequence_logps(policy, reference.where("pair_id <> 'b' OR pos <> 2"), sequences).collect()


def test_rm_from_logits(spark):
    rows = [(1, "train", 0, [2.0]), (1, "train", 1, [0.5]), (2, "test", 0, [-300.0]), (2, "test", 1, [300.0])]
    logits = spark.createDataFrame(rows, "pair_id long, split string, side int, logits array<double>")
    got = {r.split: r.mean_loss for r in jobs.evaluate_rm_logits(logits).collect()}
    assert got == {"train": pytest.approx(math.log1p(math.exp(-1.5))), "test": pytest.approx(600.0)}
    with pytest.raises(Exception, match="one row per side"):
        jobs.evaluate_rm_logits(logits.where("side = 0")).collect()
    with pytest.raises(Exception, match="one logit"):
        jobs.evaluate_rm_logits(logits.withColumn("logits", F.array(F.lit(1.0), F.lit(2.0)))).collect()


def test_states_take_one_pass_and_logits_are_cut_before_the_join(spark):
    """A state folds its entries once, over a maximum bound once; odd entries keep their meaning."""
    rows = [(0, [1.0, None, -math.inf]), (1, [-math.inf]), (2, []), (3, [math.nan, 1.0]), (4, [math.inf, 1.0]), (5, None), (6, [None]), (7, [-70.0, -70.0])]
    df = spark.createDataFrame(rows, "i int, logits array<double>")
    got = {r.i: (r.s.level, r.s.mass) for r in df.select("i", logsumexp.state_of("logits").alias("s")).collect()}
    assert got[0] == (0.0, pytest.approx(math.e)) and got[7] == (-2.0, pytest.approx(2 * math.exp(58)))
    assert all(got[i] == (None, None) for i in (1, 2, 5, 6))
    assert got[3][0] == 0.0 and math.isnan(got[3][1]) and got[4] == (0.0, math.inf)
    plan = df.select(logsumexp.state_of("logits").alias("s"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("array_max(") == 1 and "filter(" not in plan
    sequences = fx.c6_sequences(spark, SF001)
    optimized = fx.c6_logits(spark, SF001, sequences, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (_e" in optimized and "transform(" not in optimized[: optimized.index("Join Inner, (_e")]


def _of(table, calls):
    """A model that has the logits of ``table`` for the sequences it is asked for, and lists them."""
    def logits(part):
        calls.append({(r.pair_id, r.side) for r in part.select("pair_id", "side").collect()})
        return table.join(part.select("pair_id", "side"), ["pair_id", "side"], "left_semi")
    return logits


def test_models_score_sequences_in_turns(spark):
    """Functions give the means that tables give; each sequence is asked for once, in one of several turns."""
    _, _, (policy, reference), sequences = _dpo_inputs(spark, 3)
    calls = []
    models = _of(policy, calls), _of(reference, calls)
    got = jobs.sequence_logps(*models, sequences.repartition(2), mask_padding=True, turn_positions=8, most_turns=3)
    want = jobs.sequence_logps(policy, reference, sequences, mask_padding=True)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len(calls) == 6 and calls[::2] == calls[1::2]
    assert sum(map(len, calls[::2])) == 8 and len(set().union(*calls)) == 8 and max(map(len, calls)) < 8
    with pytest.raises(ValueError, match="both"):
        jobs.sequence_logps(models[0], reference, sequences)
    none = jobs.sequence_logps(*models, sequences.where("pair_id = 'none'"))
    assert none.count() == 0 and none.columns == want.columns
    with pytest.raises(Exception, match="one model only"):
        jobs.sequence_logps(models[0], _of(reference.where("pair_id <> 'b' OR pos <> 2"), []), sequences)


def test_turns_remove_what_they_shuffled(spark):
    """When the last turn has ended none of the turns' shuffles are held."""
    sequences = fx.c6_sequences(spark, SF001).drop("toks")
    models = fx.c6_models(spark, SF001)

    def held():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()))

    before = held()
    jobs.sequence_logps(*models, sequences, turn_positions=1 << 12)
    assert held() - before < 1 << 16


def test_dpo_of_models_is_the_dpo_of_their_logits(spark):
    _, _, (policy, reference), sequences = _dpo_inputs(spark, 3)
    got = jobs.evaluate_dpo_logits(_of(policy, []), _of(reference, []), sequences).collect()
    want = {r.split: r for r in jobs.evaluate_dpo_logits(policy, reference, sequences).collect()}
    assert len(got) == len(want) == 2
    assert all(r.n_rows == want[r.split].n_rows and r.mean_loss == pytest.approx(want[r.split].mean_loss) for r in got)
