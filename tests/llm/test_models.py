"""Operators 4, 8 and 10: small models against brute force, held-out quality and odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefspark.llm import ann, lm, quality, queries
from tests.conftest import SF001, SF01

# --- operator 8


def test_search_recall_and_order(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 12))
    x[700:760] = x[3]  # copies tie
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(5001, None), (5002, [0.0] * 12), (5003, [float("inf")] * 12), (5004, []), (None, [1.0] * 12), (5005, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("part", F.lit("clash"))
    asked = table.where("vec_id % 25 = 3 OR vec_id > 5000")
    got = {}
    for r in ann.search(table, asked, top=20, block_rows=64, block_queries=8).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    want_queries = [i for i in range(1500) if i % 25 == 3]
    assert sorted(got) == want_queries
    for q in want_queries:
        score = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(1500), -score)) if i != q][:20]
        assert [r[0] for r in got[q]] == list(range(1, 21))
        assert all(abs(s - score[v]) < 1e-12 for _, v, s in got[q])
        hits += len(set(order) & {v for _, v, _ in got[q]})
    assert hits / (20 * len(want_queries)) >= 0.9
    assert [v for _, v, _ in got[3]][:5] == [700, 701, 702, 703, 704]  # ties to the smaller id


def test_clustered_rows_are_searched_in_part(spark):
    """Queries scan well under half of all pairs and still find over nine tenths of their neighbours; in random directions they scan more."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 24))
    clustered = np.repeat(centres, 60, axis=0) + 0.25 * rng.standard_normal((3600, 24))
    shares = []
    for x in (clustered, rng.standard_normal((3600, 24))):
        table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        asked = table.where("vec_id % 40 = 0")
        routed, _, parts = ann.routed_rows(table, asked, 20, None, 6144, 0.93, "vec_id", "embedding", 42)
        shares.append(ann.scanned_share(routed))
        near = {}
        for r in ann.search(table, asked).collect():
            near.setdefault(r.query_id, set()).add(r.vec_id)
        hits = 0
        for q in range(0, 3600, 40):
            score = x @ x[q]
            score[q] = -np.inf
            hits += len(near[q] & set(np.argsort(-score)[:20].tolist()))
        print("parts", parts, "share", shares[-1], "recall", hits / 1800)
        assert parts == 32 or parts == 64
        assert hits / 1800 >= 0.9
    assert shares[0] < 0.35 and shares[0] < shares[1] <= 1


def test_parts_follow_the_rows():
    assert [ann.parts_for(n, 6144) for n in (0, 1, 100, 10_000, 10**9)] == [1, 1, 8, 64, 64]
    assert ann.parts_for(10**8, 10**6) == 2**13


def test_search_of_few_rows_finds_all(spark):
    table = spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in range(6)], "vec_id long, embedding array<float>")
    got = ann.search(table, table, top=20)
    assert got.groupBy("query_id").count().collect() == [(i, 5) for i in range(6)] or got.count() == 30
    assert ann.search(table.limit(0), table.limit(0)).count() == 0


def test_parts_are_balanced():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.standard_normal((150, 8)) * 0.1 + c for c in np.eye(8)[:4] * 5])
    a, b = ann.neighbour_graph(x, 8)
    part = ann.balanced_parts(len(x), a, b, 2, 0)
    assert set(np.bincount(part)) == {150}
    assert (part[a] == part[b]).mean() > 0.9  # clusters stay whole


# --- operator 10


def numeric_gradient(model, x, name, at, step=1e-3):
    flat = model.params[name].reshape(-1)
    keep, out = flat[at], []
    for side in (step, -step):
        flat[at] = keep + side
        out.append(-model.log_probs(x)[0].sum(dtype=np.float64))
    flat[at] = keep
    return (out[0] - out[1]) / (2 * step)


def test_gradients_and_probabilities():
    rng = np.random.default_rng(2)
    size = 30
    model = lm.Model.start(size, rng.integers(0, 5, (size, size)).astype(float), heads=4, values=5, hidden=6)
    ids = rng.integers(0, size - 1, 45).astype(np.int32)
    x, owner = lm.windows(ids, np.array([40, 5, 0]), size - 1)
    assert np.bincount(owner).tolist() == [3, 1, 1]
    _, grads = model.log_probs(x, learn=True)
    for name in lm.NAMES:
        big = np.argsort(-np.abs(grads[name].reshape(-1)))[:3]
        for at in big:
            assert grads[name].reshape(-1)[at] == pytest.approx(numeric_gradient(model, x, name, at), rel=0.05, abs=0.02)
    total = 0.0  # probabilities of all next tokens after one context sum to 1
    for token in range(size):
        y, _ = lm.windows(np.array([3, 7, token], np.int32), np.array([3]), size - 1)
        total += math.exp(model.log_probs(y)[0].reshape(-1)[2])
    assert total == pytest.approx(1, abs=1e-4)


def test_model_is_causal_and_windows_score_each_token_once():
    rng = np.random.default_rng(4)
    size = 20
    model = lm.Model.start(size, np.ones((size, size)), heads=4, values=4, hidden=8)
    ids = rng.integers(0, size - 1, 70).astype(np.int32)
    x, _ = lm.windows(ids, np.array([70]), size - 1)
    assert x[:, lm.STRIDE + 1 :].reshape(-1)[:71].tolist() == [*ids.tolist(), size - 1]
    before = model.log_probs(x)[0].reshape(-1)
    changed = ids.copy()
    changed[50] = (ids[50] + 1) % (size - 1)
    after = model.log_probs(lm.windows(changed, np.array([70]), size - 1)[0])[0].reshape(-1)
    assert np.allclose(before[:50], after[:50]) and not np.allclose(before[50:60], after[50:60])


def test_training_lowers_loss():
    rng = np.random.default_rng(5)
    size = 12
    ids = np.tile([1, 2, 3, 1, 4, 5], 400).astype(np.int32)  # what follows 1 depends on the token before it
    x, _ = lm.windows(ids, np.array([len(ids)]), size - 1)
    model = lm.Model.start(size, np.ones((size, size)))
    first = model.log_probs(x)[0].mean()
    adam = lm.Adam(model, 1e-2)
    for _ in range(150):
        adam.step(x[rng.integers(0, len(x), 32)])
    assert model.log_probs(x)[0].mean() > max(first / 4, -0.2)


def test_scores_on_a_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "Zzqx " * 3000), (9003, "Zzqx " * 3000), (None, "the of")], "doc_id long, text string")
    docs = docs.unionAll(odd).withColumn("score", F.lit("clash"))
    got = lm.score(docs, queries.subword_vocabulary(512), frequent=50, window_share=4).collect()
    rows = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    train = [w for i, w in rows if not held(i)]
    count = Counter(w for words in train for w in words)
    n, v = sum(count.values()) + len(train), len(count) + 1
    want = sorted((-1 if i is None else i, held(i), len(w) + 1, sum(count[x] > 0 for x in w) + 1,
                   sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))) for i, w in rows)
    have = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score) for r in got)
    assert [h[:4] for h in have] == [w[:4] for w in want]
    assert all(abs(h[4] - w[4]) < 1e-6 * abs(w[4]) for h, w in zip(have, want))
    assert all(r.train_tokens == n and math.isfinite(r.score) and r.score < 0 for r in got)
    unseen = sum(r.score for r in got if r.held_out) / sum(r.n_tokens for r in got if r.held_out)
    assert unseen > -7  # far better than chance among 512 subwords, about three a word
    assert lm.score(docs.limit(0), queries.subword_vocabulary(512)).count() == 0


# --- operator 4


def plain_kneser_ney(texts):
    """Probabilities straight from the definition, by dictionaries."""
    grams = {1: Counter(), 2: Counter(), 3: Counter()}
    for t in texts:
        words = ["<s>", "<s>", *t.split()]
        for i in range(2, len(words)):
            grams[3][tuple(words[i - 2 : i + 1])] += 1
    for g in grams[3]:
        grams[2][g[1:]] += 1
    for g in grams[2]:
        grams[1][g[1:]] += 1
    cut, total, left = {}, {}, {}
    for order, table in grams.items():
        d = quality.discounts(Counter(min(c, 4) for c in table.values()))
        cut[order] = lambda c, d=d: d[min(c, 3) - 1]
        total[order], left[order] = Counter(), Counter()
        for g, c in table.items():
            total[order][g[:-1]] += c
            left[order][g[:-1]] += cut[order](c)
    known = len({w for g in grams[2] for w in g})

    def p(context, word, order=3):
        if order == 0:
            return 1 / (known + 1)
        context = context[len(context) - order + 1 :] if order > 1 else ()
        if not total[order][context]:
            return p(context, word, order - 1)
        c = grams[order][(*context, word)]
        return (c - cut[order](c) if c else 0) / total[order][context] + left[order][context] / total[order][context] * p(context, word, order - 1)

    return p


def test_kneser_ney_matches_definition(spark):
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(list("abcdefghij"), p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05, 0.05, 0.03, 0.02], size=12)) for _ in range(60)] + ["a", "b a"]
    model = quality.learn(spark.createDataFrame([(t,) for t in texts], "text string"))
    p = plain_kneser_ney(texts)
    test = ["a b c d a a j i x a b", "x y z", "j j j j"]
    u, v, w, counts = quality.word_hashes([t.encode() for t in test], quality.Hashes())
    got = model.log10(u, v, w)
    want = []
    for t in test:
        words = ["<s>", "<s>", *t.split()]
        want += [math.log10(p(tuple(words[i - 2 : i]), words[i])) for i in range(2, len(words))]
    assert np.allclose(got, want, atol=1e-4)


def test_quality_keeps_clean_and_rejects_junk(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    judged = quality.classify(docs.select("doc_id", "lang", "text"), labels).join(labels, "doc_id").toPandas()
    assert judged[judged.quality == 1].kept.mean() >= 0.99
    assert judged[judged.quality == 0].kept.mean() <= 0.25


def test_all_trusted_text_is_learned_or_calibrates(spark, monkeypatch):
    """Three quarters of 8,000 trusted documents are learned and all others calibrate; joined tables score like the arrays of ``learn``."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, "aa", " ".join(rng.choice(words, 8))) for i in range(8000)] + [(9000, "aa", "w1 w2 nowhere w3"), (9001, "aa", None), (9002, None, "w1")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    labels = docs.where("doc_id < 8000").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    seen, measured = {}, {}
    tables, bounds, measure = quality.learned_tables, quality._bounds, quality.measure
    monkeypatch.setattr(quality, "learned_tables", lambda trusted, *a: seen.setdefault("trusted", trusted) and tables(trusted, *a))
    monkeypatch.setattr(quality, "_bounds", lambda part, *a: (seen.setdefault(a[0], part.count()), bounds(part, *a))[1])
    monkeypatch.setattr(quality, "measure", lambda *a, **k: measured.setdefault("rows", measure(*a, **k)))
    monkeypatch.setattr(quality, "BLOCK_BYTES", 1 << 16)  # several blocks and shards
    monkeypatch.setattr(quality, "SHARD_GRAMS", 1 << 14)
    assert quality.classify(docs, labels).count() == 8003
    learned = seen["trusted"].count()
    assert 5800 < learned < 6200 and learned + seen["everywhere"] == 8000
    model = quality.learn(seen["trusted"])
    got = {r._0: (r.n_words, r.log_prob) for r in measured["rows"].collect()}
    assert got[9001] == (0, 0.0) and len(got) == 8003
    for i, text in ((9000, rows[8000][2]), (9002, "w1"), *((i, rows[i][2]) for i in range(0, 8000, 371))):
        u, v, w, counts = quality.word_hashes([text.encode()], quality.Hashes())
        assert got[i][0] == counts[0] and got[i][1] == pytest.approx(model.log10(u, v, w).sum(), abs=1e-4)


def test_counts_are_packed_and_go(spark):
    """Sharded counts are those of a plain count, take few bytes an n-gram, leave no shuffle files, and go when dropped."""
    for values in (np.zeros(0, np.uint64), np.arange(5, dtype=np.uint64) << np.uint64(60)):
        assert quality.unpacked(quality.packed(values), np.uint64).tolist() == quality.unpacked_keys(quality.packed_keys(values)).tolist() == values.tolist()
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 300, 40)) for _ in range(3000)] + ["", "w1"]
    model = quality.learned_tables(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), shards=5, rounds=3)
    want = Counter()
    for t in texts:
        u, v, w, _ = quality.word_hashes([t.encode()], quality.Hashes())
        want.update(zip(u.tolist(), v.tolist(), w.tolist()))
    got, size = Counter(), 0
    for r in model.rows(3).collect():
        columns, count = quality.unpacked_grams(r.data)
        got.update(dict(zip(zip(*(c.tolist() for c in columns)), count.tolist())))
        size += sum(map(len, r.data))
    assert got == want and size < 12 * len(want)
    assert model.all_pairs == len({g[1:] for g in want}) and model.counts(1)[4] == 301  # with the start of a text
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    model.drop()
    assert not spark.catalog.tableExists(model.name)


def test_words_hash_alike_wherever_they_lie():
    """Words are those of ``split``, whatever their bytes, length and place; equal ones hash alike, others apart."""
    longs = [b"x" * n for n in range(1, 140)] + [b"y" + b"x" * n for n in range(140)] + [b"x" * n + b"y" for n in range(1, 140)]
    odd = [b"a", b"a\0", b"\0", b"\0\0", "\u00a0\u0085\u2003".encode(), "é".encode(), b"\x1c", bytes(range(128, 256))]
    words = [*longs, *odd]
    joins = [b" ", b"\t", b"\n\n", b"\v \f", b"\r\n"]
    texts = [b"", b" ", b" ".join(words), b"\n" + b"".join(w + joins[i % 5] for i, w in enumerate(reversed(words))), b"", words[0], b"a"]
    u, v, w, counts = quality.word_hashes(texts, quality.Hashes())
    want = [x for t in texts for x in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts]
    assert len(set(zip(want, w.tolist()))) == len(set(want)) == len(set(w.tolist()))
    assert u[-2:].tolist() == v[-2:].tolist() == [quality.START] * 2 and v[1] == w[0] == u[2] and u[1] == quality.START
    assert [len(x) for x in quality.word_hashes([], quality.Hashes())] == [0] * 4


def test_shards_are_asked_in_few_bytes():
    """What a block asks does not grow with the number of shards, and a triple lies in the shard of its first two words."""
    rng = np.random.default_rng(12)
    texts = [b" ".join(b"w%d" % i for i in rng.integers(0, 50_000, 400)) for _ in range(500)]
    (one, two, three), before, _ = quality.block_grams(texts)
    sizes = []
    for shards in (1, 256):
        size = 0
        for keys in (one, two, three):
            distinct, cuts = quality.dealt(keys, shards)
            assert distinct.tolist() == np.unique(keys).tolist() and cuts[0] == 0 and cuts[-1] == len(distinct)
            assert (np.repeat(np.arange(shards), np.diff(cuts)) == quality.shard_of(distinct, shards)).all()
            assert (distinct[quality.placed(keys)] == keys).all()
            size += sum(len(quality.packed_keys(distinct[a:b])) - 8 for a, b in zip(cuts, cuts[1:]))
        sizes.append(size / (len(np.unique(one)) + len(np.unique(two)) + len(np.unique(three))))
    assert sizes[1] < 1.08 * sizes[0] < 7
    assert (quality.shard_of(three, 7) == quality.shard_of(two[before], 7)).all()


@pytest.mark.parametrize("ids", [1 << 20, 10])
def test_counts_are_not_written_aside(spark, monkeypatch, ids):
    """Learning writes aside the texts it learns, once, and no counts; few and many documents to learn give one result."""
    rng = np.random.default_rng(13)
    docs = spark.createDataFrame([(i, "aa", " ".join(f"w{j}" for j in rng.integers(0, 90, 12))) for i in range(900)] + [(901, "aa", None)], "doc_id long, lang string, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    aside, written = [], quality.Scratch.written
    monkeypatch.setattr(quality.Scratch, "written", lambda self, df: (aside.append(df), written(self, df))[1])
    monkeypatch.setattr(quality, "BROADCAST_IDS", ids)
    monkeypatch.setattr(quality, "BLOCK_BYTES", 1 << 13)
    monkeypatch.setattr(quality, "SHARD_GRAMS", 1 << 12)
    monkeypatch.setattr(quality, "TURN_BLOCKS", 1)
    got = {r.doc_id: r.perplexity for r in quality.classify(docs, labels).collect()}
    assert len(got) == 901 and all(df.columns == ["text"] for df in aside) and len(aside) == (1 if ids > 900 else quality.LEARN_ROUNDS)
    learned = [r.text for r in aside[0].collect()] if ids > 900 else [r.text for df in aside for r in df.collect()]
    assert 600 < len(learned) < 750
    model = quality.learn(spark.createDataFrame([(t,) for t in learned], "text string"))
    rows = {r.doc_id: r.text for r in docs.collect() if r.text}
    u, v, w, counts = quality.word_hashes([t.encode() for t in rows.values()], quality.Hashes())
    logs = -np.add.reduceat(model.log10(u, v, w), np.cumsum(counts) - counts)
    rest = [22 * math.log10(got[i]) - x for i, x in zip(rows, logs)]  # ten words at the language's mean
    assert max(rest) - min(rest) < 1e-3


def test_quality_odd_rows(spark, make_docs):
    clean = "one two three four five six seven eight nine ten"
    docs = make_docs([(i, clean) for i in range(40)] + [(50, None), (51, ""), (52, "x " * 20_000, None, "s"), (None, clean), (1, clean)]).withColumn("kept", F.lit("clash"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(None, 1, 0), (7777, 1, None), (52, 0, None)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels, keep_text=True).collect()
    assert len(got) == 45
    assert {r.doc_id: r.kept for r in got}[52] is False
    assert all(r.kept for r in got if r.doc_id != 52)
    nothing = quality.classify(docs, labels.limit(0)).collect()
    assert len(nothing) == 45 and all(r.kept and r.perplexity is None for r in nothing)
    assert quality.classify(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("share", [1, 8])
def test_windows_of_all_lengths_train(spark, share):
    """Every window is for gradient steps; a share of them is drawn alike from texts of every length."""
    docs = spark.createDataFrame([(i, " ".join("a" for _ in range(i % 40))) for i in range(4000)], "key long, text string")
    learned = lm.learn_counts(docs.select("text", F.xxhash64("key").alias("key")), queries.subword_vocabulary(512), share)
    windows = 100 * sum(-(-(n + 1) // lm.STRIDE) for n in range(40))
    got = learned.where("kind = 2").agg(F.sum("n")).first()[0]
    assert got == windows if share == 1 else abs(got - windows / share) < 0.15 * windows / share
    for blocks in range(1, 41):
        keys = np.random.default_rng(blocks).integers(-(1 << 62), 1 << 62, 500)
        taken = lm.drawn(keys, np.repeat(np.arange(500), blocks), share).mean()
        assert abs(taken - 1 / share) < 0.07


def test_score_trains_on_every_window():
    import inspect

    assert inspect.signature(lm.score).parameters["window_share"].default == 1


def test_every_language_has_its_own_thresholds(spark):
    """A language with a fiftieth of the trusted documents, yet hundreds of them, is judged by its own quantiles."""
    rng = np.random.default_rng(9)
    many, few = [f"m{i}" for i in range(40)], [f"f{i}" for i in range(4000)]
    rows = [(i, "aa", " ".join(rng.choice(many, 20))) for i in range(9800)] + [(20_000 + i, "bb", " ".join(rng.choice(few, 20))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    got = quality.classify(docs, labels, trusted_docs=400).groupBy("lang").agg(
        F.countDistinct("most").alias("bounds"), F.first("most").alias("most"), F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    most = {r.lang: r.most for r in got}
    assert all(r.bounds == 1 and r.kept > 0.98 for r in got) and most["bb"] > 3 * most["aa"]


def test_search_counts_an_id_once(spark):
    """Rows repeated near a query, alike or with other vectors, take one place of its list."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, x[0].tolist())] * 60 + [(8, (x[0] * (1 + k / 1000)).tolist()) for k in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = ann.search(table, table.where("vec_id = 0"), top=20, recall=1.0).orderBy("rank").collect()
    best = {}
    for i, v in rows:
        best[i] = max(best.get(i, -np.inf), float(np.dot(x[0], v)))
    best.pop(0)
    want = sorted(best, key=lambda i: (-best[i], i))[:20]
    assert [r.vec_id for r in got] == want and [r.rank for r in got] == list(range(1, 21))
    assert np.allclose([r.score for r in got], [best[i] for i in want])
