"""Operators 1 and 6 against the libraries that own the vocabulary files."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from prefspark.llm import bpe, queries, token_counts

TEXTS = [
    None, "", " ", "\n\n \t x", "it's we'll don't", "a" * 30_000, "ab" * 2_000, "日本語 ١٢٣ émigré 　x", "🙂" * 200, "a\x00b",
    "<|endoftext|>", "x<|endoftext|><|endoftext|> y\n", "  \n <|endoftext|>  ", "the quick brown fox 12345 +-*/ __init__()",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoding():
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return queries.multi_vocabulary()


def test_counts_match_library(make_docs, tokenizer):
    docs = make_docs(list(enumerate(TEXTS))).unionAll(make_docs([(3, "twice")] * 2)).withColumnRenamed("lang", "n_tokens")
    got = token_counts.count_tokens(docs, P.path("byte_bpe_50k.json"))
    assert sorted(got.columns) == sorted(["doc_id", "text", "source", "n_chars", "n_tokens"])  # a clashing column is replaced
    rows = got.collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert r.n_tokens == len(tokenizer.encode(r.text or "", add_special_tokens=False).ids), (r.text or "")[:20]


def test_whole_tokens_are_proven(tokenizer):
    model = token_counts.ByteLevelModel(P.path("byte_bpe_50k.json"))
    assert len(model.whole) > 45_000
    for text in sorted(model.whole)[::97]:
        assert len(tokenizer.encode(text, add_special_tokens=False).ids) == 1


def test_encode_decode_match_library(make_docs, encoding, vocabulary):
    docs = make_docs(list(enumerate(TEXTS))).withColumnRenamed("source", "ids")
    rows = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r.ids == encoding.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_decoding_in_the_same_pass(make_docs, vocabulary):
    docs = make_docs(list(enumerate(TEXTS))).withColumnRenamed("source", "decoded")
    one = bpe.encode(docs, vocabulary, bytes_col="decoded").select("doc_id", "ids", "decoded").collect()
    two = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).select("doc_id", "ids", "decoded").collect()
    assert sorted(one) == sorted(two)


def test_memo_keeps_frequent_keys_and_its_bound():
    class Length(bpe.Memo):
        asked = 0

        def resolve(self, key):
            self.asked += 1
            return len(key)

    memo = Length(entries=10)
    for i in range(500):
        assert memo["often"] == 5 and memo[f"w{i}"] == len(f"w{i}")
        assert len(memo) + len(memo.old) <= 20
    assert memo.asked == 501


def test_empty_table(make_docs, vocabulary):
    empty = make_docs([])
    assert token_counts.count_tokens(empty, P.path("byte_bpe_50k.json")).count() == 0
    assert bpe.decode(bpe.encode(empty, vocabulary), vocabulary).count() == 0


def test_unknown_id_raises(spark, vocabulary):
    bad = spark.createDataFrame([([1, 99_999_999],), (None,)], "ids array<int>")
    with pytest.raises(Exception):
        bpe.decode(bad, vocabulary).collect()
    assert bpe.decode(bad.where("ids IS NULL"), vocabulary).first().decoded is None


def test_perfect_hash_is_minimal(vocabulary):
    found = {vocabulary.hash.find(k) for k in vocabulary.ranks}
    assert found == set(range(len(vocabulary.ranks)))
    assert vocabulary.hash.find(b"\xff\xfe no such token") == -1
    assert bpe.PerfectHash([]).find(b"x") == -1


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(encoding, vocabulary, tokenizer, text):
    encoder = bpe.worker_encoder("test", lambda: vocabulary)
    assert encoder.encode(text) == encoding.encode_ordinary(text)


def test_query_digests(spark, tmp_path, make_docs, encoding):
    make_docs([(1, "hello world"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.QUERIES["op6_byte_bpe"](spark, str(tmp_path)).collect()}
    ids = encoding.encode_ordinary("hello world")
    assert rows[1].n_tokens == len(ids)
    assert rows[1].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert rows[1].decoded_sha256 == hashlib.sha256(b"hello world").hexdigest()
    assert (rows[2].n_tokens, rows[2].ids_sha256) == (0, hashlib.sha256(b"").hexdigest())
    counts = {r.doc_id: r for r in queries.QUERIES["op1_token_counts"](spark, str(tmp_path)).collect()}
    assert (counts[2].n_bytes, counts[2].n_tokens, counts[2].over_limit) == (0, 0, False)


def test_encoder_remembers_the_words_of_a_large_vocabulary(monkeypatch):
    """240,000 distinct pre-tokens met again in turn cost no merges."""
    encoder = queries.multi_vocabulary().encoder()
    resolved = []
    monkeypatch.setattr(encoder, "resolve", lambda key: resolved.append(key) or (0,))
    for _ in range(2):
        for i in range(240_000):
            encoder[f"w{i}"]
    assert len(resolved) == 240_000 and len(encoder) + len(encoder.old) <= 2 * bpe.ENCODER_ENTRIES
