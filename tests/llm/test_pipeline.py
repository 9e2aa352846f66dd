"""The corpus pipeline, stage by stage."""

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from prefspark.llm import bpe, mixing, simhash
from tests.conftest import SF001


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        results.append(docs)
        if name != "encoding":
            assert docs.columns == columns, name
    clean, single, mixed, coded = results
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    good = labels.where("quality = 1")
    assert good.join(clean, "doc_id", "left_semi").count() >= 0.98 * good.join(spark.read.parquet(f"{SF001}/documents.parquet"), "doc_id", "left_semi").count()
    groups = simhash.near_duplicates(clean).select("component_id").distinct().count()
    assert single.count() == groups
    assert simhash.near_duplicates(single).where("doc_id <> component_id").count() == 0
    sized = single.withColumn("size", mixing.word_count())
    taken = {r.doc_id: r.taken for r in mixing.mix(sized, "size", block_words=2048).collect() if r.taken}
    words = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg({"text": "count"}).withColumnRenamed("count(text)", "n").collect()}
    assert set(words) == set(taken)
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted(library.encode_ordinary(r.text) for r in mixed.collect())
    assert sorted(r.ids for r in coded.collect()) == want
    assert coded.where("NOT round_trip").count() == 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
    assert docs.count() == 0
