"""Registered queries ``opN_*``: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.llm import ann, bpe, embed_dedup, fim, html_text, lm, merkle, mixing, quality, reshard, simhash, token_counts, topk
from prefspark.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document under the byte-level tokenizer file; limit 1024."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit"),
    )


def multi_vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document and the bytes they decode to, as digests."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = multi_vocabulary()
    coded = bpe.encode(docs, vocabulary, bytes_col="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query("op2_html_text")
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = html_text.extract(read_table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles over whole documents, linked at 4 or fewer differing bits."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, words_each=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of their sources; sizes in words."""
    docs = read_table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count().alias("size"))  # texts are read once, for their words
    mixed = mixing.mix(sized, "size")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", *[F.col("shard_words")[i].alias(f"shard_{i}") for i in range(8)])


@query("op5_reshard")
def op5_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lie in 6 shards by source (so of very unequal sizes) rewritten to 8 of equally many rows."""
    docs = read_table(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(6)).cast("int")
    row = [F.col("_metadata.file_path").alias("row_file"), F.col("_metadata.row_index").alias("row_at")]
    lying = docs.select("doc_id", "text", old.alias("old"), *row)
    placed = reshard.resharded(lying, "old", ["row_file", "row_at"], shards=8, rows_a_file=2_000)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


@query("op9_embed_dedup")
def op9_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings of equal labels linked at cosine 0.98 or more."""
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.98)


@query("op8_ann")
def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest embeddings found for every embedding whose id is divisible by 20."""
    table = read_table(spark, sf_dir, "embeddings")
    return ann.search(table, table.where("vec_id % 20 = 0"), top=20)


def subword_vocabulary(size: int = 1024) -> bpe.Vocabulary:
    """The lowest ranks of a BPE vocabulary are a BPE vocabulary."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.Vocabulary({k: r for k, r in ranks.items() if r < size}, public_tokenizers.PATTERN)


@query("op10_lm_score")
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document scored by the attention model and by add-one unigrams of the training documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, subword_vocabulary())


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every whole document under the model of trusted text, and whether it is kept."""
    judged = quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))  # a plain scan: its rows need no copy
    return judged.select("doc_id", "lang", "n_words", "perplexity", "most", "rough_share", "most_rough", "kept")


@query("op11_topk")
def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of every embedding whose id is divisible by 50."""
    table = read_table(spark, sf_dir, "embeddings")
    return topk.search(table, table.where("vec_id % 50 = 0"), top=5, scale=256.0)


@query("op12_fim")
def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document cut and reordered, as digests of the output and of the text rebuilt from it."""
    made = fim.transform(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(fim.restored()).alias("restored_sha256"),
    )


@query("op13_merkle")
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; every second document's text loses its line feeds before it is verified."""
    docs = read_table(spark, sf_dir, "documents")
    digest = lambda text: merkle.fields_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    leaves = docs.select(
        "doc_id", "source", digest(F.col("text")).alias("leaf"), F.when(tampered, digest(F.replace("text", F.lit("\n"), F.lit("")))).alias("changed")
    )
    proven = merkle.manifest(leaves).withColumn("changed", F.coalesce("changed", "leaf"))
    return merkle.checked(proven, "changed").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
