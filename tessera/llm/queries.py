"""The queries ``opN_<name>``: each operator on its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    bag_minhash, bpe, kd_shards, line_dedup, mixing, multi_index, pii, prefix_trie, radix_dedup, spelling, suffix_dedup, toxicity,
    url_filter,
)
from tessera.sources.tables import table

SHARDS = 16


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url")
    out = url_filter.judge(spark, url_filter.fetched_pages(pages), url_filter.dated_list(pages))
    # -1: no entry, or one that still holds
    return out.withColumns({c: F.coalesce(c, F.lit(-1).cast("bigint")) for c in ("valid_from", "valid_to")})


def op2_kd_shards(spark: SparkSession, d: str) -> DataFrame:
    out = kd_shards.shard_documents(spark, table(spark, d, "documents"), leaves=SHARDS)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_radix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return radix_dedup.dedup(spark, table(spark, d, "documents"))


def op4_bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_documents(table(spark, d, "documents"), vocabulary_path(), ids=False)


def op5_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_documents(spark, table(spark, d, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def op6_multi_index(spark: SparkSession, d: str) -> DataFrame:
    return multi_index.search(spark, table(spark, d, "embeddings"), lambda i: i % 20 == 0, k=20)


def op7_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = line_dedup.dedup_lines(spark, table(spark, d, "documents"))
    return out.withColumn("kept_sha256", F.sha2(F.col("kept_text").cast("binary"), 256)).drop("kept_text")


def op8_bag_minhash(spark: SparkSession, d: str) -> DataFrame:
    return bag_minhash.near_groups(spark, table(spark, d, "documents")).drop("key", "th")


def op9_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.dedup_passages(spark, table(spark, d, "documents"))


def op10_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score_documents(spark, table(spark, d, "documents"), table(spark, d, "labels"))


def op11_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.summaries(pii.find_spans(table(spark, d, "documents")))


def op12_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.build_trie(spark, table(spark, d, "conversations"))


def op13_spelling(spark: SparkSession, d: str) -> DataFrame:
    return spelling.group_variants(spark, table(spark, d, "documents"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_kd_shards": op2_kd_shards,
    "op3_radix_dedup": op3_radix_dedup,
    "op4_bpe": op4_bpe,
    "op5_mixing": op5_mixing,
    "op6_multi_index": op6_multi_index,
    "op7_line_dedup": op7_line_dedup,
    "op8_bag_minhash": op8_bag_minhash,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_pii": op11_pii,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
}
