"""Registered queries of the document operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steadyline.llm import (
    bpe,
    language,
    minhash,
    packing,
    phrases,
    quality,
    ranking,
    rules,
    sharding,
    simhash,
    sketches,
    token_files,
    toxicity,
)
from steadyline.llm.common import remainder, table
from steadyline.session import shared_folder


def balanced_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: 24 shards of equal row counts that keep equal texts together."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24)


def token_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: encode, write packed blocks, read them back."""
    path = shared_folder(spark, "token-ids")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def passage_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: quality of whole texts, learned from labels outside the held-out third."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit_on(docs, labels.filter(remainder(3) != 1))
    return quality.score_quality(docs, model).select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted", "n_passages", "top_passage"
    )


def bloom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: fingerprints of whole texts and of their edited versions, compared."""
    return sketches.fingerprint_versions(table(spark, sf_dir, "documents"))


def pigeonhole_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: fingerprints of 3-word shingles and the components of their links."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def pair_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: byte-pair ids of whole texts and the texts they decode to, as digests."""
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), path, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def toxic_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: toxicity of whole texts, learned from labels outside the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit_on(docs, labels.filter(remainder(5) != 0))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted"
    )


def rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: measures and the verdict of the cascade."""
    return rules.judge_documents(table(spark, sf_dir, "documents"))


def configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: pieces of at most 2048 ids packed into as few sequences as the program finds."""
    path = shared_folder(spark, "pieces")
    packing.write_pieces(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return packing.pack_pieces(spark, path).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def subword_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: language of whole texts, learned outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit_on(docs, docs.select("doc_id", "lang").filter(remainder(5) != 0))
    return language.predict_language(docs, model).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score", "accepted"
    )


def superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: components of 4-word shingle sets with 80 % or more of their union in common."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def dense_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: each benchmark item's 50 best documents."""
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: each language's 2000 best phrases of two to four words."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_balanced_propagation": balanced_propagation,
    "op2_token_bit_packing": token_bit_packing,
    "op3_passage_attention": passage_attention,
    "op4_bloom_lookup": bloom_lookup,
    "op5_pigeonhole_simhash": pigeonhole_simhash,
    "op6_pair_encoding": pair_encoding,
    "op7_toxic_ngrams": toxic_ngrams,
    "op8_rule_cascade": rule_cascade,
    "op9_configuration_packing": configuration_packing,
    "op10_subword_language": subword_language,
    "op11_superminhash": superminhash,
    "op12_dense_search": dense_search,
    "op13_phrase_parsing": phrase_mining,
}

ORACLE: dict[str, str] = {
    "op8_rule_cascade": rules.ORACLE_SQL,
    "op11_superminhash": minhash.ORACLE_SQL,
    "op12_dense_search": ranking.ORACLE_SQL,
    "op13_phrase_parsing": phrases.ORACLE_SQL,
}
