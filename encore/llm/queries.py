"""Thin queries over the given tables, one for each operator, and their SQL."""

from __future__ import annotations

import os
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import (
    chat,
    curriculum,
    decontaminate,
    langid,
    licenses,
    manifest,
    oracle,
    oracle_digests,
    prefix_trie,
    quality,
    records,
    secrets,
    simhash,
    token_counts,
    webtext,
)
from encore.llm.common import materialize, read


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file; ``ENCORE_TOKENIZERS`` names another folder."""
    folder = os.environ.get("ENCORE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = curriculum.place(read(spark, sf_dir, "documents"), columns=["doc_id"])
    first = F.round(F.get("positions", F.lit(0)), 6)
    return placed.select(
        "doc.doc_id", "size", "source_size", "target", "taken", "copies", first.alias("first_position")
    ).orderBy("first_position", "doc_id")


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.extract(read(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labelled = docs.filter(~langid.held_out()).select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), labelled)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return records.encode_documents(docs, tokenizer("word_bpe_49k.json")).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "shard", "record_offset", "record_bytes"
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_distance=4)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(read(spark, sf_dir, "documents"))


def _crc32(number: str) -> Column:
    return F.crc32(F.col(number).cast("string").cast("binary"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    given = [lower if c == "text" else F.col(c) for c in manifest.FIELDS]
    tampered = F.when(_crc32("doc_id") % 3 == 0, manifest.leaf_digest(given))
    built = manifest.manifest(docs, carry={"tampered": tampered}).withColumn("given", F.coalesce("tampered", "leaf"))
    return manifest.verify(built, "given").select(
        "doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", "verified",
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes over the rebuilt conversations: the first turns come from the conversation at the last multiple of 20."""
    own = materialize(prefix_trie.sequences(read(spark, sf_dir, "conversations")), "trie_own")
    heads = own.where(F.col("conv_id") % 20 == 0).select(
        F.col("conv_id").alias("base"), F.slice("steps", 1, 3).alias("head")
    )
    h = (_crc32("conv_id") % 4).cast("int")
    rebuilt = own.join(heads, F.col("conv_id") - F.col("conv_id") % 20 == F.col("base"), "left").select(
        "conv_id",
        F.concat(
            F.slice(F.coalesce("head", F.slice("steps", 1, 0)), F.lit(1), h),
            F.slice("steps", h + 1, F.size("steps")),
        ).alias("steps"),
    )
    return prefix_trie.trie(rebuilt)


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    out = chat.conversations(chat.chains(turns.unionByName(probe)))
    back = F.aggregate(
        chat.parsed(F.col("formatted")), F.lit(""), lambda acc, t: F.concat(acc, t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    loss = chat.learned_text(F.col("formatted"), F.col("loss_mask"))
    return out.select(
        F.when(F.col("tree") != "", F.substring("tree", 2, 32)).cast("long").alias("conv_id"),
        F.size(chat.parsed(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(back, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_html_main_text": op2_html_main_text,
    "op3_language_id": op3_language_id,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_token_records": op5_token_records,
    "op6_secret_scan": op6_secret_scan,
    "op7_license_scan": op7_license_scan,
    "op8_token_counts": op8_token_counts,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_chat_format": op13_chat_format,
}

SQL: dict[str, str] = oracle.SQL | oracle_digests.SQL
