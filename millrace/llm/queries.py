"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import archives, chat, collocations, decontamination, jaccard_join, licenses, quality, repeats, segmentations, sharding, surrogates, token_counts, vector_codes
from .shared import scratch, table


#: The key of the queries on test tables; whoever has real data takes a secret one.
KEY = "key of the test tables"


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    version = F.pmod(F.spark_partition_id(), F.lit(2)) + 1
    archives.write_arc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), arc, version=version)
    archives.write_warc(archives.convert(spark, arc), warc)
    records = archives.read_warc(spark, warc).filter(F.col("type").isin("response", "revisit"))
    origin = records.filter(F.col("type") == "response").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_length").alias("whole"))
    return records.join(origin, "refers_to_id", "left").select(
        "page_id", F.coalesce("payload_length", "whole").alias("payload_bytes"), "payload_digest", F.col("type").alias("record_type"), "refers_to"
    )


def op2_vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = sharding.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer=public_tokenizers.path("piece_bpe_32k.model"))
    return packed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens"
    )


def op3_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache has what an earlier run over the English documents left in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    cache, model = scratch(spark, "token-cache"), public_tokenizers.path("piece_bpe_32k.model")
    token_counts.count_tokens(docs.filter(F.col("lang") == "en"), cache, model)
    counted = token_counts.count_tokens(docs, cache, model)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(quality.profile(table(spark, sf_dir, "documents")))
    return judged.select(F.col("id").alias("doc_id"), *quality.MEASURES, "removed_words", "base_failed", "kept")


def op5_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), licenses.templates(spark))
    return scanned.select("doc_id", "n_matches", F.array_join("licenses", ",").alias("licenses"), F.round("best_dice", 6).alias("best_dice"))


def op7_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_id")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key=KEY)
    return replaced.select("doc_id", "text", "n_entities", F.array_join("kinds", ",").alias("kinds"))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = repeats.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segmentations.sampled(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id", "rank", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        F.round("log_prob", 6).alias("log_prob"), F.round("score", 6).alias("score"), F.round("inclusion", 6).alias("inclusion"),
    )


def op11_count_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_relational_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With one conversation more, whose texts have marks of this and of another template."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    out = chat.format(turns.union(more))
    told = out.select("conv_id", "formatted", chat.parsed(F.col("formatted")).alias("turns"), chat.learnt(F.col("formatted"), F.col("loss")).alias("learnt"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op13_elkan_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    return vector_codes.label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_arc_to_warc, op2_vector_bin_packing, op3_digest_cache, op4_line_frequency, op5_suffix_automaton,
        op6_license_scan, op7_signature_trees, op8_surrogates, op9_suffix_array, op10_gumbel_segmentations,
        op11_count_tries, op12_relational_formatting, op13_elkan_codes,
    )
}
SQL: dict[str, str] = {
    "op1_arc_to_warc": archives.SQL,
    "op4_line_frequency": quality.SQL,
    "op5_suffix_automaton": decontamination.SQL,
    "op6_license_scan": licenses.SQL,
    "op7_signature_trees": jaccard_join.SQL,
    "op11_count_tries": collocations.SQL,
    "op12_relational_formatting": chat.SQL,
    "op13_elkan_codes": vector_codes.SQL,
}
