"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (
    decontaminate,
    filter_audit,
    fingerprints,
    importance,
    language,
    line_dedup,
    packing,
    quality,
    sharding,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
)
from .common import read_table


def q_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"), short_words=line_dedup.SHORT_WORDS)
    return out.select("row.doc_id", "n_lines", "n_removed", "row.text")


def q_quality_classifier(spark, sf_dir):
    return quality.score_documents(read_table(spark, sf_dir, "documents"))


def q_substring_dedup(spark, sf_dir):
    out = substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def q_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def q_document_fingerprints(spark, sf_dir):
    return fingerprints.compare_with_next(read_table(spark, sf_dir, "documents"))


def q_decontamination(spark, sf_dir):
    documents, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.contamination_pairs(documents, benchmark)


def q_toxicity(spark, sf_dir):
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def q_simhash_near_dedup(spark, sf_dir):
    out = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def q_sharding(spark, sf_dir):
    return sharding.place(read_table(spark, sf_dir, "documents")).select("row.*", "slot", "shard")  # whole rows


def q_token_counts(spark, sf_dir):
    return token_counts.token_counts(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


def q_language_id(spark, sf_dir):
    return language.identify(read_table(spark, sf_dir, "documents"))


def q_importance_resampling(spark, sf_dir):
    out = importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def q_filter_interaction_audit(spark, sf_dir):
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_line_dedup": q_line_dedup,
    "op2_quality_classifier": q_quality_classifier,
    "op3_substring_dedup": q_substring_dedup,
    "op4_best_fit_packing": q_best_fit_packing,
    "op5_document_fingerprints": q_document_fingerprints,
    "op6_decontamination": q_decontamination,
    "op7_toxicity": q_toxicity,
    "op8_simhash_near_dedup": q_simhash_near_dedup,
    "op9_sharding": q_sharding,
    "op10_token_counts": q_token_counts,
    "op11_language_id": q_language_id,
    "op12_importance_resampling": q_importance_resampling,
    "op13_filter_interaction_audit": q_filter_interaction_audit,
}

#: An earlier name of op1_line_dedup.
VARIANTS = {"op1_line_dedup_short": q_line_dedup}
