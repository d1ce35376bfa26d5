"""The operators over the driver's tables, and their SQL."""

from __future__ import annotations

import public_tokenizers

from . import bpe, decision_list, language_id, near_dedup, quality_cotrain, secret_scan, suffix_dedup, tiling, token_counts, url_rules
from .common import table


def op1_secret_scan(spark, sf_dir):
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_cotraining(spark, sf_dir):
    return quality_cotrain.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_suffix_merge(spark, sf_dir):
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op5_decision_list(spark, sf_dir):
    return decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_byte_bpe(spark, sf_dir):
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_hyperminhash(spark, sf_dir):
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op8_url_filter(spark, sf_dir):
    return url_rules.url_filter(table(spark, sf_dir, "pages"))


def op9_string_tiling(spark, sf_dir):
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark, sf_dir):
    return language_id.language_id(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": secret_scan.oracle_sql(), "op4_suffix_merge": suffix_dedup.oracle_sql(), "op7_hyperminhash": near_dedup.oracle_sql(), "op8_url_filter": url_rules.oracle_sql()}
