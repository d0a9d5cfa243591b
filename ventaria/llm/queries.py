"""Registered queries of this subpackage and their check statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ventaria.llm import block_names, bpe, chat, decontam, fm_index, licenses, minhash, rules, secrets, suffix, text, toxicity, variants, whitening


def ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(text.importable(spark), sf_dir)


QUERIES = {name: ready(query) for name, query in {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_quality": rules.op2_quality,
    "op3_chat": chat.op3_chat,
    "op4_bpe": bpe.op4_bpe,
    "op5_decontamination": decontam.op5_decontamination,
    "op6_secrets": secrets.op6_secrets,
    "op7_suffix_dedup": suffix.op7_suffix_dedup,
    "op8_substring_dedup": fm_index.op8_substring_dedup,
    "op9_minhash": minhash.op9_minhash,
    "op10_licenses": licenses.op10_licenses,
    "op11_exact_dedup": block_names.op11_exact_dedup,
    "op12_spelling_variants": variants.op12_spelling_variants,
    "op13_whitening": whitening.op13_whitening,
}.items()}

STATEMENTS: dict[str, str] = {
    "op3_chat": chat.OP3_SQL,
    "op8_substring_dedup": fm_index.OP8_SQL,
    "op9_minhash": minhash.OP9_SQL,
    "op11_exact_dedup": block_names.OP11_SQL,
}
