"""The registered queries of the operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import (decontaminate, fingerprints, grace_dedup, language_id, pii, prefix_trie, quality_fm, sentencepiece_wfst, sharding,
                             simhash, substring_dedup, url_filter, vector_codes)
from scriptorium.llm.common import small_batches, table


def _on(op: Callable, *names: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return op(spark, *[table(spark, sf_dir, n) for n in names])
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": _on(sentencepiece_wfst.op1, "documents"),
    "op2_substring_dedup": _on(substring_dedup.op2, "documents"),
    "op3_decontaminate": _on(decontaminate.op3, "documents", "benchmark"),
    "op4_fingerprints": _on(fingerprints.op4, "documents"),
    "op5_url_filter": _on(url_filter.op5, "pages"),
    "op6_language_id": _on(language_id.op6, "documents"),
    "op7_simhash": _on(simhash.op7, "documents"),
    "op8_quality": _on(quality_fm.op8, "documents", "labels"),
    "op9_sharding": _on(sharding.op9, "documents"),
    "op10_pii": _on(pii.op10, "documents"),
    "op11_exact_dedup": _on(grace_dedup.op11, "documents"),
    "op12_prefix_trie": _on(prefix_trie.op12, "conversations"),
    "op13_vector_codes": _on(vector_codes.op13, "embeddings"),
}

ORACLE: dict[str, str] = {
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op3_decontaminate": decontaminate.ORACLE,
    "op11_exact_dedup": grace_dedup.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}
