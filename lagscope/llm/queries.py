"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .base import table
from .collocations import collocations
from .decontam import decontaminate
from .exact_dedup import exact_dedup
from .html_extract import extract
from .line_dedup import duplicate_lines
from .merkle import manifest
from .mixing import mix_digest
from .ngram_join import near_copies
from .pii import pseudonym_texts
from .sharding import shard_digest
from .suffix_dedup import passage_digest
from .toxicity import score_toxicity
from .url_filter import judge, rule_table

Query = Callable[[SparkSession, str], DataFrame]


def _on(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def _decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_sharding": _on("documents", shard_digest),
        "op2_toxicity": _toxicity,
        "op3_line_dedup": _on("documents", duplicate_lines),
        "op4_mixing": _on("documents", mix_digest),
        "op5_decontamination": _decontam,
        "op6_url_filter": _url_filter,
        "op7_ngram_join": _on("documents", near_copies),
        "op8_pii": _on("documents", pseudonym_texts),
        "op9_exact_dedup": _on("documents", exact_dedup),
        "op10_html_extraction": _on("pages", extract),
        "op11_merkle_manifest": _on("documents", manifest),
        "op12_collocations": _on("documents", collocations),
        "op13_suffix_dedup": _on("documents", passage_digest),
    }


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express. The others have tests against plain versions."""
    return {
        "op4_mixing": oracle.MIXING,
        "op5_decontamination": oracle.DECONTAMINATION,
        "op6_url_filter": oracle.URL_FILTER,
        "op9_exact_dedup": oracle.EXACT_DEDUP,
        "op11_merkle_manifest": oracle.MERKLE,
        "op12_collocations": oracle.COLLOCATIONS,
        "op13_suffix_dedup": oracle.SUFFIX_DEDUP,
    }
