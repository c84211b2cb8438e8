"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revspark.llm import chat, collocations, jaccard, substring, suffixes, url_filter
from revspark.llm.bpe import op3_byte_bpe
from revspark.llm.decontaminate import op7_decontaminate
from revspark.llm.language import op10_language_id
from revspark.llm.licenses import op6_license_scan
from revspark.llm.neighbours import op4_neighbours
from revspark.llm.periodic import op12_periodic_runs
from revspark.llm.quality import op2_quality

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_preference_format": chat.op1_preference_format,
    "op2_quality": op2_quality,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_neighbours": op4_neighbours,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_license_scan": op6_license_scan,
    "op7_decontaminate": op7_decontaminate,
    "op8_substring_dedup": substring.op8_substring_dedup,
    "op9_ngram_jaccard": jaccard.op9_ngram_jaccard,
    "op10_language_id": op10_language_id,
    "op11_collocations": collocations.op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_suffix_dedup": suffixes.op13_suffix_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_preference_format": chat.ORACLE_SQL,
    "op5_url_filter": url_filter.ORACLE_SQL,
    "op8_substring_dedup": substring.ORACLE_SQL,
    "op9_ngram_jaccard": jaccard.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
    "op13_suffix_dedup": suffixes.ORACLE_SQL,
}
