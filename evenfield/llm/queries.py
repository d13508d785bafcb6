"""The operators' queries over the test tables, one per operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import base_columns, exact_dedup, jaccard_join
from .chat_format import op9_chat_format
from .conversation_repair import op13_conversation_repair
from .embedding_whitening import op12_embedding_whitening
from .exact_dedup import op10_exact_dedup
from .html_extract import op4_html_extraction
from .jaccard_join import op8_jaccard_join
from .licenses import op2_license_scan
from .lm_score import op7_lm_score
from .mixing import op1_mix_sources
from .packing import op5_best_fit_packing
from .quality import op6_quality_rules
from .secrets import op3_secret_scan
from .substring_dedup import op11_substring_dedup

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found = [op1_mix_sources, op2_license_scan, op3_secret_scan, op4_html_extraction, op5_best_fit_packing, op6_quality_rules, op7_lm_score, op8_jaccard_join, op9_chat_format, op10_exact_dedup, op11_substring_dedup, op12_embedding_whitening, op13_conversation_repair, *base_columns.QUERIES]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op8_jaccard_join": jaccard_join.ORACLE_SQL, "op10_exact_dedup": exact_dedup.ORACLE_SQL, "op13_conversation_repair": base_columns.REPAIRS} | base_columns.SQL
