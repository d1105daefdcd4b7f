"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm.bit_slices import OP4_SQL, op4_top_products
from tradeloom.llm.bpe import op9_bpe
from tradeloom.llm.near_copies import OP6_SQL, op6_near_copies
from tradeloom.llm.neighbours import OP10_SQL, op10_nearest
from tradeloom.llm.packing import op7_packing
from tradeloom.llm.quality import op1_quality
from tradeloom.llm.repeats import op5_suffix_dedup
from tradeloom.llm.runs import op11_runs
from tradeloom.llm.secrets import op3_secrets
from tradeloom.llm.toxicity import op8_toxicity
from tradeloom.llm.urls import op2_urls
from tradeloom.llm.variants import op13_variants
from tradeloom.llm.winnowing import OP12_SQL, op12_decontamination

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_urls": op2_urls,
    "op3_secrets": op3_secrets,
    "op4_top_products": op4_top_products,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_near_copies": op6_near_copies,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_nearest": op10_nearest,
    "op11_runs": op11_runs,
    "op12_decontamination": op12_decontamination,
    "op13_variants": op13_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op4_top_products": OP4_SQL,
    "op6_near_copies": OP6_SQL,
    "op10_nearest": OP10_SQL,
    "op12_decontamination": OP12_SQL,
}
