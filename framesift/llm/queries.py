"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from framesift.llm.decontam import op3_benchmark_decontamination
from framesift.llm.licenses import op7_license_scans
from framesift.llm.mainhtml import op1_html_extraction
from framesift.llm.minhash import op6_minhash_near_dedup
from framesift.llm.packing import op8_best_fit_packing
from framesift.llm.tokencount import op2_token_counts
from framesift.llm.tokenfile import op9_token_files
from framesift.llm.toxicity import op4_toxicity
from framesift.llm.urlrep import OP5_SQL, op5_url_filters
from framesift.llm.vectors import op10_embedding_near_dedup

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_token_counts": op2_token_counts,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_toxicity": op4_toxicity,
    "op5_url_filters": op5_url_filters,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_license_scans": op7_license_scans,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_token_files": op9_token_files,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
}
ORACLE_SQL = {"op5_url_filters": OP5_SQL}
