"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from stockmap.llm import oracle
from stockmap.llm.class_ngrams import op1_class_ngrams
from stockmap.llm.embedding_whitening import op11_whitening
from stockmap.llm.exact_dedup import op5_exact_dedup
from stockmap.llm.impact_search import op12_lexical_search
from stockmap.llm.license_scan import op10_license_scan
from stockmap.llm.mix_sources import op6_mix_sources
from stockmap.llm.near_dedup import op4_near_dedup
from stockmap.llm.pack_windows import op2_pack_windows
from stockmap.llm.personal_data import op3_personal_data
from stockmap.llm.posting_lists import op7_nearest
from stockmap.llm.quality_ftrl import op13_quality
from stockmap.llm.shuffle_shards import op9_feistel_shards
from stockmap.llm.toxicity import op8_toxicity

LLM_QUERIES = {
    "op1_class_ngrams": op1_class_ngrams,
    "op2_pack_windows": op2_pack_windows,
    "op3_personal_data": op3_personal_data,
    "op4_near_dedup": op4_near_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_mix_sources": op6_mix_sources,
    "op7_nearest": op7_nearest,
    "op8_toxicity": op8_toxicity,
    "op9_feistel_shards": op9_feistel_shards,
    "op10_license_scan": op10_license_scan,
    "op11_whitening": op11_whitening,
    "op12_lexical_search": op12_lexical_search,
    "op13_quality": op13_quality,
}

#: Only queries that SQL can express; the others are held against brute force in tests/llm.
LLM_ORACLE = {
    "op5_exact_dedup": oracle.EXACT_DEDUP,
    "op6_mix_sources": oracle.mix_sources(),
    "op10_license_scan": oracle.license_scan(),
    "op12_lexical_search": oracle.LEXICAL_SEARCH,
}
