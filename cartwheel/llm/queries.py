"""Queries of this subpackage and, where SQL can express one, its oracle."""

from __future__ import annotations

from cartwheel.llm.ann_search import op2_ann_search
from cartwheel.llm.bpe import op7_byte_bpe
from cartwheel.llm.chat_format import op9_chat_format
from cartwheel.llm.decontamination import op3_decontamination
from cartwheel.llm.jaccard_join import op8_jaccard_join
from cartwheel.llm.lm_scoring import op10_lm_scoring
from cartwheel.llm.mixing import op13_source_mixing
from cartwheel.llm.oracle import ORACLE_SQL  # noqa: F401
from cartwheel.llm.pii import op6_pii
from cartwheel.llm.spelling import op12_spelling_variants
from cartwheel.llm.substring_dedup import op4_substring_dedup
from cartwheel.llm.token_counts import op1_token_counts
from cartwheel.llm.toxicity import op5_toxicity
from cartwheel.llm.vector_codes import op11_vector_codes

QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_ann_search, op3_decontamination, op4_substring_dedup, op5_toxicity,
    op6_pii, op7_byte_bpe, op8_jaccard_join, op9_chat_format, op10_lm_scoring,
    op11_vector_codes, op12_spelling_variants, op13_source_mixing)}
