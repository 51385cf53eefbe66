"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline

from .language import op5_language_id
from .oracle import oracle_sql
from .packing import op1_best_fit_packing
from .pieces import op4_sentencepiece
from .pitman_yor import op3_lm_scoring
from .quality import op6_quality_rules
from .secrets import op2_secret_scans
from .simhash import op10_simhash
from .spotsigs import op7_document_fingerprints
from .substrings import op9_substring_dedup
from .toxicity import op8_toxicity


def queries() -> dict:
    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_best_fit_packing, op2_secret_scans, op3_lm_scoring, op4_sentencepiece, op5_language_id, op6_quality_rules, op7_document_fingerprints, op8_toxicity, op9_substring_dedup, op10_simhash)}


__all__ = ["oracle_sql", "queries"]
