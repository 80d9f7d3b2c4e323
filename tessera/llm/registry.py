"""Every query of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline

from . import collocations, exact_dedup, filter_audit, fingerprints, html_text, line_dedup, lm_score, mixing, ngram_join, pieces, quality, secrets, warc

_MODULES = [ngram_join, quality, exact_dedup, lm_score, mixing, html_text, pieces, fingerprints, secrets, line_dedup, filter_audit, warc, collocations]
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}
ORACLE = {k: v for m in _MODULES for k, v in getattr(m, "ORACLE", {}).items()}
