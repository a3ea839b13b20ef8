"""The registered queries of the engine's own operators and their DuckDB counterparts."""

from __future__ import annotations

from quarry.plans import agreement, answers, curation, evaluation, files, gold, governance, lint, records, report, review, runs, scalars, search, streams

FLAGSHIP = "bm25_topk"
MODULES = [search, curation, evaluation, governance, scalars, streams, review, lint, records, gold, runs, files, answers, agreement, report]
QUERIES = {k: v for m in MODULES for k, v in m.plans.queries.items()}
ORACLE = {k: v for m in MODULES for k, v in m.plans.oracle.items()}
