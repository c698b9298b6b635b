"""All registered queries with their oracle texts."""

from __future__ import annotations

from . import q_alignments, q_annotation, q_counting, q_coverage, q_qc, q_reads, q_sources, q_splits

QUERIES: dict = {}
ORACLES: dict = {}
for _module in (q_sources, q_reads, q_qc, q_alignments, q_splits, q_coverage, q_counting, q_annotation):
    QUERIES.update(_module.BOOK.queries)
    ORACLES.update(_module.BOOK.oracles)
