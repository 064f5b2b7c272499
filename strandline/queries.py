"""The registered queries over the driver's tables, and SQL that gives the same rows."""

from __future__ import annotations

from .plans import assembly_queries, building_queries, curation_queries, event_queries, hit_queries, interval_queries, mapping_queries, merging_queries, model_queries, ranking_queries, refinement_queries

_MODULES = (interval_queries, ranking_queries, model_queries, event_queries, building_queries, curation_queries, hit_queries, refinement_queries, assembly_queries, merging_queries, mapping_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}
FLAGSHIP = "masked_bases_by_region"
