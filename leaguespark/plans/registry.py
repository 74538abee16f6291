"""Named queries and their SQL twins, collected from the modules of ``plans``."""

from __future__ import annotations

from leaguespark.plans import captured, captures, domain, ledgers, loads, matches, pipelines, predicates, profiles, relational, reports, scalars, stored, streams, texts

QUERIES: dict = {}
ORACLES: dict = {}
for _module in (matches, captures, relational, texts, predicates, scalars, domain, loads, reports, captured, streams, stored, ledgers, profiles, pipelines):
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
