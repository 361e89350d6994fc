"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from synoptic.plans import catalogue, problems

QUERIES = {**problems.QUERIES, **catalogue.QUERIES}
ORACLE_SQL = {**problems.ORACLE_SQL, **catalogue.ORACLE_SQL}
