"""All registered queries of the map-editing part and their SQL."""

from __future__ import annotations

from editpulse.checks import files, oracle, queries

QUERIES: dict[str, queries.Query] = {**queries.QUERIES, **files.QUERIES}
ORACLE: dict[str, str] = {**oracle.ORACLE, **files.SQL}
