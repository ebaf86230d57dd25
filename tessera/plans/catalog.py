"""All registered queries and their SQL."""

from __future__ import annotations

from tessera.plans import contents, entities, questions, relational  # noqa: F401  they register their queries
from tessera.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
