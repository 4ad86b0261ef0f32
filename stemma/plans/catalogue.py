"""Every query of the engine's own operators with the SQL that must give the same rows."""

from __future__ import annotations

from . import q_clusters, q_groups, q_joins, q_stages, q_text  # noqa: F401  (they register their queries)
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
