"""The registered queries and, for each, the SQL that states its result."""

from __future__ import annotations

from tableshift.queries import audits, changes, gates, movement, scans, switchovers, syncs, verification
from tableshift.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "audits", "changes", "gates", "movement", "scans", "switchovers", "syncs", "verification"]
