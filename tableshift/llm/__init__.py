"""Operators for large-scale training data, their queries and their SQL. Nothing else in the package imports this one."""

from tableshift.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
