"""Queries and their SQL counterparts over the given tables."""

from contract import aggregates, payloads, streams, texts, zones  # noqa: F401
from contract.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
