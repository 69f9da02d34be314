"""Every operator as a query over the test tables, next to SQL that must agree with it."""

from fieldledger.checks import aggregates, chats, columns, gates, scans, splits, texts  # noqa: F401
from fieldledger.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
