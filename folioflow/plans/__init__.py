"""Registered queries over the driver tables."""

from . import catalog_queries, exchange_queries, law_queries, relation_queries, report_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
