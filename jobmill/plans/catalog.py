"""All registered queries."""

from . import q_discovery, q_feed, q_rules, q_run, q_sources, q_tables, q_text, q_vectors  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
