"""All queries of this subpackage."""

from . import (  # noqa: F401
    q_alignment,
    q_chat,
    q_clustering,
    q_decontaminate,
    q_language,
    q_lm,
    q_mixing,
    q_neardup,
    q_pii,
    q_quality,
    q_sharding,
    q_toxicity,
    q_warc,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
