"""Registered queries and their SQL counterparts."""

from . import (  # noqa: F401
    audit_queries,
    judge_queries,
    match_queries,
    model_queries,
    privacy_queries,
    retrieval_queries,
    text_queries,
)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
