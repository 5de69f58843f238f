"""All registered queries."""

from __future__ import annotations

from . import corpus, evidence, figures, headings, review, rules, structure, values  # noqa: F401  each registers its own
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
