"""Every registered query of the library's own operators, and its SQL."""

from __future__ import annotations

from . import hierarchy, pages, reports, snapshots, texts  # noqa: F401  they register
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
