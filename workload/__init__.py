"""The engine run on the given tables: role mapping, registered queries, oracle SQL."""

from . import analyses, columns, ingest, relational  # noqa: F401  (they register their queries)
from .registry import QUERIES, run

__all__ = ["QUERIES", "run"]
