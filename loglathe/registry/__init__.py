"""All registered queries."""

from loglathe.registry import parsing, quality, rows, storage  # noqa: F401
from loglathe.registry.core import QUERIES, SQL
from loglathe.registry.quality import flagship

__all__ = ["QUERIES", "SQL", "flagship"]
