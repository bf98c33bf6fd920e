"""Every registered query with the SQL it is checked against."""

from streamtab.catalog import aggregates, machines, patterns, project, sources, streams  # noqa: F401
from streamtab.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
