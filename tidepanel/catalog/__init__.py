"""One registered query per operator, with the SQL it is checked against."""

from tidepanel.catalog import cross, fits, joins, jobs, scalars, scans, series  # noqa: F401
from tidepanel.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
