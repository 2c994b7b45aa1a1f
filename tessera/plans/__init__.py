"""Registered reports over the driver tables and their DuckDB equivalents."""

from .oracle import ORACLE
from .reports import REPORTS

__all__ = ["ORACLE", "REPORTS"]
