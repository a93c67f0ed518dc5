"""Named queries of the library, each with the SQL that gives the same rows."""

from .catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
