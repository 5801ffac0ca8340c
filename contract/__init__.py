"""Contract queries: each operator run over the given tables, with the SQL that checks it."""

from contract import columns, files, pages, payloads, runs, stores, tables  # noqa: F401
from contract.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
