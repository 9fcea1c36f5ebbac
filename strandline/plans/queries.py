"""Registry of core queries and their SQL, collected from the modules of this package."""

from __future__ import annotations

from . import catalogue, documents, flow, intake, outputs, problems, records

_MODULES = (documents, catalogue, records, intake, problems, flow, outputs)
QUERIES: dict = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL: dict = {k: v for m in _MODULES for k, v in m.SQL.items()}
