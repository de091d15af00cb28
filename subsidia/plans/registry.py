"""Names of the registered queries, with their SQL counterparts."""

from __future__ import annotations

from subsidia.plans import cubes, products, validation

QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _module in (cubes, products, validation):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.SQL
