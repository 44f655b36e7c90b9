"""All registered queries with their check SQL."""

from __future__ import annotations

from opinara.plans import catalog_balance, catalog_models, catalog_tables, catalog_text

QUERIES: dict = {}
ORACLE: dict = {}
for _module in (catalog_tables, catalog_text, catalog_balance, catalog_models):
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
