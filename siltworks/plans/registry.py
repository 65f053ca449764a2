"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from siltworks.plans import registered_checks, registered_history, registered_loading, registered_model

MODULES = [registered_model, registered_loading, registered_checks, registered_history]


def all_queries() -> dict:
    return {name: q for m in MODULES for name, q in m.catalogue.queries.items()}


def all_sql() -> dict[str, str]:
    return {name: s for m in MODULES for name, s in m.catalogue.sql.items()}
