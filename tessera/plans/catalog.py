"""All registered queries (importing the modules fills the registry)."""

from __future__ import annotations

from tessera.plans import exact_models, features, invariants, models, readers, relational, streams, text  # noqa: F401
from tessera.plans.registry import QUERIES, SQL


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
