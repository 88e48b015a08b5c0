"""All registered queries."""

from __future__ import annotations

from . import (  # noqa: F401  (register on import)
    queries_catalog,
    queries_features,
    queries_loads,
    queries_quality,
    queries_requests,
)
from .registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def sql() -> dict[str, str]:
    return dict(SQL)
