"""All registered queries."""

from __future__ import annotations

from lanewarden.plans import detection, reports, streams  # noqa: F401  (each registers its queries)
from lanewarden.plans.registry import ORACLE, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
