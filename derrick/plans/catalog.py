"""All registered queries."""

from __future__ import annotations

from derrick.plans import queries_files, queries_jobs, queries_series, queries_tables  # noqa: F401
from derrick.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracles():
    return dict(ORACLES)
