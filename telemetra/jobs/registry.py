"""All registered queries and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib

MODULES = [
    "telemetra.jobs.drift_jobs",
    "telemetra.jobs.quality_jobs",
    "telemetra.jobs.profile_jobs",
    "telemetra.jobs.feature_jobs",
    "telemetra.jobs.evaluation_jobs",
    "telemetra.jobs.monitor_jobs",
    "telemetra.jobs.detector_jobs",
    "telemetra.jobs.neighbour_jobs",
    "telemetra.jobs.streaming_jobs",
    "telemetra.jobs.source_jobs",
]


def _load():
    queries, sql = {}, {}
    for name in MODULES:
        mod = importlib.import_module(name)
        queries.update(mod.QUERIES)
        sql.update(getattr(mod, "SQL", {}))
    return queries, sql


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
