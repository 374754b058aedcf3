"""Loads every module that registers jobs."""

from __future__ import annotations

import importlib

from dayledger.registry import JOBS, Job

MODULES = [
    f"dayledger.{m}"
    for m in ("plans.pipeline", "plans.rows", "plans.joins", "plans.aggregates", "plans.windows", "plans.sorts_sets", "plans.scalar", "plans.files", "plans.udfs", "streaming.jobs", "plans.graphs", "plans.models", "plans.features")
]


def all_jobs() -> dict[str, Job]:
    for m in MODULES:
        importlib.import_module(m)
    return JOBS
