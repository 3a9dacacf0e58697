"""All registered queries, by inventory ID."""

from __future__ import annotations

from importlib import import_module

from shelfwise.plans.context import REGISTRY, runner
from shelfwise.plans.oracle.base import ORACLE

_AREAS = (
    "kpis", "sales", "product", "store", "pricing", "promotion", "customer", "series", "ctes", "rankings",
    "segments", "dashboard", "advanced", "views", "final_report",
    "validation", "build", "exploration", "feature_jobs", "ml", "ml_applied", "io_jobs",
)

for _area in _AREAS:
    import_module(f"shelfwise.plans.{_area}")
    import_module(f"shelfwise.plans.oracle.{_area}")


def queries() -> dict:
    return {name: runner(name) for name in REGISTRY}


def oracles() -> dict[str, str]:
    return {name: ORACLE[name] for name in REGISTRY if name in ORACLE}
