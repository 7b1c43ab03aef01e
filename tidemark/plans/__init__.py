"""Registered queries over the driver tables (one module per family)."""

from __future__ import annotations

import importlib

from tidemark.plans.common import REGISTRY, Query

_MODULES = ("reconcile_q", "normalize_q", "metrics_q", "sites_q", "quality_q", "community_q", "geometry_q")


def load_all() -> dict[str, Query]:
    for m in _MODULES:
        importlib.import_module(f"tidemark.plans.{m}")
    return REGISTRY


def queries():
    return {name: q.fn for name, q in load_all().items()}


def oracle_sql():
    return {name: q.sql for name, q in load_all().items() if q.sql}
