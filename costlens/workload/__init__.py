"""Named queries over the driver tables, with their oracle SQL.

Every query reads the given tables whole; the SQL states the same result for a
second engine.
"""

from __future__ import annotations

from importlib import import_module

from costlens.workload.base import ORACLES, QUERIES

FAMILIES = (
    "records",
    "rollups",
    "quality",
    "preparation",
    "features",
    "evaluation",
    "drift",
    "forecasts",
    "monitoring",
    "versions",
    "streams",
)


def load_all() -> None:
    for family in FAMILIES:
        import_module(f"costlens.workload.{family}")


__all__ = ["ORACLES", "QUERIES", "load_all"]
