"""Queries over the supplied tables, grouped by topic."""

from importlib import import_module

from lakeloom.plans.registry import ORACLES, QUERIES

MODULES = (
    "coupon", "tables", "shaping", "combining", "sequences", "checking", "retrieval", "modeling", "streams", "preparation", "upkeep",
)
for _m in MODULES:
    import_module(f"lakeloom.plans.{_m}")

__all__ = ["ORACLES", "QUERIES"]
