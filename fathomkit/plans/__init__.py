"""Registered queries over the given tables, one module per family of operators."""

from __future__ import annotations

from importlib import import_module

FAMILIES = (
    "tables_io", "cleaning", "joining", "grouping", "ordering", "sampling", "scalars",
    "describing", "testing", "learning", "bayesian", "triples", "streams", "customers",
)

for _family in FAMILIES:
    import_module(f"fathomkit.plans.{_family}")

from fathomkit.plans.registry import ORACLES, QUERIES  # noqa: E402,F401
