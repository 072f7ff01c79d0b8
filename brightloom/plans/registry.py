"""All named queries with the SQL each is checked against (None where SQL has no form)."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "customer_queries", "quality_queries", "function_queries", "catalogue_queries", "experiment_queries", "model_queries",
)

PLANS = {}
for _module in MODULES:
    PLANS.update(import_module(f"brightloom.plans.{_module}").PLANS)
