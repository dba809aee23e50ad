"""Registered queries: key -> function, and key -> oracle SQL where SQL can state the same result."""

from __future__ import annotations

from functools import wraps
from importlib import import_module

from bureaulake.shipping import ship

MODULES = ["scoring_queries", "report_queries", "decision_queries", "profile_queries", "monitoring_queries", "file_queries", "streaming_queries", "model_queries"]


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"bureaulake.queries.{name}"), attribute)
        clash = merged.keys() & part.keys()
        if clash:
            raise ValueError(f"duplicate query keys: {sorted(clash)}")
        merged.update(part)
    return merged


def _shipped(fn):
    @wraps(fn)
    def run(spark, sf_dir):
        ship(spark)
        return fn(spark, sf_dir)

    return run


def queries() -> dict:
    return {name: _shipped(fn) for name, fn in _merged("QUERIES").items()}


def oracle_sql() -> dict:
    return _merged("ORACLE")
