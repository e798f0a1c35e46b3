"""Registered queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Data, with_fixtures

MODULES = ("q_history", "q_relational", "q_geometry", "q_rules", "q_register", "q_ingest")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, fixtures: tuple[str, ...] = ()):
    """Register ``fn(data) -> DataFrame`` under ``name``; ``oracle`` is portable SQL."""
    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Data(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = with_fixtures(oracle, *fixtures)
        return fn
    return wrap


def load() -> None:
    from importlib import import_module
    for m in MODULES:
        import_module(f"landloom.checks.{m}")
