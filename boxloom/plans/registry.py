"""Registered queries: a DataFrame function each, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boxloom.plans.fixtures import VIEWS, table, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """The derived tables of one scale folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)


def query(sql: str | None = None, name: str | None = None):
    """Register `fn(inputs)`; `sql` may name any view of the fixtures or of the shared oracle parts."""

    def add(fn: Callable[[Inputs], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            from boxloom.plans.oracle_parts import ORACLE_VIEWS

            ORACLES[key] = with_views(sql, {**VIEWS, **ORACLE_VIEWS}, once="o_")
        return fn

    return add
