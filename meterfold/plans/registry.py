"""Register of queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    run: Query
    sql: str | None


_ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, data folder) -> DataFrame under ``name``."""

    def add(run: Query) -> Query:
        if name in _ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        _ENTRIES[name] = Entry(name, run, sql)
        return run

    return add


def runnables() -> dict[str, Query]:
    return {e.name: e.run for e in _ENTRIES.values()}


def oracles() -> dict[str, str]:
    return {e.name: e.sql for e in _ENTRIES.values() if e.sql is not None}
