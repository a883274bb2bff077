"""Registration of queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioforge.session import table

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries of one module; ``tables`` are read and handed to the function in this order."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, *tables: str, sql: str | None = None) -> Callable:
        def wrap(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            def query(spark: SparkSession, sf_dir: str) -> DataFrame:
                return make(*[table(spark, sf_dir, t) for t in tables])

            query.__doc__ = make.__doc__
            query.__name__ = name
            self.queries[name] = query
            if sql:
                self.oracle[name] = sql
            return make

        return wrap
