"""How a query and its SQL are registered together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalogue:
    """Queries by name, with the SQL for DuckDB of those that have one."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(query: Query) -> Query:
            self.queries[query.__name__] = query
            if sql:
                self.sql[query.__name__] = sql.strip()
            return query

        return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def decoded_sql(column: str) -> str:
    """SQL of a JSON column with re-encoding undone; null where the text is not valid JSON as a whole."""
    out = column
    for _ in range(3):
        out = f"(CASE WHEN {out} IS NULL OR NOT json_valid({out}) THEN NULL WHEN json_type({out}) = 'VARCHAR' THEN {out} ->> '$' ELSE {out} END)"
    return f"(CASE WHEN json_valid({out}) THEN {out} END)"
