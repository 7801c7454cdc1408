"""Registry of named queries and the SQL text they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sql_key(*parts: str) -> str:
    """SQL text of a deterministic key; parts are SQL expressions of type VARCHAR."""
    joined = " || '|' || ".join(parts)
    return (f"(('0x' || substr(sha256({joined}), 1, 16))::UBIGINT"
            " & 9223372036854775807::UBIGINT)::BIGINT")


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
