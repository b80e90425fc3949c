"""Queries over the stand-in tables, one or more for each operator, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_DECIMALS = {"d": 8, "f": 10}
_SPARK = {"l": "bigint", "s": "string", "b": "boolean"}
_DUCK = {"l": "BIGINT", "s": "VARCHAR", "b": "BOOLEAN"}


def query(columns: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. columns: 'name kind, ...' of the result; l long, s string, b boolean, d double to 8 decimals, so that
    engines that add in another order agree; f to 10, where values end just past the eighth."""
    spec = [c.split() for c in columns.split(", ")]

    def one(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.select(*[(F.round(F.col(c).cast("double"), _DECIMALS[k]) + F.lit(0.0) if k in _DECIMALS else F.col(c).cast(_SPARK[k])).alias(c) for c, k in spec])

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            cast = ", ".join(f'round("{c}"::DOUBLE, {_DECIMALS[k]}) + 0.0::DOUBLE AS "{c}"' if k in _DECIMALS else f'"{c}"::{_DUCK[k]} AS "{c}"' for c, k in spec)
            ORACLES[f.__name__] = f"SELECT {cast} FROM ({sql})"
        return f

    return one


from . import change_queries, grid_queries, model_queries, product_queries, series_queries, tool_queries, value_queries  # noqa: E402, F401
