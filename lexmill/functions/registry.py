"""User-defined functions, aggregates and table functions for SQL text."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def register_function(spark: SparkSession, name: str, f: Callable[[pd.Series], pd.Series], kind: str) -> None:
    """A vectorised scalar function."""
    spark.udf.register(name, F.pandas_udf(f, kind))


def register_aggregate(spark: SparkSession, name: str, f: Callable[[pd.Series], object], kind: str) -> None:
    """An aggregate over all values of a group."""

    def total(values: pd.Series) -> object:
        return f(values)

    total.__annotations__ = {"values": pd.Series, "return": float if kind == "double" else int if kind in ("long", "int") else str}
    spark.udf.register(name, F.pandas_udf(total, kind, F.PandasUDFType.GROUPED_AGG))


def register_table_function(spark: SparkSession, name: str, cls: type, kind: str) -> None:
    """A table function: a class with eval() that yields rows."""
    spark.udtf.register(name, F.udtf(cls, returnType=kind))
