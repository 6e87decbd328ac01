"""A query as layers of named expressions, planned by Spark and, for checks, written as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.dialect import DUCK, SPARK, Spark, for_duck

Layers = Callable[[Spark], list[dict[str, str]]]


def applied(df: DataFrame, layers: Layers) -> DataFrame:
    """df with each layer's columns added; a layer may use those before it."""
    for layer in layers(SPARK):
        df = df.withColumns({name: F.expr(e) for name, e in layer.items()})
    return df


def written(base: str, layers: Layers) -> str:
    sql = base
    for layer in layers(DUCK):
        sql = "SELECT *, " + ", ".join(f"{for_duck(e)} AS {name}" for name, e in layer.items()) + f" FROM ({sql})"
    return sql
