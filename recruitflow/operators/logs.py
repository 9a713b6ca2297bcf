"""Event-log assembly: branches aligned by name to one declared schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_schema(df: DataFrame, schema: T.StructType, **constants) -> DataFrame:
    """Project ``df`` onto ``schema``: cast present columns, add typed NULLs
    for absent ones, literals for ``constants``."""
    cols = []
    for f in schema.fields:
        if f.name in constants:
            c = F.lit(constants[f.name])
        elif f.name in df.columns:
            c = F.col(f.name)
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_log(branches: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name (branches already share one schema)."""
    return reduce(lambda a, b: a.unionByName(b), branches)
