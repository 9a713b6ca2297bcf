"""Per-group first-row selection and row numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_row(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group by ``order``, whole.

    One ``min_by`` of the row as a struct: partially aggregated on the map
    side, so a group never reaches one task whole and nothing is joined
    back.  ``order`` is a struct comparison (encode NULL placement and
    descending keys in it) and should end in a key, so ties are broken.
    """
    rest = [c for c in df.columns if c not in group]
    row = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*group).agg(row).select(*group, "_row.*").select(*df.columns)


def first_per_group(df: DataFrame, group: list[str], order: list[Column], id_col: str) -> DataFrame:
    """One row per group: ``group`` columns + the ``id_col`` of its first row by ``order``."""
    return df.groupBy(*group).agg(F.min_by(F.col(id_col), F.struct(*order)).alias(id_col))


def asc_nulls_last(c: str) -> list[Column]:
    """Sort-key parts for ``c ASC NULLS LAST`` inside a struct comparison."""
    return [F.col(c).isNull(), F.col(c)]


def row_number_in_group(df: DataFrame, group: str, order: list[Column], out: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)`` as a bigint.

    For groups whose size has a bound (a company's contracts after
    de-duplication: one per start date, so at most the days of the
    calendar); a group is ordered in one task, which may spill.
    """
    return df.withColumn(out, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("bigint"))
