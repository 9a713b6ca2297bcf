"""Consumer-side counting rule of the logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def funnel_counts(log: DataFrame, by: list[str], id_col: str, date_col: str = "act_date") -> DataFrame:
    """Distinct actions per month and ``by`` keys.

    Logs may repeat an action (one scout mail per attached job, one
    company action per overlapping contract), so actions are counted as
    distinct ids, never as rows.  ``countDistinct`` plans as a two-level
    aggregate (partial dedupe on the map side, then count).
    """
    month = F.trunc(F.to_date(F.col(date_col)), "MM").alias("act_month")
    return log.groupBy(month, *by).agg(F.countDistinct(id_col).alias("n_actions"))
