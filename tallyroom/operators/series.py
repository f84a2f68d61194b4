"""Rolling measures over a daily series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rolling_mean(
    series: DataFrame,
    order_col: str,
    columns: Mapping[str, str],
    rows: int = 7,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Trailing mean over the last ``rows`` rows, shorter at the start.

    ``columns`` maps measure to output name.  The window counts rows, not
    calendar days.  Without ``partition_by`` the series is ordered in one
    task, which is sound for one row per calendar day: run this after the
    daily aggregation, never on order rows.
    """
    trailing = Window.partitionBy(*partition_by).orderBy(F.asc_nulls_last(order_col)).rowsBetween(1 - rows, 0)
    for measure, output in columns.items():
        mean = F.sum(measure).over(trailing).cast("double") / F.nullif(F.count(measure).over(trailing), F.lit(0).cast("bigint"))
        series = series.withColumn(output, mean)
    return series
