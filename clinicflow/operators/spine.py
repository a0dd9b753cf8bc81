"""S3: calendar spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicflow.functions.dates import to_report_tz
from clinicflow.functions.labels import STORAGE_TZ
from clinicflow.params import ts_lit


def date_spine(spark: SparkSession, start, end, col: str = "visit_date", tz: str = STORAGE_TZ) -> DataFrame:
    """One row per day from ``date(start)`` to ``date(end)`` inclusive, the dates of the bounds in zone ``tz``.

    Empty when start > end (``sequence`` itself would raise). The row count
    is the number of days in the range, independent of the data.
    """
    s, e = F.to_date(to_report_tz(ts_lit(start), tz)), F.to_date(to_report_tz(ts_lit(end), tz))
    days = F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).otherwise(
        F.array().cast("array<date>")
    )
    return spark.range(1).select(F.explode(days).alias(col))


def fill_spine(spine: DataFrame, facts_by_day: DataFrame, key: str, zero_cols: list[str]) -> DataFrame:
    """Spine LEFT JOIN per-day aggregates, missing days as 0.

    Both sides are bounded by the number of days in the range.
    """
    out = spine.join(facts_by_day, key, "left")
    return out.select(key, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in zero_cols])
