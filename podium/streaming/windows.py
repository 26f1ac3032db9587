"""Event-time windows with bounded state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.names import column
from podium.operators.stats import group_averages

# Fixed value: how late a row may be before it is dropped.
LATENESS = "10 minutes"


def windowed_averages(
    df: DataFrame,
    event_time: str,
    group_by: Sequence[str],
    averages: Mapping[str, str],
    scale: int | None = None,
    window: str = "1 hour",
    lateness: str = LATENESS,
    rows: str | None = None,
) -> DataFrame:
    """Averages per group and tumbling event-time window, as `w_start`, `w_end` and the averages.

    With the window among the keys a stream can forget: once the highest event time seen, minus
    `lateness`, passes a window's end, append mode emits the window and its state goes away. Rows
    for closed windows are dropped. A watermark without such a key would keep state forever.
    `rows` names an extra column counting a window's rows. Null measures count as rows but not in
    the averages.

    Event times without zone are taken in the session's time zone; windows start at multiples of
    their length since the UTC epoch.
    """
    timed = df.withColumn(event_time, column(event_time).cast("timestamp")).withWatermark(
        event_time, lateness
    )
    keys = [F.window(column(event_time), window).alias("w"), *group_by]
    stats = group_averages(timed, keys, averages, scale, rows=rows)
    names = [name for name in stats.columns if name != "w"]
    return stats.select(
        F.col("w.start").alias("w_start"),
        F.col("w.end").alias("w_end"),
        *[column(name) for name in names],
    )
