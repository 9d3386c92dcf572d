"""Run a windowed health figure of ``plans.monitoring`` on a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Event time as TIMESTAMP; a watermark does not accept the zone-less type."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def start(
    stream: DataFrame,
    figure: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    continuous: str | None = None,
) -> StreamingQuery:
    """Append finished windows to a Parquet table. Windows still open when the
    stream ends are held back until the watermark passes them."""
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        figure(stream)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
