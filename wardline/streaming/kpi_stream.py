"""KPI rows as a stream: each micro-batch is upserted, then freshness is checked."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wardline.operators.kpi_store import write_kpis
from wardline.plans.pipeline import raise_if_stale


def kpi_batch_writer(kpi_root: str, alerts_root: str, as_of: Callable[[], date]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. A repeated batch rewrites the same keys, so a retry is harmless.

    ``as_of`` tells the day of the freshness check when the batch is written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        raise_if_stale(write_kpis(batch, kpi_root), alerts_root, as_of())

    return write


def start_kpi_stream(
    rows: DataFrame, kpi_root: str, alerts_root: str, checkpoint: str, as_of: Callable[[], date]
) -> StreamingQuery:
    """Start upserting a stream of KPI rows (one row per key within a batch)."""
    writer = kpi_batch_writer(kpi_root, alerts_root, as_of)
    return (
        rows.writeStream.foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
