"""Silver with a marker table that grows while the stream runs.

Spark lists a static file table once for a streaming query, and a stream-stream join lets a sparse cue feed hold everything
back. Here each micro-batch re-reads the marker table, and events wait ``hold`` of event time for their markers: a window is
computed when the newest event seen is ``hold`` past its end. The hold doesn't depend on markers coming at all.

The waiting events are the one state: batch N reads what batch N - 1 left and writes what it leaves itself, both under the
batch's number, so that a replayed batch does the same again. A window is written once, whole, in the batch that closes it;
events that come for a window already written are late (``late_rows`` finds them in Bronze).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crowdpulse.functions.columns import interval_seconds
from crowdpulse.operators.silver import silver_qoe

EVENT_COLUMNS = ("event_id", "session_id", "timestamp", "event_type", "content_id", "region", "device", "cdn", "bitrate_kbps",
                 "buffer_length_ms", "error_code")


def silver_with_fresh_markers(events: DataFrame, read_markers: Callable[[], DataFrame], path: str, state: str, checkpoint: str, *,
                              window: str = "1 minute", span: str = "2 minutes", hold: str = "5 minutes",
                              trigger: dict | None = None) -> StreamingQuery:
    """Start the stream (``events`` deduplicated before). Silver rows land in ``path`` by ``batch_id``, exact CCV included;
    waiting events in ``state``. ``read_markers`` is called in every batch. One stream writes a path."""
    spark = events.sparkSession
    kept = events.select(*EVENT_COLUMNS)
    schema = kept.schema
    size, wait = interval_seconds(window), interval_seconds(hold)

    def process(batch: DataFrame, batch_id: int) -> None:
        waiting = batch
        if batch_id:
            waiting = batch.unionByName(spark.read.schema(schema).parquet(f"{state}/batch_id={batch_id - 1}"))
        waiting = waiting.persist()
        try:
            newest = waiting.agg(F.max(F.unix_seconds("timestamp"))).first()[0]
            close = None if newest is None else (newest - wait) // size * size  # windows that end here or before are closed
            over = F.lit(False) if close is None else F.unix_seconds("timestamp") < F.lit(close)
            waiting.where(~over).write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
            done = waiting.where(over)
            silver = silver_qoe(done, read_markers(), window, span, dedupe_keys=None)
            silver.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            waiting.unpersist()

    return kept.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
