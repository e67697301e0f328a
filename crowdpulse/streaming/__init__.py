from crowdpulse.streaming.pipeline import (  # noqa: F401
    ad_interval_join_stream, backfill, dedupe_stream, late_rows, silver_stream, start_to_parquet)
