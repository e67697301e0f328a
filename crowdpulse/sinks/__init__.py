from crowdpulse.sinks.writers import (  # noqa: F401
    bronze_ingest, copy_table, create_table, gold_publish, gold_write_partitioned, read_upserted, silver_upsert,
    write_valid_and_dlq)
