"""Registered queries over the driver tables (``queries()``/``oracle_sql()``)."""

from crowdpulse.plans import (  # noqa: F401  (registers)
    analytics_queries, gold_queries, silver_queries, source_queries, stream_queries)
from crowdpulse.plans.registry import ORACLES, QUERIES  # noqa: F401
