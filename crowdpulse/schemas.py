"""Schemas of the four inputs and two managed tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


DEVICE = T.StructType([_f("type", S), _f("model", S), _f("os", S), _f("app_version", S)])
GEO = T.StructType([_f("region", S), _f("state", S), _f("city", S), _f("isp", S)])

# Wire schema of player events; error_code is a string (the producer's type, D21).
PLAYER_EVENT = T.StructType([
    _f("event_id", S), _f("session_id", S), _f("user_id", S), _f("timestamp", TS),
    _f("event_type", S), _f("content_id", S), _f("is_live", B),
    _f("device", DEVICE), _f("geo", GEO), _f("cdn", S),
    _f("bitrate_kbps", I), _f("buffer_length_ms", I), _f("playhead_position_s", I),
    _f("error_code", S), _f("schema_version", S), _f("network_type", S),
])

SCTE35_MARKER = T.StructType([
    _f("marker_id", S), _f("channel", S), _f("splice_command", S), _f("event_id_scte", I),
    _f("out_of_network", B), _f("pts_time", L), _f("wallclock", TS), _f("duration_s", I), _f("break_type", S),
])

CONTENT_METADATA = T.StructType([
    _f("content_id", S), _f("title", S), _f("genre", S), _f("is_live", B), _f("is_premium", B),
    _f("scheduled_start_utc", TS), _f("scheduled_end_utc", TS),
    _f("rights_window_start", TS), _f("rights_window_end", TS),
    _f("rights_territories", T.ArrayType(S)), _f("classification", S), _f("ad_pod_policy", S),
    _f("language", S), _f("duration_min", I), _f("eidr_id", S), _f("gracenote_id", S),
    _f("created_at", TS), _f("updated_at", TS),
])

AD_DECISION = T.StructType([
    _f("decision_id", S), _f("marker_id", S), _f("event_id_scte", I), _f("channel", S),
    _f("user_id_anon", S), _f("slot_index", I), _f("creative_id", S), _f("creative_duration_s", I),
    _f("advertiser_id", S), _f("advertiser_name", S), _f("price_cpm_brl", D), _f("served_ts", TS),
    _f("ssai_provider", S),
])

# Kafka record layout kept by Bronze.
RAW = T.StructType([
    _f("key", T.BinaryType()), _f("value", T.BinaryType()), _f("topic", S), _f("partition", I),
    _f("offset", L), _f("timestamp", TS), _f("timestampType", I),
])

# Silver adds event_count / error_count so ratios can be re-weighted.
SILVER = T.StructType([
    _f("window_start", TS), _f("window_end", TS), _f("region", S), _f("device", S), _f("cdn", S),
    _f("marker_id", S), _f("ccv", L), _f("avg_bitrate_kbps", D), _f("avg_buffer_length_ms", D),
    _f("error_rate", D), _f("rebuffering_ratio", D), _f("event_count", L), _f("error_count", L),
])
SILVER_KEY = ("window_start", "region", "device", "cdn", "marker_id")

GOLD = T.StructType([
    _f("window_start", TS), _f("marker_id", S), _f("content_title", S), _f("genre", S),
    _f("advertiser_name", S), _f("region", S), _f("device", S), _f("cdn", S), _f("ccv", L),
    _f("total_revenue_brl", D), _f("avg_bitrate_kbps", D), _f("error_rate", D),
])

# Flattened player event as Silver consumes it.
FLAT_EVENT_COLUMNS = ("event_id", "session_id", "timestamp", "event_type", "content_id", "region",
                      "device", "cdn", "bitrate_kbps", "buffer_length_ms", "error_code",
                      "network_type", "schema_version")
