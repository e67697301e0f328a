"""Data contracts of the four feeds (DQ8), as plain field lists.

Each field: (json path, kind, required, nullable). ``kind`` is one of
string / integer / number / boolean / array / object. Corrected per D21: ``error_code`` is a
string or null, ``schema_version`` and ``network_type`` are optional (v2).
"""

from __future__ import annotations

# The fields, types and required sets of the reference contracts.
PLAYER_EVENT_CONTRACT = (
    ("event_id", "string", True, False),
    ("session_id", "string", True, False),
    ("user_id", "string", True, False),
    ("timestamp", "string", True, False),
    ("event_type", "string", True, False),
    ("content_id", "string", True, False),
    ("is_live", "boolean", True, False),
    ("device", "object", True, False),
    ("device.type", "string", True, False),
    ("device.model", "string", True, False),
    ("device.os", "string", True, False),
    ("device.app_version", "string", True, False),
    ("geo", "object", True, False),
    ("geo.region", "string", True, False),
    ("geo.state", "string", True, False),
    ("geo.city", "string", True, False),
    ("geo.isp", "string", True, False),
    ("cdn", "string", True, False),
    ("bitrate_kbps", "integer", True, False),
    ("buffer_length_ms", "integer", True, False),
    ("playhead_position_s", "integer", True, False),
    ("error_code", "string", True, True),
    ("network_type", "string", False, True),
    ("schema_version", "string", False, True),
)

MARKER_CONTRACT = (
    ("marker_id", "string", True, False),
    ("channel", "string", True, False),
    ("splice_command", "string", True, False),
    ("event_id_scte", "integer", True, False),
    ("out_of_network", "boolean", True, False),
    ("pts_time", "integer", True, False),
    ("wallclock", "string", True, False),
    ("duration_s", "integer", True, False),
    ("break_type", "string", True, False),
)

CONTENT_CONTRACT = (
    ("content_id", "string", True, False),
    ("title", "string", True, False),
    ("genre", "string", True, False),
    ("is_live", "boolean", True, False),
    ("is_premium", "boolean", True, False),
    ("scheduled_start_utc", "string", True, False),
    ("scheduled_end_utc", "string", True, False),
    ("rights_window_start", "string", True, False),
    ("rights_window_end", "string", True, False),
    ("rights_territories", "array", True, False),
    ("classification", "string", True, False),
    ("ad_pod_policy", "string", True, False),
    ("language", "string", True, False),
    ("duration_min", "integer", True, False),
    ("eidr_id", "string", True, False),
    ("gracenote_id", "string", True, False),
    ("created_at", "string", True, False),
    ("updated_at", "string", True, False),
)

AD_DECISION_CONTRACT = (
    ("decision_id", "string", True, False),
    ("marker_id", "string", True, False),
    ("event_id_scte", "integer", False, True),
    ("channel", "string", True, False),
    ("user_id_anon", "string", False, True),
    ("slot_index", "integer", True, False),
    ("creative_id", "string", True, False),
    ("creative_duration_s", "integer", False, True),
    ("advertiser_id", "string", True, False),
    ("advertiser_name", "string", True, False),
    ("price_cpm_brl", "number", True, False),
    ("served_ts", "string", True, False),
    ("ssai_provider", "string", False, True),
)

# Allowed values by path (values the producers emit).
MARKER_ENUMS = {"break_type": ("commercial", "program_boundary", "blackout")}

# Variant type names accepted for each contract kind; parameters in parentheses or brackets are cut off.
VARIANT_KINDS = {
    "string": ("STRING",),
    "integer": ("TINYINT", "SMALLINT", "INT", "BIGINT"),
    "number": ("TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL", "FLOAT", "DOUBLE"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}
