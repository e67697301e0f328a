from crowdpulse.functions.columns import (  # noqa: F401
    ISO_MS_FORMAT,
    PTS_HZ,
    REGULAR_CONTENT,
    duration_interval,
    format_brl,
    format_int_dotted,
    in_window,
    interval_seconds,
    iso_ms,
    minutes_since,
    parse_iso,
    pseudonym,
    pts_to_seconds,
    ratio,
    round_dec,
    seconds_between,
    trimmed,
)
