"""Literal rows of the media tables: events and markers at seconds after a fixed instant."""

from datetime import datetime, timedelta

T0 = datetime(2024, 1, 1, 12, 0, 0)


def ts(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


EVENT_DDL = ("event_id string, session_id string, timestamp timestamp, event_type string, content_id string, "
             "region string, device string, cdn string, bitrate_kbps int, buffer_length_ms int, error_code string")
MARKER_DDL = "marker_id string, channel string, wallclock timestamp, duration_s int, break_type string"


def ev(eid, sec, etype="heartbeat", session="s1", content="ch-1", cdn="cdn-a", err=None, bitrate=1000,
       region="SE", device="web", buf=100):
    return (eid, session, ts(sec), etype, content, region, device, cdn, bitrate, buf, err)


def mk(mid, sec, channel="ch-1", duration=60, kind="commercial"):
    return (mid, channel, ts(sec), duration, kind)
