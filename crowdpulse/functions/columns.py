"""Scalar column functions. All are built-in Spark expressions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
ISO_MS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"   # wire format of every timestamp
PTS_HZ = 90000                                    # SCTE-35 presentation clock
REGULAR_CONTENT = "conteudo_regular"              # label of rows outside any ad marker


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_dec(x, scale: int) -> Column:
    """``ROUND(x::numeric, n)`` as a double: round through a decimal so the
    half-up rule applies to the decimal value, not to a binary double (F2/F3)."""
    return F.round(c(x).cast("decimal(38,10)"), scale).cast("double")


def ratio(num, den) -> Column:
    """``num / den`` as a double, null when ``den`` is 0."""
    return F.when(c(den) != 0, c(num).cast("double") / c(den).cast("double"))


def iso_ms(ts) -> Column:
    """Format a timestamp as ISO-8601 with milliseconds and ``Z``."""
    return F.date_format(c(ts), ISO_MS_FORMAT)


def parse_iso(s) -> Column:
    """Parse an ISO-8601 string (``Z`` or offset) into a timestamp."""
    return F.to_timestamp(c(s))


def seconds_between(a, b) -> Column:
    """``unix_timestamp(a) - unix_timestamp(b)`` in whole seconds (F8)."""
    return F.unix_timestamp(c(a)) - F.unix_timestamp(c(b))


def pts_to_seconds(pts) -> Column:
    """90 kHz SCTE-35 PTS ticks to seconds."""
    return c(pts).cast("double") / F.lit(PTS_HZ)


def pseudonym(value, key: str, length: int = 16) -> Column:
    """Keyed pseudonym: first ``length`` hex chars of sha256("user:key:value")."""
    return F.substring(F.sha2(F.concat_ws(":", F.lit("user"), F.lit(key), c(value).cast("string")), 256), 1, length)


def minutes_since(ts, start) -> Column:
    """Whole-and-fractional minutes between ``start`` and ``ts``."""
    return (F.unix_micros(c(ts)) - F.unix_micros(c(start))).cast("double") / F.lit(60_000_000.0)


def in_window(minute_col, lo: float, hi: float) -> Column:
    """Half-open membership ``lo <= m < hi``."""
    return (c(minute_col) >= F.lit(lo)) & (c(minute_col) < F.lit(hi))


def format_brl(x) -> Column:
    """Brazilian money text: ``R$ 1.234,56``."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(c(x), 2), ",.", ".,"))


def format_int_dotted(x) -> Column:
    """Integer with dot thousands separators: ``12.345``."""
    return F.translate(F.format_number(c(x), 0), ",", ".")


def trimmed(x) -> Column:
    """Space trim used on every join key that crosses systems (F1)."""
    return F.trim(c(x))


def duration_interval(seconds) -> Column:
    """Seconds (int column) as a day-time interval."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), c(seconds).cast("decimal(18,6)"))


def interval_seconds(text: str) -> int:
    """Parse ``"2 minutes"`` / ``"1 hour"`` / ``"15 seconds"`` into seconds."""
    n, unit = text.strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    scale = {"second": 1, "sec": 1, "minute": 60, "min": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(float(n) * scale)
