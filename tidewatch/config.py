"""Fixed values and column mappings.

Everything an operator needs is a parameter; the defaults below are the
values the sensor pipeline uses.  They live together here so that the
numbers which must agree with the original application are stated once.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the original application's for equal results)
# ---------------------------------------------------------------------------

# Lines containing any of these payload markers are device housekeeping
# frames, not readings.
DENY_MARKERS = ("AAIA", "AQQA")
# A line is a reading only when it mentions one of these dataset ids.
ALLOW_MARKERS = ("temperature_data", "humidity_data")
TEMPERATURE = "temperature_data"
HUMIDITY = "humidity_data"

# Histogram: 20 right-closed bins whose upper edges are 25.5, 26.0, ... 35.0.
BIN_START = 25.5
BIN_STEP = 0.5
BIN_COUNT = 20

# Event-time sliding window.
WINDOW_SIZE = "1 minute"
WINDOW_SLIDE = "10 seconds"

# Rising-streak alarm: emit once a run of strict increases reaches this count
# (the first reading of a run counts as 1).
STREAK_LIMIT = 3

# Timestamp text format of the result tables (a colon between date and time).
WINSTART_FORMAT = "yyyy-MM-dd:HH:mm:ss"

# Dashboard sizes.
LATEST_WINDOWS = 5
LATEST_WINDOWS_WIDE = 10

# Response decoding.
BODY_MARKER = "body="
OK_STATUS = 200

# Content routing.
ROUTE_MARKER = "start"
ROUTE_TOPIC_MATCH = "topic_start"
ROUTE_TOPIC_OTHER = "topic_event"

# Archive layout: /<yyyyMMdd>/<HH>
ARCHIVE_DAY_FORMAT = "yyyyMMdd"
ARCHIVE_HOUR_FORMAT = "HH"


# ---------------------------------------------------------------------------
# Column mapping
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Cols:
    """Names of the reading columns an operator works on.

    ``order`` is the tie-breaker that, together with ``ts``, fixes arrival
    order when two readings of one key share a timestamp.
    """

    device: str = "device_id"
    dataset: str = "dataset_id"
    ts: str = "ts"
    ts_ms: str = "ts_ms"
    value: str = "value"
    order: str = "seq"

    def with_(self, **kw) -> "Cols":
        return replace(self, **kw)


READING_COLS = Cols()


@dataclass(frozen=True)
class EventProfile:
    """Parameters that fit the ``events`` table's value and time ranges.

    ``events`` spans 30 days with values up to a few hundred, so the sensor
    defaults (0.5 degree bins, one-minute windows) are rescaled.  ``click``
    plays temperature and ``view`` plays humidity.
    """

    temperature: str = "click"
    humidity: str = "view"
    deny: tuple = ("error",)
    allow: tuple = ("click", "view")
    bin_start: float = 10.0
    bin_step: float = 10.0
    bin_count: int = 20
    window_size: str = "1 hour"
    window_slide: str = "10 minutes"
    streak_limit: int = 3
    route_marker: str = "sign"
    lateness: str = "3 hours"


EVENTS = EventProfile()
