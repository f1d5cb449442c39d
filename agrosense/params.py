"""Query parameters. Defaults are the reference's literals."""

from __future__ import annotations

from dataclasses import dataclass

TREND_DIRECTIONS = ("reference", "chronological")
STREAM_MODES = ("event_time", "per_batch")


@dataclass(frozen=True)
class Thresholds:
    # Defaults equal the reference's thresholds.
    alert_temp_min: float = -1.0        # temperature_alert: hourly mean temperature > this
    alert_water_max: float = 0.249      # water_content_alert: hourly mean soil water < this
    rain_min: float = -1.0              # dont_irrigate: hourly mean rain > this
    combined_temp_min: float = -1.0     # combined_sickness_alert: mean temperature > this
    combined_water_max: float = 0.5     # ... and mean soil water < this
    hot_reading_min: float = 22.0       # days_to_water: a reading is hot when > this
    hot_readings_over: int = 10         # ... a day needs more than this many hot readings
    rain_reading_min: float = 0.0       # ... and no reading with rain > this
    top_k: int = 10                     # top-10 reports
    trend_days: int = 3                 # last_3_days_trend
    interval_hours: int = 12            # dont_irrigate interval length
    daily_digits: int = 2               # daily results are rounded half-up to 2 places
    # Our additions.
    hourly_digits: int | None = 9       # hourly means: rounded so results do not depend on
                                        # summation order (partitioning); None = unrounded
    trend_direction: str = "reference"  # or "chronological"
    min_readings_per_day: int | None = None  # optional full-day filter (288 in a comment)

    def __post_init__(self):
        if self.trend_direction not in TREND_DIRECTIONS:
            raise ValueError(f"trend_direction must be one of {TREND_DIRECTIONS}")


@dataclass(frozen=True)
class StreamSettings:
    trigger_seconds: int = 12                 # fixed value: the reference's micro-batch
    weather_delay: str = "10 minutes"         # watermark delay, weather stream
    soil_delay: str = "1 hour"                # watermark delay, soil stream (nodes drift)
    window: str = "1 hour"
    mode: str = "event_time"                  # or "per_batch" (the reference's behaviour)
    state_partitions: int | None = None       # partitions of the stateful aggregate; its
                                              # keys are (topic, open hour), so size it to
                                              # the number of sensors, not the data volume.
                                              # None = the session's shuffle partitions.
    state_store: str | None = None            # "rocksdb": keep state off the JVM heap
                                              # (many sensors); None = session default
    dedupe: bool = False                      # drop redelivered readings (same topic and
                                              # _id) within the watermark delay
    max_files_per_trigger: int | None = None
    available_now: bool = False

    def __post_init__(self):
        if self.mode not in STREAM_MODES:
            raise ValueError(f"mode must be one of {STREAM_MODES}")
        if self.state_store not in (None, "rocksdb", "hdfs"):
            raise ValueError("state_store must be None, 'rocksdb' or 'hdfs'")


DEFAULT = Thresholds()
