"""Telemetry specification: which columns play which role, and the naming algebra.

Every operator in the library takes a :class:`TelemetrySpec`, so the same code runs on the
drive-day schema of the original pipeline and on any other table that has an entity, a group,
a date, an event flag and some numeric readings.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql.types import (
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values: must equal the original pipeline for identical results -----------------
# SMART attribute id -> descriptive name, in this order.
SMART_ATTRIBUTES = {
    5: "reallocated_sector_count",
    9: "power_on_hours",
    187: "reported_uncorrectable_errors",
    188: "command_timeout",
    194: "temperature_celsius",
    197: "current_pending_sector_count",
    198: "offline_uncorrectable_count",
}
# Cumulative error counters (their growth signals wear).
SMART_ERROR_COUNTER_IDS = (5, 187, 188, 197, 198)
TEMPERATURE_ATTRIBUTE_ID = 194
TREND_ROWS = (7, 30)
LABEL_HORIZON_DAYS = 30
RISK_ZSCORE_THRESHOLD = 2.0
TRAIN_BUCKET_LIMIT = 70
VALIDATION_BUCKET_LIMIT = 80
NEGATIVE_TO_POSITIVE_RATIO = 20
RANDOM_SEED = 7740
THRESHOLD_STEP = 0.05
THRESHOLD_COUNT = 19  # 0.05, 0.10, ..., 0.95
CAPACITY_TB_DIVISOR = 1e12
DAYS_PER_YEAR = 365.0
# --------------------------------------------------------------------------------------------

ZSCORE_SUFFIX = "_model_zscore"
REPORTED_SUFFIX = "_reported"


@dataclass(frozen=True)
class Metric:
    """One numeric reading: an id, a human name and the raw column that holds it."""

    id: int
    name: str
    raw: str
    normalized: str | None = None

    @property
    def zscore(self) -> str:
        return f"{self.raw}{ZSCORE_SUFFIX}"

    @property
    def reported(self) -> str:
        return f"{self.raw}{REPORTED_SUFFIX}"

    def trend(self, n: int) -> str:
        return f"{self.raw}_trend_{n}d"

    @property
    def daily_delta(self) -> str:
        return f"{self.raw}_daily_delta"

    @property
    def weekly_increase(self) -> str:
        return f"{self.raw}_weekly_increase"


def smart_metric(attribute_id: int) -> Metric:
    return Metric(
        attribute_id,
        SMART_ATTRIBUTES[attribute_id],
        f"smart_{attribute_id}_raw",
        f"smart_{attribute_id}_normalized",
    )


@dataclass(frozen=True)
class TelemetrySpec:
    """Roles of the columns of an entity-day telemetry table plus the tuning constants."""

    entity: str = "serial_number"
    group: str = "model"
    date: str = "date"
    event: str = "failure"
    capacity: str | None = "capacity_bytes"
    metrics: tuple[Metric, ...] = field(
        default_factory=lambda: tuple(smart_metric(i) for i in SMART_ATTRIBUTES)
    )
    error_counter_ids: tuple[int, ...] = SMART_ERROR_COUNTER_IDS
    temperature_id: int | None = TEMPERATURE_ATTRIBUTE_ID
    trend_rows: tuple[int, ...] = TREND_ROWS
    trend_frame: str = "rows"  # "rows" (original behaviour) or "days" (calendar frame)
    horizon_days: int = LABEL_HORIZON_DAYS
    z_threshold: float = RISK_ZSCORE_THRESHOLD
    label: str = "failure_label"

    def with_(self, **changes) -> "TelemetrySpec":
        return replace(self, **changes)

    # -- metric views -------------------------------------------------------------------------
    @property
    def raw_columns(self) -> list[str]:
        return [m.raw for m in self.metrics]

    @property
    def normalized_columns(self) -> list[str]:
        return [m.normalized for m in self.metrics if m.normalized]

    def metric(self, metric_id: int) -> Metric:
        for m in self.metrics:
            if m.id == metric_id:
                return m
        raise KeyError(metric_id)

    @property
    def error_counters(self) -> list[Metric]:
        ids = set(self.error_counter_ids)
        return [m for m in self.metrics if m.id in ids]

    @property
    def temperature(self) -> Metric | None:
        if self.temperature_id is None:
            return None
        return self.metric(self.temperature_id)

    @property
    def trend_columns(self) -> list[str]:
        return [m.trend(n) for m in self.metrics for n in self.trend_rows]

    @property
    def key(self) -> list[str]:
        return [self.entity, self.date]

    # -- schemas ------------------------------------------------------------------------------
    def identity_fields(self) -> list[tuple[str, DataType]]:
        fields: list[tuple[str, DataType]] = [
            (self.date, DateType()),
            (self.entity, StringType()),
            (self.group, StringType()),
        ]
        if self.capacity:
            fields.append((self.capacity, LongType()))
        fields.append((self.event, IntegerType()))
        return fields

    def schema(self) -> StructType:
        """Target schema of conformed telemetry: identity, raw readings, then normalized ones."""
        cols = self.identity_fields()
        cols += [(c, LongType()) for c in self.raw_columns]
        cols += [(c, LongType()) for c in self.normalized_columns]
        return StructType([StructField(n, t, True) for n, t in cols])

    def feature_columns(self) -> list[str]:
        """Model inputs: age, capacity, then per metric raw, z-score, reported and trends."""
        per_metric = [
            c
            for m in self.metrics
            for c in (m.raw, m.zscore, m.reported, *[m.trend(n) for n in self.trend_rows])
        ]
        head = ["age_days"] + ([self.capacity] if self.capacity else [])
        return head + per_metric


DEFAULT_SPEC = TelemetrySpec()
