"""fleetsight: reliability analytics for entity-day telemetry, written as Spark DataFrame operators."""

from fleetsight.spec import DEFAULT_SPEC, Metric, TelemetrySpec, smart_metric

__all__ = ["DEFAULT_SPEC", "Metric", "TelemetrySpec", "smart_metric"]
