"""DataFrame -> DataFrame operators, each parameterised by a TelemetrySpec."""
