"""Hand-made telemetry rows for the semantic tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Row

from fleetsight.spec import DEFAULT_SPEC

START = dt.date(2026, 1, 1)
REALLOCATED = "smart_5_raw"
PENDING = "smart_197_raw"


def day(n: int) -> dt.date:
    return START + dt.timedelta(days=n)


def telemetry_row(serial, date, model="MODEL_A", failure=0, capacity=4_000_000_000_000, **readings) -> Row:
    row = {"date": date, "serial_number": serial, "model": model, "capacity_bytes": capacity, "failure": failure}
    for c in DEFAULT_SPEC.raw_columns:
        row[c] = readings.get(c, 0)
    return Row(**row)


def telemetry_df(spark, rows):
    schema = ", ".join(
        ["date date", "serial_number string", "model string", "capacity_bytes bigint", "failure int"]
        + [f"{c} bigint" for c in DEFAULT_SPEC.raw_columns]
    )
    return spark.createDataFrame(rows, schema)
