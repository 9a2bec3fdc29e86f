"""ST1-ST3, W2 on the stream: readings as a streaming table, each key once, with trends of their own.

The file stream of :mod:`fleetsight.streaming.job` scores a reading against a snapshot of its
entity's context, so its trends are those of the last batch run. Here arriving files are first
conformed into a Parquet folder (:func:`start_intake`); a second query streams that folder and keeps
the last rows of every entity as keyed state. Its trends include the arriving reading.

Order of arrival doesn't matter: a row that comes late, but within the watermark's delay, is put
in its place, and the later rows whose trends it changes are given again (``corrected``).
The newest batch's row of each key is the current one (:func:`current_rows`), and it equals the batch
trends over the same rows. A reading delivered again is ignored. Rows older than the watermark are
left out and counted (:func:`late_rows`).

State of an entity: the rows that the watermark hasn't passed, and as many before it as the longest
trend needs. It lives in Spark's state store and is restored from the checkpoint.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BooleanType, DateType, DoubleType, StructField, StructType

from fleetsight.functions.columns import keep_first
from fleetsight.operators.clean import add_group_zscores, drop_invalid_rows, normalize_group_names
from fleetsight.sinks.publish import keyed
from fleetsight.sources.csv import read_csv_batches
from fleetsight.spec import DEFAULT_SPEC, TelemetrySpec
from fleetsight.streaming.job import MAX_FILES_PER_TRIGGER, _overwrite_batch, arrivals
from fleetsight.streaming.scoring import add_model_probability, add_rule_scores, prepare_statistics, score_batch, score_columns

EVENT_TIME = "event_time"
DELAY = "60 days"
_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = dt.date(1970, 1, 1).toordinal()
_DAY_MS = 86_400_000


# ---- intake -----------------------------------------------------------------------------------
def start_intake(
    spark: SparkSession,
    incoming_dir: str,
    checkpoint_location: str,
    conformed_path: str,
    spec: TelemetrySpec = DEFAULT_SPEC,
    once: bool = True,
    interval: str = "30 seconds",
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    pattern: str | None = None,
):
    """ST1: arriving CSV files, each with its own header, conformed into Parquet by micro-batch.

    A micro-batch that runs again replaces its own rows.
    """

    def conform(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.select("path").distinct().collect())
        telemetry = read_csv_batches(spark, paths, spec.schema())
        if telemetry is not None:
            _overwrite_batch(telemetry.withColumn("batch_id", F.lit(batch_id).cast("bigint")), conformed_path)

    writer = arrivals(spark, incoming_dir, pattern, max_files_per_trigger).writeStream.foreachBatch(conform)
    writer = writer.option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def readings_stream(
    spark: SparkSession,
    conformed_path: str,
    spec: TelemetrySpec = DEFAULT_SPEC,
    schema: StructType | None = None,
    clean_first: bool = True,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """The conformed folder as a stream of readings, cleaned row by row."""
    reader = spark.readStream.schema(schema or spec.schema()).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(conformed_path)
    if clean_first:
        rows = rows.transform(normalize_group_names, spec).transform(drop_invalid_rows, spec)
    return rows


def with_event_time(stream: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC, delay: str = DELAY) -> DataFrame:
    """The reading's date as event time, with rows expected at most ``delay`` behind the newest."""
    return stream.withColumn(EVENT_TIME, F.to_timestamp(F.col(spec.date))).withWatermark(EVENT_TIME, delay)


def distinct_readings(stream: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC, delay: str = DELAY) -> DataFrame:
    """ST3: one row of each (entity, date), the first to arrive, however often and in whatever file it is delivered.

    The state forgets a key when the watermark passes its date by ``delay``; what is older than the
    watermark is dropped and counted (:func:`late_rows`).
    """
    return with_event_time(stream, spec, delay).dropDuplicatesWithinWatermark(spec.key)


def late_rows(query) -> int:
    """Rows that a query has dropped because the watermark had passed them, over the progress reports it still holds."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


# ---- trends of the arriving reading -------------------------------------------------------------
class TrendState(StatefulProcessor):
    """The last rows of one (group, entity), and the trends of every row that an arrival changes.

    ``columns`` are the columns kept of a row behind its date; ``metrics`` maps the place of a
    reading among them to its trend lengths in output order.
    """

    def __init__(self, date: str, columns: list[str], types: list[str], metrics: list[int], lengths: tuple[int, ...], output: list[str]):
        self.date, self.columns, self.types = date, columns, types
        self.metrics, self.lengths, self.output = metrics, lengths, output

    def init(self, handle) -> None:
        fields = ", ".join(f"c{i}: {t}" for i, t in enumerate(self.types))
        self.state = handle.getValueState("rows", f"first_seen int, rows array<struct<day: int, {fields}>>")

    def _held(self) -> tuple[int | None, dict[int, tuple]]:
        value = self.state.get()
        if value is None:
            return None, {}
        first_seen, rows = value
        return first_seen, {r[0]: tuple(r[1:]) for r in rows}

    def _taken(self, row: Row) -> tuple[int, tuple]:
        return row[self.date].toordinal() - _EPOCH, tuple(row[c] for c in self.columns)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        """The history of the entity: its first date, and its last rows. The state is written once an entity, not once a row."""
        held = dict(self._taken(row) for row in initialState["rows"])
        born = initialState["first_seen"].toordinal() - _EPOCH
        self.state.update((min(born, *held), [(d, *v) for d, v in sorted(held.items())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first_seen, held = self._held()
        arrived: dict[int, tuple] = {}
        for row in rows:
            day, values = self._taken(row)
            if day not in held:  # else delivered again
                known = arrived.get(day)
                # of copies in one micro-batch the greatest counts, whatever their order
                if known is None or [(v is not None, v) for v in values] > [(v is not None, v) for v in known]:
                    arrived[day] = values
        if not arrived:
            return
        held |= arrived
        born, first_seen = first_seen, min([min(arrived), *([first_seen] if first_seen is not None else [])])
        days = sorted(held)
        reach = max(self.lengths)
        place = {d: i for i, d in enumerate(days)}
        if born is None or first_seen == born:
            changed = sorted({j for d in arrived for j in range(place[d], min(place[d] + reach + 1, len(days)))})
        else:  # an earlier first date makes every row's age another
            changed = range(len(days))
        for j in changed:
            day = days[j]
            trends = []
            for m in self.metrics:
                for n in self.lengths:
                    seen = [v for d in days[max(0, j - n) : j + 1] if (v := held[d][m]) is not None]
                    trends.append(sum(seen, 0.0) / len(seen) if seen else None)
            yield Row(*self.output)(*key, dt.date.fromordinal(day + _EPOCH), *held[day], dt.date.fromordinal(first_seen + _EPOCH), *trends, day not in arrived)
        passed = timerValues.getCurrentWatermarkInMs() // _DAY_MS
        before = sum(d < passed for d in days)
        self.state.update((first_seen, [(d, *held[d]) for d in days[max(0, before - reach) :]]))

    def close(self) -> None:
        pass


def entity_history(cleaned: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """What the state starts from: the last rows of each entity with its first date, from a cleaned table."""
    entity = Window.partitionBy(spec.group, spec.entity)
    ranked = cleaned.withColumn("_n", F.row_number().over(entity.orderBy(F.desc(spec.date))))
    ranked = ranked.withColumn("first_seen", F.min(spec.date).over(entity))
    return ranked.filter(F.col("_n") <= max(spec.trend_rows)).drop("_n")


def _by_entity(history: DataFrame, columns: list[str], spec: TelemetrySpec) -> DataFrame:
    """One row for each entity of a history, with its rows in date order (as many as the longest trend needs)."""
    rows = F.sort_array(F.collect_list(F.struct(spec.date, *columns))).alias("rows")
    return history.groupBy(spec.group, spec.entity).agg(F.min("first_seen").alias("first_seen"), rows)


def _payload(spec: TelemetrySpec) -> list[str]:
    return [spec.event, *([spec.capacity] if spec.capacity else []), *spec.raw_columns]


def streamed_trends(
    stream: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC, history: DataFrame | None = None, delay: str = DELAY
) -> DataFrame:
    """W2 and W1 on the stream: every arriving reading with its trends and its entity's first date.

    Columns: group, entity, date, event, capacity, readings, ``first_seen``, trends, ``corrected``
    (true where a row that was given before is given again, because an earlier one came after it).
    ``history`` (:func:`entity_history`) is taken into the state in the first micro-batch. Trends are
    of rows (``trend_frame="rows"``).
    """
    if spec.trend_frame != "rows":
        raise ValueError("streamed trends are of rows; use the batch operator for trends of days")
    columns = _payload(spec)
    types = {f.name: f.dataType for f in stream.schema.fields}
    identity = [StructField(c, types[c]) for c in (spec.group, spec.entity, spec.date)]
    trends = [StructField(c, DoubleType()) for c in spec.trend_columns]
    out = [*identity, *[StructField(c, types[c]) for c in columns], StructField("first_seen", DateType()), *trends, StructField("corrected", BooleanType())]
    processor = TrendState(
        spec.date, columns, [types[c].simpleString() for c in columns], [columns.index(c) for c in spec.raw_columns], spec.trend_rows, [f.name for f in out]
    )
    timed = with_event_time(stream.select(spec.group, spec.entity, spec.date, *columns), spec, delay)
    start = None
    if history is not None:
        start = _by_entity(history, columns, spec).groupBy(spec.group, spec.entity)
    return timed.groupBy(spec.group, spec.entity).transformWithState(processor, StructType(out), "Append", "EventTime", initialState=start)


def score_with_trends(
    readings: DataFrame, statistics: DataFrame, model=None, spec: TelemetrySpec = DEFAULT_SPEC, statistics_rows: int | None = None
) -> DataFrame:
    """ST2: scores of readings that bring their trends and first date along, columns as the batch scorer's."""
    placed = add_group_zscores(readings, spec, statistics=statistics, statistics_rows=statistics_rows)
    aged = placed.transform(add_rule_scores, spec).withColumn("age_days", F.datediff(F.col(spec.date), F.col("first_seen")))
    return add_model_probability(aged, model, spec).select(*score_columns(spec), *spec.trend_columns, "corrected")


def current_rows(table: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """The newest batch's row of each (entity, date)."""
    return keep_first(table, spec.key, [F.desc("batch_id")])


# ---- queries ------------------------------------------------------------------------------------
def _start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint_location: str, once: bool, interval: str):
    """Start with the state store that keyed state needs; the session's own setting is put back."""
    spark = stream.sparkSession
    before = spark.conf.get(_STORE_CONF, None)
    spark.conf.set(_STORE_CONF, _STORE)
    try:
        writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location).outputMode("append")
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
    finally:
        if before is None:
            spark.conf.unset(_STORE_CONF)
        else:
            spark.conf.set(_STORE_CONF, before)


def start_trend_scoring(
    spark: SparkSession,
    conformed_path: str,
    checkpoint_location: str,
    sink_path: str,
    statistics: DataFrame,
    history: DataFrame | None = None,
    model=None,
    spec: TelemetrySpec = DEFAULT_SPEC,
    delay: str = DELAY,
    once: bool = True,
    interval: str = "30 seconds",
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
):
    """ST1-ST5: stream the conformed folder, score every reading on its own trends, one partition a micro-batch."""
    held, rows = prepare_statistics(statistics)

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = score_with_trends(batch, held, model, spec, rows).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        _overwrite_batch(keyed(scored, spec.key, sink_path), sink_path)

    stream = readings_stream(spark, conformed_path, spec, max_files_per_trigger=max_files_per_trigger)
    return _start(streamed_trends(stream, spec, history, delay), write, checkpoint_location, once, interval)


def start_distinct_scoring(
    spark: SparkSession,
    conformed_path: str,
    checkpoint_location: str,
    sink_path: str,
    statistics: DataFrame,
    context: DataFrame,
    model=None,
    spec: TelemetrySpec = DEFAULT_SPEC,
    delay: str = DELAY,
    once: bool = True,
    interval: str = "30 seconds",
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
):
    """ST1 / ST3: the scores of :mod:`fleetsight.streaming.job`, one row a key even if readings are delivered again."""
    held, rows = prepare_statistics(statistics)

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = score_batch(batch, held, context, model, spec, statistics_rows=rows).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        _overwrite_batch(keyed(scored, spec.key, sink_path), sink_path)

    stream = readings_stream(spark, conformed_path, spec, max_files_per_trigger=max_files_per_trigger)
    return _start(distinct_readings(stream, spec, delay), write, checkpoint_location, once, interval)
