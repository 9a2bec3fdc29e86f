"""ST1 / ST3-ST5, SC7-SC8: score CSV files as they arrive, exactly once per batch id.

The stream only tracks which files arrived (binaryFile source, content never read). Each
micro-batch reads its files with their own headers, cleans and scores them, and overwrites the
``batch_id`` partition of the sink, so a replayed batch replaces its earlier output instead of
duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetsight.operators.clean import drop_invalid_rows, normalize_group_names
from fleetsight.session import session_like
from fleetsight.sinks.publish import keyed
from fleetsight.sources.csv import read_csv_batches
from fleetsight.sources.tables import folder_exists
from fleetsight.streaming.scoring import prepare_statistics, score_batch
from fleetsight.spec import DEFAULT_SPEC, TelemetrySpec

MAX_FILES_PER_TRIGGER = 1_000  # bounds a micro-batch; what arrived beyond it comes in the next ones
REFRESH_EVERY = 1  # a continuous stream reloads its history after so many micro-batches


def load_model_if_present(path: str | None):
    """SC8: a saved PipelineModel, or None where there is no such folder (scoring then uses the rules alone).

    A folder that is there but can't be loaded raises.
    """
    if not path:
        return None
    from pyspark.ml import PipelineModel

    if not folder_exists(SparkSession.active(), path):
        return None
    return PipelineModel.load(path)


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(
    spark: SparkSession, incoming_dir: str, pattern: str | None = None, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """SC7: stream of newly arrived file paths; every file counts unless a name pattern is given."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(incoming_dir).select("path")


class _Sides:
    """The statistics and context that batches are scored against, and when to reload them."""

    def __init__(self, statistics: DataFrame, context: DataFrame, reload, every: int | None):
        self.reload, self.every, self.seen = reload, every, 0
        self._hold(statistics, context)

    def _hold(self, statistics: DataFrame, context: DataFrame) -> None:
        self.statistics, self.rows = prepare_statistics(statistics)
        self.context = context

    def next_batch(self) -> None:
        """After every so many batches take fresh sides and let go of the old ones."""
        seen, self.seen = self.seen, self.seen + 1
        if self.reload is None or not self.every or not seen or seen % self.every:
            return
        old = (self.statistics, self.context)
        self._hold(*self.reload())
        for df in old:
            if df not in (self.statistics, self.context):
                df.unpersist()


def make_batch_handler(
    spark: SparkSession,
    sink_path: str,
    statistics: DataFrame,
    context: DataFrame,
    model=None,
    spec: TelemetrySpec = DEFAULT_SPEC,
    clean_first: bool = True,
    as_of=None,
    reload_sides=None,
    refresh_every: int | None = REFRESH_EVERY,
    counts_path: str | None = None,
):
    """ST1-ST3: the foreachBatch body (also callable directly, e.g. to replay a batch).

    The historic statistics are materialised when they are loaded, not once per micro-batch. With
    ``reload_sides`` (returns fresh ``(statistics, context)`` from the staged tables) they are
    loaded again after every ``refresh_every`` micro-batches, so scores don't drift on a stale history.

    ``clean_first=False`` scores rows that cleaning would reject. ``counts_path`` names a table
    that gets the rows read and rejected of each batch, so that nothing is dropped unseen.
    """
    sides = _Sides(statistics, context, reload_sides, refresh_every)
    # A session whose frames have been observed can't be sent to tasks, and a classifier fitted in it holds
    # it: its scores could not be computed any more. So rows are counted in a session of the handler's own.
    own = session_like(spark)

    def handle(batch: DataFrame, batch_id: int) -> None:
        sides.next_batch()
        paths = sorted(r.path for r in batch.select("path").distinct().collect())
        telemetry = read_csv_batches(own, paths, spec.schema())
        if telemetry is None:
            return
        read, kept = Observation(), Observation()
        telemetry = telemetry.observe(read, F.count(F.lit(1)).alias("n"))
        if clean_first:
            telemetry = telemetry.transform(normalize_group_names, spec).transform(drop_invalid_rows, spec)
        telemetry = telemetry.observe(kept, F.count(F.lit(1)).alias("n"))
        scored = score_batch(telemetry, sides.statistics, sides.context, model, spec, statistics_rows=sides.rows)
        stamped = scored.withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn(
            "scored_at", as_of if as_of is not None else F.current_timestamp()
        )
        keys = spec.key if clean_first else []
        _overwrite_batch(keyed(stamped, keys, sink_path), sink_path)
        if counts_path:
            n, m = read.get["n"], kept.get["n"]
            counts = spark.createDataFrame([(batch_id, n, n - m)], "batch_id bigint, rows_read bigint, rows_rejected bigint")
            _overwrite_batch(counts.coalesce(1), counts_path)

    return handle


def _overwrite_batch(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def start_scoring_stream(
    spark: SparkSession,
    incoming_dir: str,
    checkpoint_location: str,
    sink_path: str,
    statistics: DataFrame,
    context: DataFrame,
    model=None,
    spec: TelemetrySpec = DEFAULT_SPEC,
    once: bool = True,
    interval: str = "30 seconds",
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    pattern: str | None = None,
    clean_first: bool = True,
    counts_path: str | None = None,
    reload_sides=None,
    refresh_every: int | None = REFRESH_EVERY,
):
    """ST4 / ST5: drain and stop (``once``) or poll every ``interval``; progress is checkpointed."""
    handler = make_batch_handler(
        spark,
        sink_path,
        statistics,
        context,
        model,
        spec,
        clean_first=clean_first,
        reload_sides=reload_sides,
        refresh_every=refresh_every,
        counts_path=counts_path,
    )
    writer = (
        arrivals(spark, incoming_dir, pattern, max_files_per_trigger)
        .writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()
