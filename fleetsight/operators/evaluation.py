"""Classifier evaluation as DataFrame aggregates.

Every threshold is counted in one pass: rows are counted by the number of thresholds they reach,
and running sums over those few counts give each threshold's. No cross join with a threshold table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetsight.functions.columns import safe_ratio
from fleetsight.operators.reports import value_slice
from fleetsight.spec import THRESHOLD_COUNT, THRESHOLD_STEP

LABEL = "failure_label"
PROBABILITY = "failure_probability"

# fixed values: candidate thresholds 0.05, 0.10, ..., 0.95
THRESHOLDS = [round(THRESHOLD_STEP * k, 2) for k in range(1, THRESHOLD_COUNT + 1)]


def confusion_counts(
    scored: DataFrame, thresholds: list[float] = THRESHOLDS, label: str = LABEL, probability: str = PROBABILITY
) -> DataFrame:
    """(threshold, tp, fp, fn) for all thresholds in a single scan.

    A row only matters by how many thresholds its probability reaches. So rows are counted by
    that number and by label, which leaves a row for each threshold, and running sums over the
    steps from the top give what each threshold flags. Rows without label or probability count nowhere.
    """
    steps = sorted(set(thresholds))
    reached = F.lit(0)
    for t in steps:
        reached = reached + (F.col(probability) >= t).cast("int")
    positive = F.col(label) == 1.0
    by_step = (
        scored.filter(F.col(label).isNotNull() & F.col(probability).isNotNull())
        .groupBy(reached.alias("step"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    grid = F.posexplode(F.array(F.lit(None).cast("double"), *[F.lit(float(t)) for t in steps])).alias("step", "threshold")
    full = scored.sparkSession.range(1).select(grid).join(F.broadcast(by_step), "step", "left").na.fill(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("step"))  # as many rows as thresholds
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = full.select(
        "threshold", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"), F.sum("pos").over(whole).alias("all")
    )
    return running.filter("threshold is not null").select("threshold", "tp", "fp", (F.col("all") - F.col("tp")).alias("fn"))


def with_prf(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from confusion counts; 0.0 when a denominator is 0."""
    precision = safe_ratio(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    recall = safe_ratio(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    out = counts.withColumn("precision", precision).withColumn("recall", recall)
    f1 = safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.withColumn("f1", f1)


def threshold_sweep(scored: DataFrame, thresholds: list[float] = THRESHOLDS, **kw) -> DataFrame:
    """A17 (table): precision, recall and F1 at every candidate threshold."""
    return with_prf(confusion_counts(scored, thresholds, **kw))


def best_threshold(scored: DataFrame, thresholds: list[float] = THRESHOLDS, **kw) -> DataFrame:
    """The threshold with the best F1; ties go to the lowest threshold."""
    return threshold_sweep(scored, thresholds, **kw).orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1)


def best_threshold_value(scored: DataFrame, thresholds: list[float] = THRESHOLDS, **kw) -> float:
    return float(best_threshold(scored, thresholds, **kw).select("threshold").first()[0])


def flagged(threshold: float | Column, probability: str = PROBABILITY) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.col(probability) >= t


def predicted_flags(scored: DataFrame, threshold: float, probability: str = PROBABILITY) -> DataFrame:
    """``predicted_failure`` = 1 when the probability reaches the threshold."""
    return scored.withColumn("predicted_failure", flagged(threshold, probability).cast("int"))


def drive_level_rates(
    scored: DataFrame, threshold: float | Column, entity: str = "serial_number", label: str = LABEL, probability: str = PROBABILITY
) -> DataFrame:
    """How many failed entities were flagged at least once, and how many healthy ones (one row)."""
    # an entity is flagged if its greatest probability is; so the threshold, which may be a subquery, stays out of the aggregates
    outcomes = scored.groupBy(entity).agg(F.max(label).alias("failed"), F.max(probability).alias("top"))
    outcomes = outcomes.select("failed", F.coalesce(flagged(threshold, "top"), F.lit(False)).alias("flagged"))

    def entities(*conditions: Column) -> Column:
        return F.count_if(reduce(Column.__and__, conditions)).cast("double")

    failed, healthy = F.col("failed") == 1.0, F.col("failed") == 0.0
    counts = {
        "failed_drives": entities(failed),
        "caught_drives": entities(failed, F.col("flagged")),
        "healthy_drives": entities(healthy),
        "false_alarm_drives": entities(healthy, F.col("flagged")),
    }
    shares = {"drive_recall": ("caught_drives", "failed_drives"), "drive_false_alarm_rate": ("false_alarm_drives", "healthy_drives")}
    totals = outcomes.agg(*[c.alias(name) for name, c in counts.items()])
    return totals.withColumns({name: safe_ratio(F.col(part), F.col(whole)) for name, (part, whole) in shares.items()})


def curve_areas(scored: DataFrame, label: str = LABEL, probability: str = PROBABILITY, slices: int = 16_384) -> DataFrame:
    """M7: (area_under_pr, area_under_roc) as one lazy row, exact, by trapezoids over the distinct scores.

    A distributed prefix sum: rows are counted by distinct score (ties are one point), scores fall
    into ordered slices by a fixed function of the score, the slices' totals (``2 * slices + 2`` rows
    at most) give each slice what lies above it, and running counts inside a slice give each point.
    A point's predecessor is the point less its own rows, so no neighbour is looked up.
    Without positives both areas are 0; without negatives the ROC area is 1. NULLs count nowhere.
    """
    known = scored.filter(F.col(label).isNotNull() & F.col(probability).isNotNull())
    positive = F.col(label) > 0.5
    points = known.groupBy(F.col(probability).cast("double").alias("p")).agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    points = points.withColumn("slice", value_slice(F.col("p"), slices))
    above = Window.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    none = F.lit(0).cast("long")
    totals = points.groupBy("slice").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    offsets = totals.select(
        "slice",
        *[F.coalesce(F.sum(c).over(above), none).alias(f"{c}_above") for c in ("pos", "neg")],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in ("pos", "neg")],
    )
    within = Window.partitionBy("slice").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = points.select("slice", "pos", "neg", *[F.sum(c).over(within).alias(f"{c}_run") for c in ("pos", "neg")])
    placed = running.join(F.broadcast(offsets), "slice")  # a row for each slice at most
    tp, fp = F.col("pos_run") + F.col("pos_above"), F.col("neg_run") + F.col("neg_above")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    precision = tp / (tp + fp)
    before = F.when(tp0 + fp0 > 0, F.try_divide(tp0, tp0 + fp0)).otherwise(precision)  # the curve opens at its first point's precision
    pr = F.sum(F.col("pos") * (precision + before) / 2) / F.max("pos_all")
    roc = F.try_divide(F.sum(F.col("neg") * (tp + tp0) / 2), F.max("pos_all") * F.max("neg_all"))
    some, both = F.max("pos_all") > 0, F.max("neg_all") > 0
    return placed.agg(
        F.when(some, pr).otherwise(0.0).alias("area_under_pr"),
        F.when(some & both, roc).when(some, 1.0).otherwise(0.0).alias("area_under_roc"),
    )


def area_under_curves(scored: DataFrame, label: str = LABEL, score: str = PROBABILITY) -> dict[str, float]:
    """Areas under PR and ROC as numbers (one job)."""
    return curve_areas(scored, label, score).first().asDict()


def evaluation_row(
    scored: DataFrame, threshold: float | None = None, entity: str = "serial_number", label: str = LABEL, probability: str = PROBABILITY
) -> DataFrame:
    """M7: AUPR, AUROC, threshold, precision, recall, F1, entity recall and false-alarm rate in one lazy row.

    Without a ``threshold`` the one with the best F1 is taken (A17), in the same query.
    """
    names = {"label": label, "probability": probability}
    at = best_threshold(scored, **names) if threshold is None else threshold_sweep(scored, [threshold], **names)
    prf = at.select(F.struct("threshold", "precision", "recall", "f1").alias("x"))
    limit = at.select("threshold").scalar() if threshold is None else F.lit(float(threshold))
    rates = drive_level_rates(scored, limit, entity, label, probability).select(F.struct("drive_recall", "drive_false_alarm_rate").alias("x"))
    areas = curve_areas(scored, label, probability).select(F.struct("area_under_pr", "area_under_roc").alias("x"))
    parts = scored.sparkSession.range(1).select(areas.scalar().alias("a"), prf.scalar().alias("t"), rates.scalar().alias("d"))
    return parts.select("a.*", "t.*", "d.*")


def metrics_long(row: DataFrame, model_name: str, split: str) -> DataFrame:
    """The figures of :func:`evaluation_row` as (model_name, split, metric, value) rows."""
    entries = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns])
    return row.select(F.lit(model_name).alias("model_name"), F.lit(split).alias("split"), F.explode(entries).alias("e")).select(
        "model_name", "split", "e.metric", "e.value"
    )


def evaluate(
    scored: DataFrame, threshold: float | None = None, entity: str = "serial_number", label: str = LABEL, probability: str = PROBABILITY
) -> dict[str, float]:
    """M7: the figures of :func:`evaluation_row` as numbers (one job)."""
    return {name: float(v) for name, v in evaluation_row(scored, threshold, entity, label, probability).first().asDict().items()}
