"""Figures of a binary classifier from its scored rows, as aggregates that combine before they shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.columns import flag_count

BUCKETS = 4096


def _below(counts: DataFrame) -> DataFrame:
    """Adds `below`: the negatives with a smaller score.

    Scores are summed to BUCKETS ranges first, so the one window without a partition runs over a
    fixed number of rows, and the windows over single scores each hold one range.
    """
    ranges = counts.groupBy("bucket").agg(F.sum("negatives").alias("own"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("bucket", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.withColumn("inside", F.coalesce(F.sum("negatives").over(within), F.lit(0)))
    return inside.join(starts, "bucket").withColumn("below", F.col("start") + F.col("inside"))


def evaluate(rows: DataFrame, score: str, label: str = "label", predicted: str = "predicted_label") -> DataFrame:
    """One row: area_under_roc, f1, accuracy, and the four counts of the confusion matrix.

    The area is that of Mann and Whitney: the share of (positive, negative) pairs that the score, from 0 to
    1, puts in order, ties counting half; NULL without a pair. f1 is the mean of both classes
    weighted by their rows, a class that is never right counting 0. Rows with a null are left out.
    """
    whole = rows.select(
        F.col(score).cast("double").alias("score"),
        (F.col(label) == 1).alias("is"),
        (F.col(predicted) == 1).alias("said"),
    ).na.drop()
    counts = whole.groupBy("score").agg(flag_count(F.col("is")).alias("positives"), flag_count(~F.col("is")).alias("negatives"))
    ranked = _below(counts.withColumn("bucket", F.floor(F.col("score") * BUCKETS)))
    ordered = F.col("positives").cast("decimal(38,0)") * (2 * F.col("below") + F.col("negatives"))
    area = ranked.agg(F.sum(ordered.cast("decimal(38,0)")).alias("twice"))
    told = whole.agg(
        flag_count(F.col("is") & F.col("said")).alias("true_positives"),
        flag_count(~F.col("is") & F.col("said")).alias("false_positives"),
        flag_count(~F.col("is") & ~F.col("said")).alias("true_negatives"),
        flag_count(F.col("is") & ~F.col("said")).alias("false_negatives"),
    )
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("true_positives", "false_positives", "true_negatives", "false_negatives"))
    n = tp + fp + tn + fn

    def f1(right, wrong):
        return F.coalesce(F.try_divide(2 * right, 2 * right + wrong), F.lit(0.0))

    # both sides are one row
    return told.withColumn("twice", area.scalar()).select(
        F.try_divide(F.col("twice").cast("double"), 2 * (tp + fn) * (fp + tn)).alias("area_under_roc"),
        F.try_divide((tp + fn) * f1(tp, fp + fn) + (fp + tn) * f1(tn, fp + fn), n).alias("f1"),
        F.try_divide(tp + tn, n).alias("accuracy"),
        "true_positives",
        "false_positives",
        "true_negatives",
        "false_negatives",
    )
