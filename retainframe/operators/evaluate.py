"""Neighbour votes, confusion counts, classification scores, ROC points and AUC."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio_or_zero
from ..functions.strings import pack_key
from ..session import materialize


def vote(neighbours: DataFrame, query: str = "query_id", label: str = "label", k: int = 10, threshold: float = 0.4) -> DataFrame:
    """Sum of neighbour labels per query; predicted 1 where sum / k reaches the threshold.

    The divisor stays ``k`` where a query has fewer neighbours.
    """
    total = F.sum(label).cast("int")
    return neighbours.groupBy(query).agg(total.alias("total_score")).withColumn(
        "pred_label", F.when(F.col("total_score") / F.lit(k) >= F.lit(threshold), 1).otherwise(0)
    )


def prediction_table(votes: DataFrame, truth: DataFrame, query: str = "query_id") -> DataFrame:
    """Votes with the true label (``truth``: query, true_label) and the packed ``key:label`` column."""
    joined = votes.join(truth.select(query, "true_label"), query, "inner")
    return joined.withColumn("key_label", pack_key(F.col(query), F.col("true_label")))


def confusion(predictions: DataFrame, truth: str = "true_label", predicted: str = "pred_label") -> DataFrame:
    y, p = F.col(truth), F.col(predicted)
    return predictions.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )


def classification_report(predictions: DataFrame, truth: str = "true_label", predicted: str = "pred_label") -> DataFrame:
    """Precision, recall, F1, accuracy and AUC of hard 0/1 predictions; 0/0 counts as 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    recall = ratio_or_zero(tp, tp + fn)
    specificity = ratio_or_zero(tn, tn + fp)
    return confusion(predictions, truth, predicted).select(
        "tp", "fp", "fn", "tn",
        ratio_or_zero(tp, tp + fp).alias("precision"),
        recall.alias("recall"),
        ratio_or_zero(tp * 2, tp * 2 + fp + fn).alias("f1"),
        ratio_or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ((recall + specificity) / 2).alias("auc"),
    )


def scored(predictions: DataFrame, score: str) -> DataFrame:
    """The rows that have a score; the others are in no point of a curve and in no denominator."""
    return predictions.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def score_totals(predictions: DataFrame, score: str, truth: str = "true_label", buckets: int | None = None) -> DataFrame:
    """Per distinct score: positives and negatives there, and how many lie at or above it.

    The predictions are read once, combined to distinct scores. Those are written in ranges of scores; the totals of the
    ranges (``buckets`` at most, by default the shuffle partitions) give each range its offset, and a window
    inside the range the rest, so that no task sees all scores. Rows without a score are left out.
    """
    per_score = materialize(scored(predictions, score).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg")
    ), "scores")
    ranged = per_score.repartitionByRange(buckets, "score") if buckets else per_score.repartitionByRange("score")
    placed = materialize(ranged.withColumn("bucket", F.spark_partition_id()), "ranges")
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("bucket").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(
            "bucket",
            F.coalesce(F.sum("p").over(above), F.lit(0)).alias("pos_before"),
            F.coalesce(F.sum("n").over(above), F.lit(0)).alias("neg_before"),
        )
    )
    inside = Window.partitionBy("bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(F.broadcast(offsets), "bucket").select(
        "score", "pos", "neg",
        (F.col("pos_before") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("neg_before") + F.sum("neg").over(inside)).alias("fp"),
    )


def roc_points(predictions: DataFrame, score: str, truth: str = "true_label") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score plus the (0, 0) start, whose threshold is null."""
    totals = score_totals(predictions, score, truth)
    overall = totals.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("all_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("all_neg"))
    positives = overall.select("all_pos").scalar()
    negatives = overall.select("all_neg").scalar()
    points = totals.select(
        F.col("score").alias("threshold"),
        ratio_or_zero(F.col("fp"), negatives).alias("fpr"),
        ratio_or_zero(F.col("tp"), positives).alias("tpr"),
    )
    start = overall.select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def auc(predictions: DataFrame, score: str, truth: str = "true_label") -> DataFrame:
    """Area under the ROC curve: share of (positive, negative) pairs ranked right, ties half."""
    totals = score_totals(predictions, score, truth)
    # a negative is beaten by the positives with a higher score, and half by those with its own
    won = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2)))
    return totals.agg(
        ratio_or_zero(won, F.sum("pos") * F.sum("neg")).alias("auc"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
    )
