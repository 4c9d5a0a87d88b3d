"""Quality of predictions."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import plain, safe_ratio
from ..schemas import LABEL

METRICS = ("f1", "accuracy", "weighted_precision", "weighted_recall")


def confusion_matrix(
    predictions: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """Rows per actual and predicted class."""
    return predictions.groupBy(
        plain(label).cast("double").alias("actual"),
        plain(prediction).cast("double").alias("predicted"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def classification_metrics(
    predictions: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """One row of label-weighted F1, accuracy, weighted precision and weighted recall.

    The predictions are read once; everything after the confusion matrix works on a few
    rows per class.
    """
    rows = F.col("rows")
    hit = F.when(F.col("actual") == F.col("predicted"), rows).otherwise(0)
    none = F.lit(0).cast("long")

    def side(of_class, actual, predicted, correct):
        return F.struct(
            of_class.alias("of_class"),
            actual.alias("actual"),
            predicted.alias("predicted"),
            correct.alias("correct"),
        )

    sides = F.array(
        side(F.col("actual"), rows, none, hit.cast("long")),
        side(F.col("predicted"), none, rows, none),
    )
    per_class = (
        confusion_matrix(predictions, label, prediction)
        .select(F.inline(sides))
        .groupBy("of_class")
        .agg(
            F.sum("actual").alias("actual"),
            F.sum("predicted").alias("predicted"),
            F.sum("correct").alias("correct"),
        )
    )
    correct, actual, predicted = F.col("correct"), F.col("actual"), F.col("predicted")
    total = F.sum(actual)

    def weighted(value):
        return safe_ratio(F.sum(actual * F.coalesce(value, F.lit(0.0))), total)

    return per_class.agg(
        weighted(safe_ratio(2 * correct, actual + predicted)).alias("f1"),
        safe_ratio(F.sum(correct), total).alias("accuracy"),
        weighted(safe_ratio(correct, predicted)).alias("weighted_precision"),
        weighted(safe_ratio(correct, actual)).alias("weighted_recall"),
    )


def auc_roc(
    predictions: DataFrame, label: str = LABEL, score: str = "rawPrediction"
) -> float:
    """Area under the ROC curve over all distinct scores, without down-sampling."""
    return BinaryClassificationEvaluator(
        labelCol=label,
        rawPredictionCol=score,
        metricName="areaUnderROC",
        numBins=0,
    ).evaluate(predictions)
