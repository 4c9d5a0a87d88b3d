import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from subscope.operators.metrics import auc_roc, classification_metrics, confusion_matrix


@pytest.fixture(scope="module")
def scored(spark):
    r = random.Random(7)
    rows = []
    for _ in range(600):
        label = r.choice([0.0, 0.0, 0.0, 1.0])
        score = round(r.random() * 0.6 + 0.3 * label, 1)
        rows.append((label, score, float(score > 0.5)))
    return spark.createDataFrame(rows, "churn double, score double, prediction double")


def test_metrics_equal_mllib(scored):
    got = classification_metrics(scored).first()
    names = {
        "f1": "f1",
        "accuracy": "accuracy",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
    }
    for mine, theirs in names.items():
        want = MulticlassClassificationEvaluator(
            labelCol="churn", metricName=theirs
        ).evaluate(scored)
        assert got[mine] == pytest.approx(want, rel=1e-12)


def test_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.0)], "churn int, prediction double")
    got = classification_metrics(df).first()
    assert got["accuracy"] == 0.5
    assert got["weighted_precision"] == 0.25
    assert got["f1"] == pytest.approx(1 / 3)
    assert classification_metrics(df.limit(0)).first()["f1"] is None


def test_confusion_matrix(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (0, 1.0)], "churn int, prediction double")
    got = {(r["actual"], r["predicted"]): r["rows"] for r in confusion_matrix(df).collect()}
    assert got == {(0.0, 0.0): 1, (0.0, 1.0): 2}


def test_auc_by_pairs(scored):
    rows = scored.collect()
    good = [r["score"] for r in rows if r["churn"] == 1]
    bad = [r["score"] for r in rows if r["churn"] == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert auc_roc(scored, score="score") == pytest.approx(wins / len(good) / len(bad))
