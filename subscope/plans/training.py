"""Model training on the processed table, and batch scoring with a saved model."""

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import plain
from ..operators.modeling import (
    Trained,
    evaluate,
    feature_importance,
    invalid_rows,
    load_model,
    save_model,
    split_by_hash,
    train,
    with_class_weight,
)
from ..operators.oversampling import balanced
from ..schemas import FEATURES, ID, LABEL
from ..session import scratch_path
from ..sources.run_log import append_run
from ..sources.tables import read_parquet, write_parquet
from ..streaming.scoring import customer_scores, unique_scores


def run_training(
    spark: SparkSession,
    data_path: str,
    model_path: str,
    log_path: str | None = None,
    importance_path: str | None = None,
    params: Mapping[str, Any] | None = None,
    grid: Mapping[str, Iterable[Any]] | None = None,
    folds: int = 3,
    parallelism: int = 2,
    fit_on: str = "train",
    weighted: bool = False,
    run_id: str | None = None,
    search: str = "grid",
    validation: float | None = None,
    oversample: bool = False,
) -> dict[str, Any]:
    """Split, tune, evaluate, save and record.

    ``search`` and ``validation`` are those of :func:`subscope.operators.modeling.train`.

    ``fit_on="all"`` fits the scaler on all rows instead of the training part;
    ``oversample=True`` adds new rows of the rarer class to the training part;
    ``weighted=True`` weights the classes inversely to their size.
    """
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on is 'train' or 'all'")
    df = read_parquet(spark, data_path).select(ID, LABEL, *map(plain, FEATURES))
    train_df, test_df = split_by_hash(df)
    skipped = invalid_rows(df)
    if oversample:
        # The joins that make the new rows run once, however often a fit reads them.
        path = scratch_path(spark, "balanced")
        write_parquet(balanced(train_df).select(ID, LABEL, *map(plain, FEATURES)), path)
        train_df = read_parquet(spark, path)
    weight = None
    if weighted:
        weight = "class_weight"
        train_df = with_class_weight(train_df, LABEL, weight)
    trained: Trained = train(
        train_df,
        params=params,
        grid=grid,
        folds=folds,
        parallelism=parallelism,
        fit_on=df if fit_on == "all" else None,
        weight=weight,
        search=search,
        validation=validation,
    )
    metrics = evaluate(trained.model, test_df)
    save_model(trained.model, model_path)
    if importance_path:
        write_parquet(
            feature_importance(spark, trained.model).coalesce(1), importance_path
        )
    if log_path:
        append_run(spark, log_path, trained.parameters(), metrics, run_id)
    return {**metrics, "skipped_rows": skipped}


def run_scoring(
    spark: SparkSession, data_path: str, model_path: str, output_path: str
) -> dict[str, Any]:
    """Score every customer of the processed table with a saved model.

    The table has one row per customer, as the scored stream needs it; those that lack a
    feature are in it without a prediction and are counted.
    """
    df = read_parquet(spark, data_path).select(ID, *map(plain, FEATURES))
    scores = unique_scores(customer_scores(load_model(model_path), df))
    seen = Observation()
    counted = scores.observe(
        seen,
        F.count(F.lit(1)).alias("customers"),
        F.count_if(~F.col("complete")).alias("customers_without_score"),
    )
    write_parquet(counted, output_path)
    return dict(seen.get)
