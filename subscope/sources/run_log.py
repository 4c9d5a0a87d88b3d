"""Run records: one row per parameter or metric, appended to a Parquet table."""

import json
import logging
import time
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .local import local_frame

LOG = logging.getLogger(__name__)

RUN_SCHEMA = (
    "run_id string, logged_at timestamp, kind string, name string, "
    "value double, text string"
)


def _row(run_id: str, now: datetime, kind: str, name: str, value: Any) -> tuple:
    if isinstance(value, (bool, int, float)):
        return (run_id, now, kind, name, float(value), None)
    text = value if isinstance(value, str) else json.dumps(value)
    return (run_id, now, kind, name, None, text)


def run_records(
    spark: SparkSession,
    params: Mapping[str, Any],
    metrics: Mapping[str, float],
    run_id: str | None = None,
) -> DataFrame:
    """The records of one run; numbers go to ``value``, anything else to ``text``."""
    run_id = run_id or uuid.uuid4().hex
    now = datetime.now(timezone.utc)
    rows = [_row(run_id, now, "param", k, v) for k, v in params.items()]
    rows += [_row(run_id, now, "metric", k, v) for k, v in metrics.items()]
    return local_frame(spark, rows, RUN_SCHEMA).coalesce(1)


def append_run(
    spark: SparkSession,
    path: str,
    params: Mapping[str, Any],
    metrics: Mapping[str, float],
    run_id: str | None = None,
) -> None:
    run_records(spark, params, metrics, run_id).write.mode("append").parquet(path)


def timed_job(
    spark: SparkSession,
    name: str,
    body: Callable[[], Mapping[str, Any]],
    log_path: str | None = None,
    run_id: str | None = None,
) -> dict[str, Any]:
    """Run ``body``, log how long it took and record it; a failure is logged and raised.

    ``body`` returns the figures of the run. Numeric figures are recorded as metrics, under
    ``run_id`` if the body records something of its own.
    """
    LOG.info("%s: started", name)
    started = time.monotonic()
    try:
        result = dict(body())
    except Exception:
        elapsed = time.monotonic() - started
        LOG.exception("%s: failed after %.2f seconds", name, elapsed)
        if log_path:
            status = {"job": name, "status": "failed"}
            try:
                append_run(spark, log_path, status, {"seconds": elapsed}, run_id)
            except Exception:  # the failure of the job is the one to report
                LOG.exception("%s: the failure could not be recorded", name)
        raise
    result["seconds"] = time.monotonic() - started
    LOG.info("%s: finished in %.2f seconds", name, result["seconds"])
    if log_path:
        numbers = {
            k: v
            for k, v in result.items()
            if isinstance(v, (int, float)) and not isinstance(v, bool)
        }
        append_run(spark, log_path, {"job": name, "status": "done"}, numbers, run_id)
    return result
