"""The stream job: source, decoding, enrichment, Parquet sink."""

import logging

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..streaming.decode import decode_json, enrich
from ..streaming.sinks import INTERVAL, write_parquet_stream

LOG = logging.getLogger(__name__)


def start_stream(
    source: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "append",
    interval: str = INTERVAL,
    available_now: bool = False,
    on_malformed: str = "keep",
) -> StreamingQuery:
    """Start the query over a source frame with a ``value`` column."""
    events = enrich(decode_json(source, on_malformed=on_malformed))
    return write_parquet_stream(
        events, path, checkpoint, output_mode, interval, available_now
    )


def run_stream(
    source: DataFrame,
    path: str,
    checkpoint: str,
    timeout: float | None = None,
    **options,
) -> bool:
    """Run the query until it ends, or until ``timeout`` seconds; True if it ended."""
    try:
        query = start_stream(source, path, checkpoint, **options)
        if timeout is None:
            query.awaitTermination()
            return True
        return bool(query.awaitTermination(timeout))
    except Exception:
        LOG.exception("stream to %s failed", path)
        raise
