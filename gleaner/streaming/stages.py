"""The row-wise stages on a stream. Deduplication, normalisation and top-k need the whole dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gleaner.config import QualityFilters
from gleaner.operators.quality import quality_filter
from gleaner.sources.normalize import to_messages


def filter_stream(
    stream: DataFrame, filters: QualityFilters, id_col: str | None = None, **options
) -> DataFrame:
    """Normalise each arriving record and keep those that pass the quality checks."""
    if not stream.isStreaming:
        raise ValueError("filter_stream takes a streaming frame")
    return quality_filter(to_messages(stream, id_col), filters, **options)


def run_available(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Write what has arrived and not been written before, then stop.

    The checkpoint remembers the files that were read, so a later run, or one after a failure, adds only
    the rows of files that came since; the sink's log makes a repeated batch count once.
    """
    writer = stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
