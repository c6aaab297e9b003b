"""Search index refreshed from a stream of new, changed and removed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import search, segments
from ..operators.changes import latest_changes
from .changes import run_batches


def stream_search_refresh(
    corpus: DataFrame, key: str, column: str, path: str, buckets: int = 32, version: str | None = None, removed: str | None = None,
    attributes: list[str] | None = None, interval: str | None = "1 minute", fanout: int = segments.FANOUT,
) -> StreamingQuery:
    """Add each micro-batch as one index part; a retried batch replaces its part.

    A document that comes again replaces itself, one whose ``removed`` column holds leaves. Within a batch the highest
    ``version`` counts; without a version column a batch must not repeat a key. The index is queried with
    ``search.search_index``. Parts are merged as they gather, ``fanout`` at a time, but for the last one, which may
    have to be written again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = latest_changes(batch, key, version) if version else batch
        search.write_index(rows, key, column, path, buckets, part=batch_id, attributes=attributes, removed=removed)
        segments.merge(batch.sparkSession, path, key, below=batch_id, fanout=fanout)

    return run_batches(corpus, path, write, mode="append", interval=interval)
