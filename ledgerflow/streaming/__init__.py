"""Structured Streaming runners built on the batch operators.

Stateless per-batch jobs run in ``foreachBatch`` and write each micro-batch to its own
``batch_id=N`` folder with overwrite, so a batch replayed after a failure rewrites the same output.
Stateful ones use Spark's streaming aggregation, stream-stream joins and ``applyInPandasWithState``
with watermarks; their state lives in the query checkpoint below ``spark.checkpoint.dir``.
"""

from .runners import (count_trigger_stream, cumulative_sink, dc_statistics,
                      event_time, fc_statistics, interval_join_stream, late_split_batches,
                      latest, offset_ledger_sink, order_pattern_stream, running_average_stream,
                      running_total_stream, sliding_count_stream, start, upsert_sink,
                      uv_bitmap_stream, uv_distinct_stream, uv_first_sight_stream,
                      window_aggregate_stream, window_contents_stream, window_inout_stream,
                      window_join_stream)
from .timers import (early_firing_stream, first_views_stream, purge_segments_stream, read_uv_running,
                     sliding_ring_stream, uv_running_sink)

__all__ = ["count_trigger_stream", "cumulative_sink", "dc_statistics",
           "event_time", "fc_statistics", "interval_join_stream", "late_split_batches",
           "latest", "offset_ledger_sink", "order_pattern_stream", "running_average_stream",
           "running_total_stream", "sliding_count_stream", "start", "upsert_sink",
           "uv_bitmap_stream", "uv_distinct_stream", "uv_first_sight_stream",
           "window_aggregate_stream", "window_contents_stream", "window_inout_stream",
           "window_join_stream",
           "early_firing_stream", "first_views_stream", "purge_segments_stream", "read_uv_running",
           "sliding_ring_stream", "uv_running_sink"]
