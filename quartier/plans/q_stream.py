"""Structured Streaming twins of the batch queries."""

from ..streaming import jobs
from . import sql as S
from .catalog import register
from .q_dash import _PER_BATCH_SQL, _RAW_SQL, _freq_top_sql


@register("stream_rollup", S.rollup("date_trunc('minute', time)"))
def q_stream_rollup(spark, sf):
    """Batch layer as a streaming query (availableNow) == the batch roll-up."""
    return jobs.run_rollup(spark, sf)


@register("stream_frequent", _freq_top_sql(1))
def q_stream_frequent(spark, sf):
    """Speed layer: streamed pane counts, then top-1 per sliding window."""
    return jobs.run_frequent(spark, sf, k=1)


@register("stream_landing", f"{S.R} select time, mun, room_id, data_id, data, voltage from r")
def q_stream_landing(spark, sf):
    """Landing job (records -> dated text files) read back by the line parser."""
    from ..functions.timefns import to_ntz
    r = jobs.run_landing(spark, sf)
    return r.select(to_ntz("time").alias("time"), "mun", "room_id", "data_id", "data", "voltage")


@register("stream_batch_layer", f"""
with rp as ({S.rollup("date_trunc('minute', time)")}),
rw as ({S.R} {_RAW_SQL})
select metric, timestamp, value, city, municipality, space, aggregate from rw
union all
select metric, timestamp, value, city, municipality, space, aggregate from rp""")
def q_stream_batch_layer(spark, sf):
    """Raw + roll-up points written by two streaming queries on one source."""
    return jobs.run_batch_layer(spark, sf)


@register("stream_frequent_per_batch", _PER_BATCH_SQL)
def q_stream_frequent_per_batch(spark, sf):
    """Speed layer as coded (10 s batches, 60 s / 10 s windows) on a stream."""
    return jobs.run_per_batch(spark, sf)
