"""Tumbling per-tenant counts over a message stream."""

from pyspark.sql import functions as F

from sheafline.functions import payload
from sheafline.operators.reports import tenant_window_counts

# Window widths and watermark delay.
PROCESSING_WINDOW = "30 seconds"
EVENT_WINDOW = "1 minute"
OUT_OF_ORDER = "5 seconds"


def with_tenant(messages, value="value"):
    """Broker rows reduced to tenant and record time; the payload is not carried on."""
    parsed = messages.select(payload.decode(F.col(value)).alias("__json"), "timestamp")
    return parsed.select(payload.safe_tenant(F.col("__json")).alias("company_id"), "timestamp")


def processing_time_counts(messages, width=PROCESSING_WINDOW):
    """Count per tenant and wall-clock window, for update mode.

    The clock is read once per micro-batch.  With a trigger of the window's
    length Spark starts batches on multiples of it, so each window is fed by one
    batch and updated once; a batch that overruns updates its window again, and
    the consumer keeps the last count per (window, tenant).  The watermark only
    lets closed windows leave the state.
    """
    stamped = with_tenant(messages).select("company_id", F.current_timestamp().alias("proc_ts"))
    return tenant_window_counts(stamped.withWatermark("proc_ts", "0 seconds"), width, ts="proc_ts")


def event_time_counts(messages, width=EVENT_WINDOW, delay=OUT_OF_ORDER):
    """Count per tenant and event-time window, for append mode.

    A window is emitted once, when the watermark passes its end; later rows for
    it are dropped.  The last open window stays in the state until newer rows
    arrive.
    """
    return tenant_window_counts(with_tenant(messages).withWatermark("timestamp", delay), width)
