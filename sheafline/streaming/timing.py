"""Elapsed time of documents and batches, as metrics.

A document has been processed when the micro-batch that holds it is written; the time
its batch took until then is its processing time.  The time of whole batches is what
Spark reports of a running query; a listener keeps it until it is written away.
"""

import threading
from collections import deque

from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from sheafline.operators.metrics import Observed, observe

DOCUMENT_SECONDS = "docproc_processing_duration_seconds"
BATCH_SECONDS = "embedding_batch_processing_duration_seconds"
# Progress reports held until they are written; older ones go first.
MOST_REPORTS = 100_000


def with_elapsed(summary, elapsed_ms):
    """``summary`` with ``processing_time_ms``, rounded to two places."""
    return summary.withColumn("processing_time_ms", F.round(F.lit(float(elapsed_ms)), 2))


def document_seconds(summary, **labels):
    """Observations of the processing time of documents, in seconds."""
    value = F.col("processing_time_ms") / 1000
    return observe(summary.withColumn("ts", F.current_timestamp()), Observed(DOCUMENT_SECONDS, labels, value))


class BatchTimes(StreamingQueryListener):
    """Keeps what every finished batch reports; :meth:`observations` hands it over as rows.

    The listener runs on the driver and must not start jobs itself, so the owner of the
    query writes the rows, between batches or after the query has ended.  Reports that
    were not written when the driver dies are lost: they are measurements, no data.
    """

    def __init__(self):
        self._reports, self._lock = deque(maxlen=MOST_REPORTS), threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        told = event.progress
        with self._lock:
            self._reports.append((told.timestamp, told.name or str(told.id), told.batchId, told.numInputRows, told.batchDuration / 1000))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def reports(self):
        """All reports since the last call: (timestamp, query, batch, input rows, seconds)."""
        with self._lock:
            taken = list(self._reports)
            self._reports.clear()
        return taken

    def observations(self, spark):
        """Observations of batch seconds, with query, batch and rows beside them; each report once."""
        rows = spark.createDataFrame(self.reports(), "at string, query string, batch_id long, rows long, seconds double")
        timed = rows.withColumn("ts", F.to_timestamp("at"))
        return observe(timed, Observed(BATCH_SECONDS, {}, F.col("seconds")), keep=("query", "batch_id", "rows"))
