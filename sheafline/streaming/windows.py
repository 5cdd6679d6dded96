"""Windows with a function of their own, and wall-clock windows that close while nothing arrives.

Both keep their state in the state store and end a window by a timer.  A timer
belongs to the checkpoint like the state does, so a restarted query closes the windows
its predecessor left open, each once.
"""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from sheafline.session import stateful_processors
from sheafline.streaming.counters import EVENT_WINDOW, OUT_OF_ORDER, PROCESSING_WINDOW, with_tenant

# Rows a task hands to Spark at a time.
ROWS_PER_BATCH = 10_000
BOUNDS = ("window_start", "window_end")
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def width_ms(width):
    """Milliseconds of a width such as ``30 seconds``."""
    number, unit = width.split()
    unit = unit.removesuffix("s")
    if unit not in UNITS or not number.isdigit() or int(number) == 0:
        raise ValueError(f"not a width of whole seconds, minutes, hours or days: {width!r}")
    return int(number) * UNITS[unit] * 1000


def _frames(rows, names):
    """Rows (tuples) as data frames of bounded size."""
    batch = []
    for row in rows:
        batch.append(row)
        if len(batch) == ROWS_PER_BATCH:
            yield pd.DataFrame(batch, columns=names)
            batch = []
    if batch:
        yield pd.DataFrame(batch, columns=names)


class WindowElements(StatefulProcessor):
    """Holds a window's elements as list state and gives them to ``function`` when it closes."""

    def __init__(self, function, element, names, extra=0):
        self.function, self.element, self.names, self.extra = function, element, names, extra

    def init(self, handle):
        self.handle = handle
        self.elements = handle.getListState("elements", self.element)

    def handleInputRows(self, key, rows, timerValues):
        for frame in rows:
            values = frame[self.element.names].astype(object)
            values = values.where(values.notna(), None)
            self.elements.appendList(list(values.itertuples(index=False, name=None)))
        self.handle.registerTimer(key[1] // 1000)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        bounds = tuple(pd.Timestamp(us, unit="us", tz="UTC") for us in key[:2])
        keys = tuple(None if pd.isna(k) else k for k in key[2 : len(key) - self.extra])
        made = self.function(keys, bounds, self.elements.get())
        yield from _frames(((*bounds, *keys, *row) for row in made), self.names)
        self.elements.clear()


def process_windows(
    rows,
    function,
    output,
    columns,
    width=EVENT_WINDOW,
    ts="timestamp",
    keys=("company_id",),
    delay=OUT_OF_ORDER,
    lanes=1,
    merge=None,
):
    """Rows ``function`` yields for each closed window and key, for append mode.

    ``function(keys, (start, end), elements)`` gets an iterator over the window's elements
    (tuples of ``columns``, in order of arrival) and yields tuples of the fields of
    ``output``; bounds and keys go before them.  The elements are streamed from the state
    store, so a window may hold more of them than fit in memory.  A window is closed once,
    when the watermark passes its end, and later rows for it are dropped, as in
    :func:`counters.event_time_counts`: where a count or another built-in aggregate will
    do, that is cheaper, since it holds no elements.

    A window of a key with most of the rows is one task.  With ``lanes`` above 1 its
    elements are dealt to so many parts at random, ``function`` runs on each part, and
    ``merge``, which has the same form, on the few rows the parts have yielded.
    """
    width_ms(width)
    if lanes > 1 and merge is None:
        raise ValueError("windows in several lanes need a function that merges them")
    marked = rows.withWatermark(ts, delay)
    # The window carries the watermark: a row is late when its window has closed.
    windowed = marked.select(
        F.window(ts, width).alias("window"),
        *[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)],
        *[F.col(c).alias(f"value{i}") for i, c in enumerate(columns)],
    )
    held = windowed.select("*", F.unix_micros("window.start").alias("start"), F.unix_micros("window.end").alias("end"))
    element = T.StructType([f for f in windowed.schema if f.name.startswith("value")])
    names = [f"key{i}" for i in range(len(keys))]
    result = T.StructType(
        [T.StructField(b, T.TimestampType()) for b in BOUNDS]
        + [T.StructField(k, windowed.schema[f"key{i}"].dataType) for i, k in enumerate(keys)]
        + list(output.fields)
    )
    if lanes == 1:
        whole = held.groupBy("start", "end", *names)
        with stateful_processors(rows.sparkSession):
            return whole.transformWithStateInPandas(WindowElements(function, element, result.names), result, "Append", "EventTime")
    dealt = held.withColumn("lane", F.floor(F.rand() * lanes).cast("int")).groupBy("start", "end", *names, "lane")
    with stateful_processors(rows.sparkSession):
        parts = dealt.transformWithStateInPandas(
            WindowElements(function, element, result.names, extra=1), result, "Append", "EventTime", None, BOUNDS[1]
        )
    partial = parts.select(
        BOUNDS[1],
        *[F.unix_micros(b).alias(n) for b, n in zip(BOUNDS, ("start", "end"))],
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        *[F.col(f.name).alias(f"value{i}") for i, f in enumerate(output.fields)],
    )
    field = T.StructType([T.StructField(f"value{i}", f.dataType) for i, f in enumerate(output.fields)])
    with stateful_processors(rows.sparkSession):
        return partial.groupBy("start", "end", *names).transformWithStateInPandas(
            WindowElements(merge, field, result.names), result, "Append", "EventTime"
        )


class IdleCounts(StatefulProcessor):
    """Counts of a tenant's open wall-clock windows, each emitted by its own timer."""

    def __init__(self, width):
        self.width = width

    def init(self, handle):
        self.handle = handle
        self.counts = handle.getMapState("counts", "start long", "n long")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.width
        n = sum(int(frame["n"].sum()) for frame in rows)
        if self.counts.containsKey((start,)):
            n += self.counts.getValue((start,))[0]
        else:
            self.handle.registerTimer(start + self.width)
        self.counts.updateValue((start,), (n,))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        end = expiredTimerInfo.getExpiryTimeInMs()
        start = end - self.width
        (n,) = self.counts.getValue((start,))
        self.counts.removeKey((start,))
        tenant = None if pd.isna(key[0]) else key[0]
        bounds = [pd.Timestamp(ms, unit="ms", tz="UTC") for ms in (start, end)]
        yield pd.DataFrame([(*bounds, tenant, n)], columns=[*BOUNDS, "company_id", "chunk_count"])


def idle_processing_counts(messages, width=PROCESSING_WINDOW):
    """Count per tenant and wall-clock window, each window once, for append mode.

    A window is emitted when the clock passes its end, whether or not another message ever
    arrives.  The clock is that of the micro-batch, which the checkpoint keeps, so a batch
    that is repeated counts into the same window.  Messages are added up per task before
    they are shuffled: a tenant with most of them sends one row per batch of a task.
    """

    def added(frames):
        for frame in frames:
            counts = frame.groupby("company_id", dropna=False, sort=False).size()
            yield pd.DataFrame({"company_id": [None if pd.isna(k) else k for k in counts.index], "n": counts.to_numpy()})

    per_task = with_tenant(messages).select("company_id").mapInPandas(added, "company_id string, n long")
    output = "window_start timestamp, window_end timestamp, company_id string, chunk_count long"
    with stateful_processors(messages.sparkSession):
        return per_task.groupBy("company_id").transformWithStateInPandas(
            IdleCounts(width_ms(width)), output, "Append", "ProcessingTime"
        )
