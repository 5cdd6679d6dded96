"""Removing messages a topic delivers again.

Consumers commit after they have worked, so a crash in between makes the broker send the
same messages once more.  Their ids are deterministic; a stream recognises them as long
as its watermark has not left them behind, and forgets them afterwards.
"""

from pyspark.sql import functions as F

from sheafline.functions import payload

# How long after a message its replay may come; bounds the ids held.
REPLAY_DELAY = "1 hour"
CHUNK_ID = ("chunk_id",)


def drop_replays(rows, ids=CHUNK_ID, ts="timestamp", delay=REPLAY_DELAY):
    """Rows whose ``ids`` have not come before within ``delay`` of event time, for append mode.

    The first copy to arrive stays.  Rows with a missing id cannot be recognised by it and
    are compared whole, apart from their time.  A row later than the watermark is dropped
    whether it is a copy or not, so ``delay`` is also the lateness that is tolerated.
    The state holds the ids of the last ``delay``, not the rows.
    """
    named = F.lit(True)
    for column in ids:
        named = named & F.col(column).isNotNull()
    others = [F.col(c) for c in rows.columns if c != ts]
    marked = rows.withColumn("__unnamed", F.when(~named, F.sha2(F.to_json(F.struct(*others)), 256)))
    unique = marked.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*ids, "__unnamed"])
    return unique.drop("__unnamed")


def drop_replayed_messages(messages, id_field="chunk_id", value="value", ts="timestamp", delay=REPLAY_DELAY):
    """Broker rows without the copies of a message, recognised by an id inside the payload.

    A message without that id, or that is not one JSON object, is recognised by its bytes.
    """
    decoded = messages.withColumn("__json", payload.decode(F.col(value)))
    found = F.when(payload.is_object(F.col("__json")), payload.text_field(F.col("__json"), id_field))
    named = decoded.withColumn("__id", F.coalesce(F.concat(F.lit("id:"), found), F.concat(F.lit("sha:"), F.sha2(F.col(value), 256)), F.lit("none")))
    return drop_replays(named.drop("__json"), ("__id",), ts, delay).drop("__id")
