"""Length buckets with the least padding, and token-budget batches inside them.

The histogram of all lengths goes to the driver, where dynamic programming chooses
the bucket boundaries; its number of bins does not depend on the data.  Documents
then get consecutive numbers inside their bucket, and every batch takes as many as fit
in the token budget at the bucket's padded length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafline.llm.common import without, word_count, written

BUCKETS = 16
BATCH_TOKENS = 65_536
# Lengths up to this have bins of their own; above, each doubling has so many bins.
EXACT = 1024
BINS_PER_DOUBLING = 64
# Parts a bucket is numbered in, so that no bucket needs one task.
LANES = 1024


def length_bin(length):
    """Bin of a length; grows with the length and takes fewer than 5,000 values."""
    above = F.floor((F.log2(F.greatest(length, F.lit(EXACT))) - np.log2(EXACT)) * BINS_PER_DOUBLING) + EXACT + 1
    return F.when(length <= EXACT, length).otherwise(above)


def histogram(lengths):
    """(number, sum, longest) of every bin that occurs, by length, as arrays."""
    rows = (
        lengths.groupBy(length_bin(F.col("length")).alias("bin"))
        .agg(F.count("*").alias("n"), F.sum("length").alias("sum"), F.max("length").alias("longest"))
        .collect()
    )
    rows.sort(key=lambda r: r["bin"])
    return tuple(np.array([r[k] for r in rows], dtype=np.float64) for k in ("n", "sum", "longest"))


def best_bounds(number, total, longest, buckets=BUCKETS):
    """Padded lengths of at most ``buckets`` buckets with the least padding in all.

    ``cost[j]`` is the least padding of bins up to ``j``; every further bucket tries all
    bins as its first.  Exact for boundaries between bins.
    """
    m = len(number)
    if m == 0:
        return []
    n, s = (np.concatenate([[0.0], np.cumsum(v)]) for v in (number, total))
    cost = longest * n[1:] - s[1:]
    choice = []
    for _ in range(min(buckets, m) - 1):
        before = np.concatenate([[0.0], cost])
        new, first = np.empty(m), np.empty(m, np.int64)
        for j in range(m):
            padding = before[: j + 1] + longest[j] * (n[j + 1] - n[: j + 1]) - (s[j + 1] - s[: j + 1])
            first[j] = padding.argmin()
            new[j] = padding[first[j]]
        cost = new
        choice.append(first)
    bounds, j = [], m - 1
    for first in [*choice[::-1], np.zeros(m, np.int64)]:
        if j < 0:
            break
        bounds.append(int(longest[j]))
        j = int(first[j]) - 1
    return bounds[::-1]


def pack(docs, length=None, doc_id="doc_id", buckets=BUCKETS, budget=BATCH_TOKENS):
    """``docs`` with ``length``, ``bucket``, ``bucket_length``, ``batch``, ``slot`` and ``padding``.

    ``length`` is a column expression, by default the words of ``text``.  A batch holds
    documents of one bucket, ``budget div bucket_length`` of them and at least one, so a
    document above the budget is a batch of its own, never cut; only the last batch of a
    bucket may be smaller.  Documents without words have length 0 and are padded like the
    rest.  Repeated rows get slots of their own; an empty table stays empty; columns with
    the new names are replaced, all others stay.  Inside a bucket documents follow a hash
    of their id.  Texts are read once to be measured and moved once, to meet their numbers.
    """
    kept = without(docs, "length", "bucket", "bucket_length", "batch", "slot", "padding")
    # Measured before columns are dropped; the caller may measure by one of them.
    size = (word_count() if length is None else F.coalesce(length, F.lit(0))).cast("long")
    rows = docs.select(
        F.struct(*[F.col(c) for c in kept.columns]).alias("row"),
        size.alias("length"),
        F.xxhash64(F.col(doc_id), size).alias("order"),
        F.monotonically_increasing_id().alias("mark"),
    )
    # Numbers of rows hold once they are stored; from here on only the join touches texts.
    rows = written(rows, "measured")
    bounds = best_bounds(*histogram(rows.select("length")), buckets)
    numbered = number_rows(rows.select("mark", "order", "length"), bounds, budget)
    return rows.join(numbered, "mark").select(
        "row.*", "length", "bucket", "bucket_length", "batch", "slot", (F.col("bucket_length") - F.col("length")).alias("padding")
    )


def number_rows(rows, bounds, budget=BATCH_TOKENS):
    """(mark, bucket, bucket_length, batch, slot) of rows (mark, order, length), without gaps in a bucket.

    Lanes of a bucket are numbered each for itself; the first number of each lane goes
    to every task, as a table of at most buckets times LANES rows.
    """
    bucket = sum([(F.col("length") > b).cast("int") for b in bounds[:-1]], F.lit(0))
    ends = F.array(*[F.lit(b).cast("long") for b in bounds or [0]])
    placed = rows.select("mark", "order", bucket.alias("bucket"), F.pmod("order", F.lit(LANES)).alias("lane"))
    lanes = placed.groupBy("bucket", "lane").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("bucket").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = lanes.select("bucket", "lane", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    within = Window.partitionBy("bucket", "lane").orderBy("order", "mark")
    numbered = placed.withColumn("at", F.row_number().over(within) - 1).join(F.broadcast(starts), ["bucket", "lane"])
    long = numbered.withColumn("bucket_length", F.element_at(ends, F.col("bucket") + 1))
    room = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_length", F.lit(1))), F.lit(1))
    index = F.col("at") + F.col("start")
    return long.select(
        "mark", "bucket", "bucket_length", F.floor(index / room).alias("batch"), (index % room).cast("int").alias("slot")
    )
