"""The progression of documents through their states, step by step.

Whether a change is legal depends on the state the legal changes before it have led to,
so it takes an ordered fold per document.  The log is cut into parts by document and
time, so that a document with most of the changes lies in many parts.  A part sums up
its first and its last document as a function from the state before to the state
after; these functions, two per part, are composed in order and give every part the
state it begins in.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.operators.documents import KEY
from sheafline.schemas import DOCUMENT_STATES
from sheafline.session import stored

# Which state may follow which; None is a document not yet known.
LEGAL_STEPS = {
    None: ("pending",),
    "pending": ("uploaded", "error"),
    "uploaded": ("processing", "error"),
    "processing": ("processed", "error"),
    "processed": (),
    "error": ("processing",),
}
PROCESSED, ERROR = "processed", "error"
ILLEGAL, UNKNOWN, UNNAMED = "illegal_step", "unknown_state", "no_document"
# Changes a part holds, about; a part is one group of one task.
PART_ROWS = 50_000
# Below every change number that occurs.
NO_SEQ = -(1 << 63)
ORDER = ("ts", "seq", "status", "chunk_count", "error_message")


class Machine:
    """States as numbers, 0 for None, and the table of legal steps."""

    def __init__(self, steps):
        self.names = [None, *dict.fromkeys(s for s in (*steps, *(n for after in steps.values() for n in after)) if s is not None)]
        self.code = {name: i for i, name in enumerate(self.names)}
        self.legal = np.zeros((len(self.names),) * 2, bool)
        for before, after in steps.items():
            for name in after:
                self.legal[self.code[before], self.code[name]] = True

    def codes(self, status):
        """Number of each state; -1 for one that is not known."""
        return status.map(lambda s: self.code.get(s, -1) if isinstance(s, str) else -1).to_numpy()

    def run(self, codes, state):
        """State before each change and whether it is legal, starting from ``state``; and the last state."""
        before, legal = np.empty(len(codes), np.int64), np.zeros(len(codes), bool)
        table = self.legal.tolist()
        for i, code in enumerate(codes.tolist()):
            before[i] = state
            if code > 0 and table[state][code]:
                legal[i], state = True, code
        return before, legal, state

    def summary(self, codes):
        """State after the changes, for every state before them."""
        return [int(self.run(codes, state)[2]) for state in range(len(self.names))]


def _documents(part):
    """(first row, end) of each document of a sorted part."""
    keys = part[list(KEY)].to_numpy()
    new = np.r_[True, (keys[1:] != keys[:-1]).any(1)] if len(keys) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    return list(zip(starts, np.r_[starts[1:], len(keys)]))


def _sorted(part):
    return part.sort_values([*KEY, "ts", "has_seq", *ORDER[1:], "copy"], na_position="first", kind="stable").reset_index(drop=True)


def _starts(summaries):
    """{part: state its first document begins in}, from (part, first key, last key, their functions)."""
    found, key, state = {}, None, 0
    for row in sorted(summaries, key=lambda r: r["part"]):
        first, last = tuple(row["first"]), tuple(row["last"])
        found[row["part"]] = state if first == key else 0
        # A part of one document passes on the state it got; others begin their last document anew.
        state = row["first_map"][found[row["part"]]] if first == last else row["last_map"][0]
        key = last
    return found


def status_steps(changes, steps=LEGAL_STEPS):
    """Every change with ``before``, ``legal`` and ``reason``.

    changes(company_id, document_id, status, ts, seq, chunk_count, error_message).  Changes
    count in order of time, then change number, missing ones first, then status, count
    and message, whatever order the log has them in: a change that comes late is put where
    it belongs.  A legal one leads to its status; any other leaves the state as it is and
    has a reason.  A status that is not in ``steps``, a missing one, and a change without
    company or document are never legal.  Of equal changes the first may be legal.
    """
    machine = Machine(steps)
    wanted = [*KEY, *ORDER]
    named = F.col("company_id").isNotNull() & F.col("document_id").isNotNull()
    log = changes.select(*wanted)
    # A number per row keeps copies of one change from having to lie in one part.
    numbered = log.where(named).withColumn("copy", F.xxhash64(F.monotonically_increasing_id()))
    # Pandas would hold long numbers as floats where some are missing.
    whole = numbered.withColumns({"has_seq": F.col("seq").isNotNull(), "seq": F.coalesce("seq", F.lit(NO_SEQ)).cast("long")})
    parts = max(1, math.ceil(changes.count() / PART_ROWS))
    ranged = whole.repartitionByRange(parts, *KEY, *ORDER, "copy").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "status-steps")
    key_type = T.StructType([ranged.schema[k] for k in KEY])
    summary_type = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("first", key_type), T.StructField("last", key_type)]
        + [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("first_map", "last_map")]
    )

    def summarise(part: pd.DataFrame) -> pd.DataFrame:
        part = _sorted(part)
        codes, documents = machine.codes(part["status"]), _documents(part)
        out = {"part": [part["part"].iloc[0]]}
        for name, (start, end) in (("first", documents[0]), ("last", documents[-1])):
            out[name] = [{k: part[k].iloc[start] for k in KEY}]
            out[f"{name}_map"] = [machine.summary(codes[start:end])]
        return pd.DataFrame(out)[summary_type.names]

    starts = _starts(ranged.groupBy("part").applyInPandas(summarise, summary_type).collect())
    sent = changes.sparkSession.sparkContext.broadcast(starts)
    step_type = T.StructType(
        [ranged.schema[c] for c in (*wanted, "has_seq")]
        + [T.StructField("before", T.StringType()), T.StructField("legal", T.BooleanType())]
    )

    def judge(part: pd.DataFrame) -> pd.DataFrame:
        part = _sorted(part)
        codes, state = machine.codes(part["status"]), sent.value[int(part["part"].iloc[0])]
        before, legal = [], []
        for start, end in _documents(part):
            was, ok, _ = machine.run(codes[start:end], state)
            before.append(was)
            legal.append(ok)
            state = 0
        names = np.array(machine.names, dtype=object)
        return part.assign(before=names[np.concatenate(before)], legal=np.concatenate(legal))[step_type.names]

    judged = ranged.groupBy("part").applyInPandas(judge, step_type)
    judged = judged.withColumn("seq", F.when(F.col("has_seq"), F.col("seq"))).drop("has_seq")
    unnamed = log.where(~named).select("*", F.lit(None).cast("string").alias("before"), F.lit(False).alias("legal"))
    known = F.col("status").isin(*machine.names[1:])
    reason = (
        F.when(F.col("legal"), None)
        .when(F.col("company_id").isNull() | F.col("document_id").isNull(), UNNAMED)
        .when(F.coalesce(known, F.lit(False)), ILLEGAL)
        .otherwise(UNKNOWN)
    )
    return judged.unionByName(unnamed).withColumn("reason", reason)


def document_progress(steps):
    """State of each document after its legal changes, from the rows of :func:`status_steps`.

    ``chunk_count`` is that of the last time it was processed, ``error_message`` that of its
    failure while it is in state ``error``; ``n_illegal`` counts the changes that were
    refused.  A document without any legal change has no state.
    """
    order = F.struct(*ORDER)
    legal, processed = F.col("legal"), F.col("legal") & (F.col("status") == PROCESSED)
    last = F.max_by(F.struct("status", "ts", "error_message"), F.when(legal, order))
    done = steps.where(F.col("company_id").isNotNull() & F.col("document_id").isNotNull()).groupBy(*KEY).agg(
        last.alias("last"),
        F.max_by("chunk_count", F.when(processed, order)).alias("chunk_count"),
        F.count_if(~legal).alias("n_illegal"),
    )
    return done.select(
        *KEY, "last.status", "chunk_count", F.when(F.col("last.status") == ERROR, F.col("last.error_message")).alias("error_message"),
        F.col("last.ts").alias("updated_at"), "n_illegal",
    )


assert {s for s in LEGAL_STEPS if s} == set(DOCUMENT_STATES)
