"""The duplicate guard on a stream of uploads.

State per (company, file name): which documents hold the name, and how many of them are
in a state other than ``error``.  An upload is accepted while nobody holds its name, and
holds it from then on; the change of its document to ``error`` frees it again.

Names are dealt to buckets by hash, and a bucket is one group of the stateful operator: what
a group costs in Spark is paid per bucket, and the store is asked for pages of many names.
"""

import json
from zlib import crc32

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from sheafline.session import stateful_processors

FAILED = "error"
# Above every arrival time, for uploads without one; below every time, for changes without one.
LAST, FIRST = (1 << 63) - 1, -(1 << 63)
NAME = ("company_id", "filename")
VERDICT = "document_id string, company_id string, filename string, arrival long, accepted boolean"
# Groups of names, and so the most tasks that judge them.  A checkpoint holds for this number only.
BUCKETS = 4096
# Entries of a page on average, pages a task holds at a time, and verdicts it hands to Spark at a time.
PAGE, HELD, ROWS_PER_BATCH = 256, 2048, 10_000


class Entries:
    """Whole numbers under text keys in the state of one group: a hash table of pages.

    A page is read when one of its keys is asked for and written back once, so a micro-batch
    calls the store per page and not per key.  The table grows by a page at a time (linear
    hashing), so neither a read nor a write depends on how many keys there are.
    """

    def __init__(self, pages, size):
        self.pages, self.size = pages, size
        self.number, self.filled = size.get() or (1, 0)
        self.held, self.changed = {}, set()

    def _place(self, key):
        code, top = crc32(key.encode()), 1 << self.number.bit_length()
        place = code % top
        return place if place < self.number else place - top // 2

    def _page(self, place):
        if place not in self.held:
            if len(self.held) >= HELD:
                self.write()
            found = self.pages.getValue((place,))
            self.held[place] = json.loads(found[0]) if found else {}
        return self.held[place]

    def get(self, key):
        return self._page(self._place(key)).get(key)

    def set(self, key, value):
        place = self._place(key)
        page = self._page(place)
        self.filled += key not in page
        page[key] = value
        self.changed.add(place)
        if self.filled > PAGE * self.number:
            self._split()

    def _split(self):
        """One more page, with what hashes to it out of the page half as far."""
        new, old = self.number, self.number - (1 << self.number.bit_length() - 1)
        page = self._page(old)
        self.number += 1
        away = [k for k in page if self._place(k) == new]
        self.held[new] = {k: page.pop(k) for k in away}
        self.changed |= {old, new}

    def write(self):
        for place in self.changed:
            self.pages.updateValue((place,), (json.dumps(self.held[place], ensure_ascii=False),))
        if self.changed:
            self.size.update((self.number, self.filled))
        self.held.clear()
        self.changed.clear()


class Holders:
    """Holders of the names of one bucket: (state, time) per document, number of active ones per name."""

    def __init__(self, entries):
        self.entries, self.write = entries, entries.write

    @staticmethod
    def _name(company, filename):
        return f"n{len(company)}:{company}{filename}"

    @staticmethod
    def _document(company, filename, document):
        return f"d{len(company)}:{len(filename)}:{company}{filename}{document}"

    def knows(self, company, filename, document):
        return self.entries.get(self._document(company, filename, document)) is not None

    def free(self, company, filename):
        return not self.entries.get(self._name(company, filename))

    def hold(self, company, filename, document, active, at):
        """Note the state of a holder, unless a newer one is known."""
        key = self._document(company, filename, document)
        known = self.entries.get(key)
        if known is not None and known >> 1 > at:
            return
        # The time with the state as its last bit.
        now = at << 1 | active
        if now != known:
            self.entries.set(key, now)
        was = known is not None and known & 1 == 1
        if was != active:
            name = self._name(company, filename)
            self.entries.set(name, (self.entries.get(name) or 0) + (1 if active else -1))

    def accept(self, company, filename, document):
        """A free name goes to ``document``, whose earlier failure is still known by its time."""
        key = self._document(company, filename, document)
        known = self.entries.get(key)
        self.entries.set(key, (FIRST if known is None else known >> 1) << 1 | 1)
        self.entries.set(self._name(company, filename), 1)


def _rows(frame, *texts):
    """The columns ``texts`` as tuples, None for what is missing, beside the number ``at`` if there is one."""
    columns = [[v if isinstance(v, str) else None for v in frame[c].tolist()] for c in texts]
    return zip(*columns, frame["at"].tolist()) if "at" in frame else zip(*columns)


class NameGuard(StatefulProcessor):
    """Verdicts on the uploads of a bucket of names; see :func:`guard_uploads`."""

    def init(self, handle):
        self.pages = handle.getMapState("pages", "page long", "entries string")
        self.size = handle.getValueState("size", "pages long, entries long")

    def handleInitialState(self, key, initialState, timerValues):
        holders = Holders(Entries(self.pages, self.size))
        for document, company, filename, status in _rows(initialState, "document_id", *NAME, "status"):
            document, active = document or "", status != FAILED
            # Listed twice, a document holds its name if one of its rows does.
            if active or not holders.knows(company, filename, document):
                holders.hold(company, filename, document, active, FIRST)
        holders.write()

    def handleInputRows(self, key, rows, timerValues):
        holders = Holders(Entries(self.pages, self.size))
        first, refused = {}, []

        def verdicts(uploads, accepted):
            columns = dict(zip(("document_id", *NAME, "arrival"), zip(*uploads)))
            return pd.DataFrame(columns | {"accepted": accepted})

        for frame in rows:
            for document, company, filename, status, at in _rows(frame, "document_id", *NAME, "status"):
                if status is not None:
                    holders.hold(company, filename, document or "", status != FAILED, at)
                    continue
                # Only the first upload of a name can be accepted; the others are refused as they come.
                upload, name, rank = (document, company, filename, at), (company, filename), (at, document or "")
                best = first.get(name)
                if best is None:
                    first[name] = rank, upload
                elif rank < best[0]:
                    first[name] = rank, upload
                    refused.append(best[1])
                else:
                    refused.append(upload)
            if len(refused) >= ROWS_PER_BATCH:
                yield verdicts(refused, [False] * len(refused))
                refused = []
        accepted = [False] * len(refused)
        for (company, filename), ((_, document), _) in first.items():
            accepted.append(holders.free(company, filename))
            if accepted[-1]:
                holders.accept(company, filename, document)
        holders.write()
        if accepted:
            yield verdicts(refused + [upload for _, upload in first.values()], accepted)


def _bucketed(rows):
    """``rows`` by the bucket of their name."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*NAME), F.lit(BUCKETS)).cast("int")).groupBy("bucket")


def guard_uploads(uploads, changes=None, existing=None):
    """(document_id, company_id, filename, arrival, accepted) of a stream of uploads, for append mode.

    uploads(document_id, company_id, filename, arrival), with ``arrival`` a long;
    changes(document_id, company_id, filename, status, at) is the stream of state
    changes, ``at`` a long; existing(document_id, company_id, filename, status) is the
    table of documents the query starts with.  The verdicts are those of
    :func:`joins.flag_duplicates` run batch after batch in order of arrival, however
    the stream is cut: in a micro-batch the first upload of a name counts, by arrival,
    those without one last, then by document, and changes count before uploads.  Of two
    changes of a document the one with the higher ``at`` holds.  Uploads without tenant or
    name match nothing and pass without state.

    Names are judged in buckets: a task reads the rows of a bucket as a stream and keeps one
    upload of each of its names.  A name with most of the uploads is decided in one task.  State
    grows by the documents that were accepted or changed.
    """
    kinds = "document_id string, company_id string, filename string, at long, status string"
    names = [c.split()[0] for c in kinds.split(", ")]
    texts = [F.col(c).cast("string") for c in ("document_id", *NAME)]
    asked = uploads.select(
        *texts, F.coalesce(F.col("arrival").cast("long"), F.lit(LAST)).alias("at"),
        F.lit(None).cast("string").alias("status"),
    )
    named = F.col("company_id").isNotNull() & F.col("filename").isNotNull()
    rows = asked.where(named).select(*names)
    if changes is not None:
        told = changes.select(
            *texts, F.coalesce(F.col("at").cast("long"), F.lit(FIRST)).alias("at"), F.col("status").cast("string")
        ).where(named & F.col("status").isNotNull())
        rows = rows.unionByName(told.select(*names))
    start = None
    if existing is not None:
        known = existing.where(named).select(*texts, F.col("status").cast("string"))
        start = _bucketed(known)
    with stateful_processors(uploads.sparkSession):
        judged = _bucketed(rows).transformWithStateInPandas(NameGuard(), VERDICT, "Append", "None", start)
    free = asked.where(~named).select("document_id", *NAME, F.col("at").alias("arrival"), F.lit(True).alias("accepted"))
    return judged.unionByName(free).withColumn("arrival", F.when(F.col("arrival") != LAST, F.col("arrival")))
