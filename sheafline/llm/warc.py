"""WARC archives: writing with deduplication, and reading by verified record chains.

Archives are read in blocks, like any splittable file, so a task sees the magic of a
record without knowing whether a record begins there or a payload merely contains it.
Every task emits its candidates: the offset of each magic and the offset at which the
record that its header describes would end.  Inside a block pointers are followed to
the offset where the chain leaves it; between blocks pointer jumping doubles the
distance each round.  Only records on the chain from the start of the file are kept.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafline.llm.common import written
from sheafline.llm.components import unique_side

MAGIC = "WARC/1."
VERSION = "1.1"
NEWLINE = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads from this size on are stored once.
SMALLEST_REVISIT = 0
_URN = "<urn:page:"

HEADER = "kind string, record_id string, target string, refers_to string, digest string"
LINE = f"path string, block long, seq long, size long, head long, content long, {HEADER}, body_bytes long, body_digest string"


def base32_sha1(data):
    """Column: upper-case base32 SHA-1 of a binary or string column, as digests are written.

    Five hexadecimal digits are four base32 digits; ``conv`` counts 0-9A-V.
    """
    hex_ = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(hex_, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def as_records(pages, page_id="page_id", url="url", payload="html", date="1970-01-01T00:00:00Z", smallest=SMALLEST_REVISIT):
    """One WARC record per row as ``record``, without its last line break.

    Among payloads that are equal and have at least ``smallest`` bytes, the smallest
    page id is a response and the others are revisits of it without content; smaller
    payloads are always responses.  Rows that share that smallest id are responses
    alike; rows without id revisit it, and are responses where no row has an id.  A null
    payload is empty.  Line breaks in a URL become spaces.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\r\n]+", " ").alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    ).withColumns({"bytes": F.octet_length("payload"), "digest": base32_sha1(F.col("payload"))})
    several = unique_side(
        rows.where(F.col("bytes") >= smallest), ["digest", "bytes"], first=F.min("id"), n=F.count("*")
    ).where("n > 1 AND first IS NOT NULL").drop("n")
    known = rows.join(written(several, "equal-payloads"), ["digest", "bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(NEWLINE))

    def urn(value):
        return F.concat(F.lit(_URN), F.coalesce(value.cast("string"), F.lit("")), F.lit(">"))

    head = F.concat(
        F.lit(f"{MAGIC}{VERSION.split('.')[1]}{NEWLINE}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(
            revisit, F.concat(line("WARC-Refers-To", urn(F.col("first"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
        F.lit(NEWLINE),
    )
    return known.select(F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload")), F.lit(NEWLINE)).alias("record"))


def write_archives(pages, path, **options):
    """Write one archive per task below ``path``.

    Spark's text writer ends every record with the second of its two closing line breaks,
    so the files are byte for byte plain WARC.
    """
    as_records(pages, **options).write.option("lineSep", NEWLINE).text(path)


def _lines(spark, path):
    """(path, block, value): the bytes after each magic, and at the start of a file those before the first."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


def _numbered(frames):
    """Rows of each frame with their number inside the block; a block is read in order by one task."""
    at, seq = None, 0
    for frame in frames:
        numbers = []
        for key in zip(frame["path"], frame["block"]):
            at, seq = (at, seq + 1) if key == at else (key, 0)
            numbers.append(seq)
        yield frame.assign(seq=numbers)


def parse_head(value):
    """(length of the header, its fields in lower case), or None if it is no header."""
    end = value.find(b"\r\n\r\n")
    if end < 0 or value[1:3] != b"\r\n" or not value[:1].isdigit():
        return None
    fields = {}
    for row in value[3:end].split(b"\r\n"):
        name, colon, content = row.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = content.strip().decode("utf-8", "replace")
    return (end + 4, fields) if fields.get(b"content-length", "").isascii() and fields.get(b"content-length", "").isdigit() else None


def _sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _candidates(frames):
    for frame in _numbered(frames):
        rows = []
        for path, block, value, seq in frame.itertuples(index=False):
            head = None if block == 0 and seq == 0 else parse_head(value)
            row = [path, block, seq, len(value) + len(MAGIC)]
            if head is None:
                rows.append((*row, -1, -1, None, None, None, None, None, None, None))
                continue
            at, fields = head
            content = int(fields[b"content-length"])
            row += [at, content, *(fields.get(k) for k in (
                b"warc-type", b"warc-record-id", b"warc-target-uri", b"warc-refers-to", b"warc-payload-digest"
            ))]
            # Whole when the content and its two line breaks end where the next magic begins.
            whole = len(value) == at + content + 4
            rows.append((*row, content if whole else None, _sha1(value[at : at + content]) if whole else None))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in LINE.split(", ")])
        out["body_bytes"] = out["body_bytes"].astype("Int64")
        yield out


def _in_block(group):
    """Sorted by place, with the index of the successor inside the block (or -1)."""
    group = group.sort_values("seq", ignore_index=True)
    start = group["base"].to_numpy() + np.cumsum(group["size"].to_numpy()) - group["size"].to_numpy() - len(MAGIC)
    valid = group["head"].to_numpy() >= 0
    end = start + len(MAGIC) + group["head"].to_numpy() + group["content"].to_numpy() + 4
    after = np.where(valid, end, -1)
    at = np.minimum(np.searchsorted(start, after), len(start) - 1)
    inside = np.where(valid & (start[at] == after), at, -1)
    return group.assign(start=start, next=after), inside


def _leave(group: pd.DataFrame) -> pd.DataFrame:
    """Candidates with the offset at which the chain from each one leaves the block."""
    rows, inside = _in_block(group)
    jump = np.where(inside >= 0, inside, np.arange(len(rows)))
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        jump = further
    return pd.DataFrame({"path": rows["path"], "start": rows["start"], "exit": rows["next"].to_numpy()[jump]})


def _walk(group: pd.DataFrame) -> pd.DataFrame:
    """All lines of a block, those on the chain from its entry marked."""
    rows, inside = _in_block(group)
    kept = np.zeros(len(rows), bool)
    entry = rows["entry"].iloc[0]
    at = np.searchsorted(rows["start"].to_numpy(), entry) if pd.notna(entry) else -1
    at = int(at) if 0 <= at < len(rows) and rows["start"].iloc[at] == entry else -1
    while at >= 0 and rows["head"].iloc[at] >= 0:
        kept[at] = True
        at = int(inside[at])
    return rows.assign(kept=kept).drop(columns=["base", "entry"])


def verified_lines(spark, path):
    """Lines of all archives below ``path`` with ``start``, ``next`` and ``kept``.

    Only sizes and header fields move.  The number of rounds is the logarithm of the
    number of blocks of the largest archive.
    """
    lines = written(_lines(spark, path).mapInPandas(_candidates, LINE), "record-candidates")
    blocks = lines.groupBy("path", "block").agg(F.sum("size").alias("bytes"))
    ahead = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(blocks.select("path", "block", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("base")), "blocks")
    placed = lines.join(bases, ["path", "block"])
    hops = written(
        placed.groupBy("path", "block").applyInPandas(_leave, "path string, start long, exit long").where("start >= 0"), "hops"
    )
    targets = hops.select("path", F.col("exit").alias("start")).distinct()
    jumps = written(hops.join(targets, ["path", "start"]).union(hops.where("start = 0")).distinct(), "jumps")
    reached = jumps.where("start = 0").select("path", "start")
    count = reached.count()
    while True:
        onward = reached.join(jumps, ["path", "start"]).select("path", F.col("exit").alias("start"))
        reached = written(reached.union(onward.join(jumps.select("path", "start"), ["path", "start"])).distinct(), "reached")
        now = reached.count()
        if now == count:
            break
        count = now
        second = jumps.select("path", F.col("start").alias("exit"), F.col("exit").alias("beyond"))
        jumps = written(
            jumps.join(second, ["path", "exit"], "left").select("path", "start", F.coalesce("beyond", "exit").alias("exit")), "jumps"
        )
    # The block an entry lies in is the last one that starts before it.
    spans = bases.select(
        "path", "block", "base",
        F.lead("base", 1, 1 << 62).over(Window.partitionBy("path").orderBy("block")).alias("upto"),
    )
    shift = len(MAGIC)
    entries = reached.join(spans, "path").where(f"start + {shift} >= base AND start + {shift} < upto")
    first = entries.groupBy("path", "block").agg(F.min("start").alias("entry"))
    marked = placed.join(first, ["path", "block"], "left")
    return written(marked.groupBy("path", "block").applyInPandas(_walk, f"{LINE}, start long, next long, kept boolean"), "records")


def _owned(lines):
    """Lines that are no whole record by themselves, with the start of the record each belongs to.

    A record ends where its successor begins, so lines after a broken chain belong to none.
    """
    parts = lines.where("NOT kept OR body_bytes IS NULL").where("start >= 0")
    order = Window.partitionBy("path").orderBy("start")
    record = F.last(F.when(F.col("kept"), F.struct("start", "next")), ignorenulls=True).over(order)
    inside = (F.col("start") == F.col("record.start")) | (F.col("start") < F.col("record.next"))
    return parts.withColumn("record", record).where(inside).withColumn("owner", F.col("record.start")).drop("record")


def _joined(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("start")
    value = MAGIC.encode().join(group["value"])
    head, content = int(group["head"].iloc[0]), int(group["content"].iloc[0])
    body = value[head : head + content]
    return pd.DataFrame(
        {"path": group["path"].iloc[:1], "start": group["owner"].iloc[:1], "payload": [body], "bytes": [len(body)], "sha1": [_sha1(body)]}
    )


def split_payloads(spark, path, lines):
    """(path, start, payload, bytes, sha1) of the records whose payload contains the magic."""
    numbered = _lines(spark, path).mapInPandas(_numbered, "path string, block long, value binary, seq long")
    parts = _owned(lines).select("path", "block", "seq", "start", "owner", "head", "content")
    return numbered.join(parts, ["path", "block", "seq"]).groupBy("path", "owner").applyInPandas(
        _joined, "path string, start long, payload binary, bytes long, sha1 string"
    )


def read_records(spark, path):
    """Verified records of all archives below ``path``, without payloads.

    (path, start, next, record_type, record_id, target, refers_to, digest, payload_bytes,
    payload_digest); the last two are computed from the payload as read, not from the
    header.  A file whose chain breaks yields the records before the break.
    """
    lines = verified_lines(spark, path)
    broken = lines.where("kept AND body_bytes IS NULL")
    kept = lines.where("kept")
    if broken.isEmpty():
        kept = kept.withColumns({"bytes": F.col("body_bytes"), "sha1": F.col("body_digest")})
    else:
        own = written(split_payloads(spark, path, lines).drop("payload"), "split-payloads")
        kept = kept.join(own, ["path", "start"], "left").withColumns(
            {"bytes": F.coalesce("body_bytes", "bytes"), "sha1": F.coalesce("body_digest", "sha1")}
        )

    def page(column):
        return F.nullif(F.regexp_extract(column, rf"^{_URN}(-?\d*)>$", 1), F.lit("")).cast("long")

    return kept.select(
        "path", "start", "next", F.col("kind").alias("record_type"), page("record_id").alias("record_id"),
        "target", page("refers_to").alias("refers_to"), F.regexp_replace("digest", "^sha1:", "").alias("digest"),
        F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
    )


def read_payloads(spark, path, lines=None):
    """(path, start, payload) of every verified record; bytes move once to meet their record."""
    lines = verified_lines(spark, path) if lines is None else lines
    numbered = _lines(spark, path).mapInPandas(_numbered, "path string, block long, value binary, seq long")
    whole = lines.where("kept AND body_bytes IS NOT NULL").select("path", "block", "seq", "start", "head", "content")
    plain = numbered.join(whole, ["path", "block", "seq"]).select(
        "path", "start", F.expr("substring(value, cast(head AS int) + 1, cast(content AS int))").alias("payload")
    )
    return plain.union(split_payloads(spark, path, lines).select("path", "start", "payload"))


def resolve_revisits(records):
    """``records`` whose revisits carry length and digest of the payload they refer to."""
    origin = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to")).agg(
        F.max("payload_bytes").alias("bytes"), F.max("payload_digest").alias("sha1")
    )
    direct = records.where("record_type <> 'revisit'")
    revisits = records.where("record_type = 'revisit'")
    wanted = revisits.select("refers_to").distinct().join(origin, "refers_to")
    found = revisits.join(wanted, "refers_to", "left").withColumns({"payload_bytes": F.col("bytes"), "payload_digest": F.col("sha1")})
    return direct.unionByName(found.drop("bytes", "sha1"))
