"""Text extraction jobs: binary rows in, page arrays with metadata and errors out.

A reader parses the content column into one column of its own and derives
pages, metadata and an error from it.  All readers run in one pass: each sees
the content of its own rows and null elsewhere, so objects are scanned once
however many formats there are.  Plain text and Markdown stay in the JVM; HTML
and the zipped office formats parse whole files in Arrow batches.
"""

from dataclasses import dataclass
from typing import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.functions import markup, mime, office, text
from sheafline.operators.events import STAGE_DOWNLOAD, STAGE_UNKNOWN, STAGE_VALIDATION, with_content_type, with_stage
from sheafline.schemas import PAGES
from sheafline.session import bounded_batches

METADATA = T.MapType(T.StringType(), T.StringType())
RESULT = T.StructType(
    [
        T.StructField("pages", PAGES),
        T.StructField("metadata", METADATA),
        T.StructField("error", T.StringType()),
    ]
)
STRICT_LOWERCASE = ("xlsx",)
OUTCOME_TEXT = "text"
OUTCOME_DEAD = "dead_letter"


def _one_page(value):
    return F.array(F.struct(F.lit(None).cast("int").alias("page"), value.alias("text")))


def _metadata(**items):
    return F.create_map(*[x for k, v in items.items() for x in (F.lit(k), v.cast("string"))])


def _nothing(_):
    return F.lit(None)


@dataclass(frozen=True)
class Reader:
    """How one format is read; every part is a function from column to column.

    ``parse`` takes the content and runs once per file; the other parts take its
    result.
    """

    parse: Callable
    pages: Callable
    metadata: Callable = _nothing
    error: Callable = _nothing


PLAIN = Reader(
    parse=text.decode_bytes,
    pages=lambda d: _one_page(d["text"]),
    metadata=lambda d: _metadata(encoding_used=d["encoding"]),
)

HTML = Reader(
    parse=markup.html_to_text,
    pages=lambda d: _one_page(d["text"]),
    metadata=lambda d: _metadata(title_extracted=d["title"]),
    error=lambda d: d["error"],
)

MARKDOWN = Reader(
    parse=lambda content: content.cast("string"),
    pages=lambda t: F.when(F.is_valid_utf8(t), _one_page(markup.markdown_to_text(t))),
    error=lambda t: F.when(~F.is_valid_utf8(t), F.lit("markdown is not valid utf-8")),
)


def file_reader(parse):
    """Reader from a function of one file's bytes to (pages, metadata).

    A file that cannot be parsed becomes an error value; the others go on.
    Declared non-deterministic so that a filter on the error does not parse twice.
    """

    @F.pandas_udf(RESULT)
    def run(content: pd.Series) -> pd.DataFrame:
        rows = []
        for raw in content:
            try:
                rows.append((None, None, None) if raw is None else (*parse(bytes(raw)), None))
            except Exception as error:
                rows.append((None, None, f"{type(error).__name__}: {error}"))
        return pd.DataFrame(rows, columns=["pages", "metadata", "error"])

    return Reader(
        parse=run.asNondeterministic(),
        pages=lambda r: r["pages"],
        metadata=lambda r: r["metadata"],
        error=lambda r: r["error"],
    )


def _read_docx(content):
    paragraphs = office.docx_paragraphs(content)
    return (
        [{"page": None, "text": "\n".join(paragraphs)}],
        {"num_paragraphs_extracted": str(len(paragraphs))},
    )


def _read_xlsx(content):
    pages, names = [], []
    for position, name, frame in office.xlsx_sheets(content):
        names.append(name)
        if isinstance(frame, Exception) or frame.empty:
            continue
        body = office.SHEET_TITLE.format(name=name) + office.pipe_table(frame)
        pages.append({"page": position, "text": body})
    return pages, {"total_sheets_extracted": str(len(pages)), "sheet_names": ",".join(names)}


READERS = {
    "txt": PLAIN,
    "html": HTML,
    "md": MARKDOWN,
    "docx": file_reader(_read_docx),
    "xlsx": file_reader(_read_xlsx),
}


def _reader_name(strict):
    raw = F.col("content_type")
    name = mime.reader_for(raw)
    if not strict:
        return name
    exact = (raw == mime.normalize_mime(raw)) | (
        name.isin(*STRICT_LOWERCASE) & (F.lower(raw) == mime.normalize_mime(raw))
    )
    return F.when(exact, name)


def extract_text(objects, readers=None, strict=False):
    """Run every row's reader; rows need ``content`` and ``content_type``.

    ``readers`` adds or replaces readers by name (a PDF reader plugs in as ``pdf``).
    The parts of the result stay separate columns, so a filter on the error does
    not compute the pages.
    ``strict`` refuses types that reach a reader only through normalisation,
    such as ``text/html; charset=utf-8``.  Failures carry ``error`` and ``stage``.
    """
    table = {**READERS, **(readers or {})}
    name = F.col("reader")
    routed = bounded_batches(objects).withColumn("reader", _reader_name(strict))
    done = routed.withColumns(
        {f"__{key}": r.parse(F.when(name == key, F.col("content"))) for key, r in table.items()}
    )
    kind = F.coalesce(F.col("content_type"), F.lit("null"))
    refused = F.concat(F.lit("no reader for content type: "), kind)

    def chosen(part, cast, otherwise=F.lit(None)):
        """One part of the result of the row's own reader."""
        for key, reader in table.items():
            value = getattr(reader, part)(F.col(f"__{key}")).cast(cast)
            otherwise = F.when(name == key, value).otherwise(otherwise)
        return otherwise.alias(part)

    result = done.select(
        *[c for c in routed.columns if c != "content"],
        chosen("pages", PAGES),
        chosen("metadata", METADATA),
        chosen("error", "string", refused),
    )
    return result.withColumn("stage", F.when(F.col("error").isNotNull(), F.lit(STAGE_UNKNOWN)))


def extract_events(events, readers=None, strict=False):
    """Events with the file each one names, through validation, download and extraction in one pass.

    ``content`` is null where no object was found; an ``error`` a reader of files has
    added says why.  Every row comes out once, with ``pages``, or with ``error`` and
    ``stage``; ``outcome`` tells the two apart, so one written result serves both the
    chunks and the dead letters and nothing is parsed for each of them.
    """
    told = F.col("error") if "error" in events.columns else F.lit(None).cast("string")
    rows = events.withColumn("__told", told).drop("error", "stage")
    staged = with_stage(with_content_type(rows)).withColumnRenamed("stage", "__stage")
    staged = staged.withColumn(
        "__stage", F.coalesce("__stage", F.when(F.col("content").isNull(), F.lit(STAGE_DOWNLOAD)))
    )
    early = F.col("__stage")
    readable = staged.withColumn("content", F.when(early.isNull(), F.col("content")))
    why = F.when(early == STAGE_VALIDATION, F.lit("a required field is missing")).when(
        early == STAGE_DOWNLOAD, F.coalesce("__told", F.lit("object not found"))
    )
    done = extract_text(readable, readers, strict).withColumns(
        {
            "pages": F.when(early.isNull(), F.col("pages")),
            "metadata": F.when(early.isNull(), F.col("metadata")),
            "error": F.coalesce(why, F.col("error")),
            "stage": F.coalesce(early, F.col("stage")),
        }
    )
    outcome = F.when(F.col("stage").isNull(), F.lit(OUTCOME_TEXT)).otherwise(F.lit(OUTCOME_DEAD))
    return done.drop("__told", "__stage").withColumn("outcome", outcome)


def split_results(extracted):
    """(documents, dead letters) of an extraction."""
    return extracted.filter("error IS NULL"), extracted.filter("error IS NOT NULL").drop("pages")


def keep_text_pages(df, column="pages"):
    """Drop blank pages, keep the numbering, and count what is left."""
    kept = F.filter(F.col(column), lambda p: text.has_text(p["text"]))
    return df.withColumn(column, kept).withColumn("total_pages_extracted", F.size(column))
