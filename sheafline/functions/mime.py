"""Content-type allowlist, normalisation, reader choice and inference."""

import mimetypes

from pyspark.sql import functions as F

from sheafline.functions import text

# Accepted content types.
DOCX = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
XLSX = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
ACCEPTED_TYPES = (
    "application/pdf",
    DOCX,
    "application/msword",
    "text/plain",
    "text/markdown",
    "text/html",
    XLSX,
    "application/vnd.ms-excel",
)

# Reader per normalised type (two legacy types share a reader).
READERS = {
    "application/pdf": "pdf",
    DOCX: "docx",
    "application/msword": "docx",
    "text/plain": "txt",
    "text/html": "html",
    "text/markdown": "md",
    XLSX: "xlsx",
    "application/vnd.ms-excel": "xlsx",
}

# Compression suffixes are looked through: report.txt.gz is still plain text.
COMPRESSION_SUFFIXES = "gz|Z|bz2|xz|br"
# Suffixes of accepted types that not every Python release lists.
LATER_SUFFIXES = {"md": "text/markdown", "docx": DOCX, "xlsx": XLSX}


def suffix_table():
    """Suffix -> type from Python's standard table, not from files of this machine."""
    known = mimetypes.MimeTypes(filenames=())
    table = {ext.lstrip("."): kind for ext, kind in known.types_map[True].items()}
    # short forms such as .tgz stand for a type inside a compressed file
    packed = {short.lstrip("."): table[full.split(".")[1]] for short, full in known.suffix_map.items()}
    return {**LATER_SUFFIXES, **packed, **table}


def _lookup(table, key):
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def is_accepted(content_type):
    """Exact, case-sensitive allowlist test; a missing type is not accepted."""
    return F.coalesce(content_type.isin(*ACCEPTED_TYPES), F.lit(False))


def normalize_mime(content_type):
    """Text before the first ';', stripped and lower-cased."""
    return F.lower(text.strip(F.split_part(content_type, F.lit(";"), F.lit(1))))


def reader_for(content_type):
    """Name of the reader for a raw content type, null when none is registered."""
    return _lookup(READERS, normalize_mime(content_type))


def guess_type(path):
    """Type from the file suffix, null when unknown."""
    name = F.regexp_replace(
        F.substring_index(path, "/", -1), rf"\.({COMPRESSION_SUFFIXES})$", ""
    )
    suffix = F.regexp_extract(name, r"(?s)\A\.*[^.].*\.([^.]+)\z", 1)
    return _lookup(suffix_table(), F.lower(suffix))


def infer_content_type(content_type, path):
    """The given type, or the guess when it is null or empty."""
    return F.coalesce(F.nullif(content_type, F.lit("")), guess_type(path))
