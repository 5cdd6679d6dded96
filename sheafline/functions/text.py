"""Whitespace-aware text expressions (all JVM side)."""

from pyspark.sql import functions as F

# The characters Unicode-aware splitting treats as whitespace, that
# is the separator categories plus nine control characters.  Java's own \s is
# ASCII only; listing the code points one by one is slower to match than \p{Z}.
WS = r"\x{9}-\x{D}\x{1C}-\x{1F}\x{85}\p{Z}"
WS_RUN = f"[{WS}]+"
NON_WS = f"[^{WS}]"


def words(col):
    """Whitespace-separated tokens, without empty items."""
    return F.array_remove(F.split(col, WS_RUN), "")


def has_text(col):
    """True when the text holds a non-whitespace character (stops at the first)."""
    return F.coalesce(col.rlike(NON_WS), F.lit(False))


def collapse_whitespace(col):
    """Trim and reduce every whitespace run to one space."""
    return F.trim(F.regexp_replace(col, WS_RUN, " "))


def strip(col):
    """Remove leading and trailing Unicode whitespace (Spark's trim knows spaces only)."""
    return F.regexp_replace(col, f"^{WS_RUN}|{WS_RUN}$", "")


def normalize_filename(col):
    return collapse_whitespace(col)


def object_path(company_id, document_id, filename):
    return F.concat_ws("/", company_id, document_id, filename)


def basename(path):
    return F.substring_index(path, "/", -1)


def decode_bytes(content):
    """Struct (text, encoding): UTF-8 when valid, otherwise Latin-1."""
    as_text = content.cast("string")
    valid = F.is_valid_utf8(as_text)
    return F.struct(
        F.when(valid, as_text).otherwise(F.decode(content, "ISO-8859-1")).alias("text"),
        F.when(valid, F.lit("utf-8")).otherwise(F.lit("latin-1")).alias("encoding"),
    )
