"""JSON payloads: decoding with a failure route, and serialising.

``decode`` parses a message once; the other functions take its result, so an
operator puts it into a column of its own and reads several fields from it.
"""

from pyspark.sql import functions as F

ERROR_GROUP = "error_parsing"
# Closes the array a message is wrapped in for parsing.
END_MARK = "sheafline:end"
# A variant has a largest size; longer messages are held as JSON text, with equal results.
VARIANT_BYTES = 16 * 1024**2 - 1024


def decode(value):
    """Parsed message: a variant, or JSON texts where the message is too large for one.

    Either holds ``[message, mark]`` and is null when that does not parse.  The parser
    stops after the first value and would accept text behind it.  Inside an array closed
    by a mark, such text breaks the array or moves the mark, which :func:`is_valid`
    notices.
    """
    whole = F.concat(F.lit("["), value, F.lit(f',"{END_MARK}"]'))
    small = F.octet_length(value) <= VARIANT_BYTES
    return F.struct(
        F.try_parse_json(F.when(small, whole)).alias("doc"),
        F.from_json(F.when(~small, whole), "array<string>").alias("parts"),
    )


def _message(doc):
    """JSON text of a message that is too large for a variant."""
    return F.get(doc["parts"], F.lit(0))


def is_valid(doc):
    """True when the message is one JSON value and nothing else."""
    mark = F.coalesce(F.try_variant_get(doc["doc"], "$[1]", "string"), F.get(doc["parts"], F.lit(1)))
    return F.coalesce(mark == END_MARK, F.lit(False))


def is_object(doc):
    """True when the message is valid JSON and its top level is an object."""
    small = F.try_variant_get(doc["doc"], "$[0]", "map<string,variant>").isNotNull()
    return is_valid(doc) & (small | F.coalesce(F.startswith(_message(doc), F.lit("{")), F.lit(False)))


def tenant_or(doc, default):
    """company_id of a message; ``default`` when the message has no such key.

    An absent key differs from an explicit JSON null, which stays null.
    Malformed messages and non-objects count as having no key.
    """
    small = F.try_variant_get(doc["doc"], "$[0].company_id", "variant").isNotNull()
    keys = F.json_object_keys(F.when(F.startswith(_message(doc), F.lit("{")), _message(doc)))
    present = small | F.coalesce(F.array_contains(keys, "company_id"), F.lit(False))
    return F.when(is_valid(doc) & present, text_field(doc, "company_id")).otherwise(F.lit(default))


def safe_tenant(doc):
    """Grouping key of a message: its company_id, or ``error_parsing``."""
    return tenant_or(doc, ERROR_GROUP)


def text_field(doc, name):
    """A top-level field as text; null when absent or JSON null."""
    large = F.from_json(_message(doc), f"`{name}` string")[name]
    return F.coalesce(F.try_variant_get(doc["doc"], f"$[0].{name}", "string"), large)


def to_payload(*columns):
    """JSON object of the given columns; null fields are written, not dropped."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
