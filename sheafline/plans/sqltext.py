"""SQL fragments shared by the counterparts."""

# The whitespace class of sheafline.functions.text, as RE2 spells it.
WS = r"\x{9}-\x{D}\x{1C}-\x{1F}\x{85}\p{Z}"
ISO = "'%Y-%m-%dT%H:%M:%S'"


def words(column):
    return f"list_filter(regexp_split_to_array({column}, '[{WS}]+'), lambda w: w <> '')"


def chunk_rows(source, size, overlap, keep, text="text"):
    """SELECT with keep columns, chunk_index and text for texts of ``source``."""
    step = size - overlap
    return f"""(
      SELECT {keep}, CAST(k AS INT) AS chunk_index,
             array_to_string(list_slice(w, k * {step} + 1, k * {step} + {size}), ' ') AS text
      FROM (
        SELECT *, unnest(range(0, 1 + greatest(0, CAST(ceil((len(w) - {size}) / {step}.0) AS BIGINT)))) AS k
        FROM (SELECT *, {words(text)} AS w FROM {source}) WHERE len(w) > 0
      )
    )"""


def chunk_id(page="-1", index="chunk_index"):
    return f"sha256(concat_ws(':', document_id, {page}, {index}))"
