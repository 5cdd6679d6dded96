"""Office-file queries over files Spark builds from the document texts."""

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.functions import mime
from sheafline.operators import extraction
from sheafline.plans import inputs
from sheafline.plans.registry import query
from sheafline.plans.sqltext import WS

WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
LINES_SQL = f"""(SELECT document_id, unnest(string_split(text, chr(10))) AS line,
                        generate_subscripts(string_split(text, chr(10)), 1) AS n FROM {inputs.DOCUMENT_TEXT.sql})"""


def _archive(parts):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in parts.items():
            archive.writestr(name, body)
    return buffer.getvalue()


@F.pandas_udf(T.BinaryType())
def as_docx(texts: pd.Series) -> pd.Series:
    """A document with one paragraph per line."""

    def build(text):
        body = "".join(f"<w:p><w:r><w:t>{escape(t)}</w:t></w:r></w:p>" for t in text.split("\n"))
        xml = f'<w:document xmlns:w="{WORD}"><w:body>{body}</w:body></w:document>'
        return _archive({"word/document.xml": xml})

    return texts.map(build)


@F.pandas_udf(T.BinaryType())
def as_xlsx(texts: pd.Series) -> pd.Series:
    """A workbook with an empty first sheet and a second one of line numbers and lengths."""
    book = (
        f'<workbook xmlns="{SHEET}" xmlns:r="{RELATIONS}"><sheets><sheet name="Blank" r:id="r1"/>'
        '<sheet name="Lines" r:id="r2"/></sheets></workbook>'
    )
    links = "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in (1, 2))
    header = '<row r="1"><c r="A1" t="inlineStr"><is><t>line</t></is></c><c r="B1" t="inlineStr"><is><t>chars</t></is></c></row>'

    def sheet(rows):
        return f'<worksheet xmlns="{SHEET}"><sheetData>{rows}</sheetData></worksheet>'

    def build(text):
        rows = "".join(
            f'<row r="{i + 1}"><c r="A{i + 1}"><v>{i}</v></c><c r="B{i + 1}"><v>{len(t)}</v></c></row>'
            for i, t in enumerate(text.split("\n"), start=1)
        )
        return _archive(
            {
                "xl/workbook.xml": book,
                "xl/_rels/workbook.xml.rels": f"<Relationships>{links}</Relationships>",
                "xl/worksheets/sheet1.xml": sheet(""),
                "xl/worksheets/sheet2.xml": sheet(header + rows),
            }
        )

    return texts.map(build)


def _extracted(spark, folder, build, content_type):
    texts = inputs.DOCUMENT_TEXT.frame(spark, folder, spread_out=True)
    files = texts.select(
        "document_id", build("text").alias("content"), F.lit(content_type).alias("content_type")
    )
    return extraction.extract_text(files)


@query(
    "docx_text",
    f"""SELECT document_id, md5(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (regexp_matches(line, '[^{WS}]')), '')) AS text_md5,
               CAST(count(*) FILTER (regexp_matches(line, '[^{WS}]')) AS VARCHAR) AS n_paragraphs
        FROM {LINES_SQL} GROUP BY document_id""",
)
def docx_text(spark, folder):
    """Documents stored as DOCX, one paragraph per line, and read back."""
    made = _extracted(spark, folder, as_docx, mime.DOCX)
    return made.select(
        "document_id",
        F.md5(F.get("pages", F.lit(0))["text"]).alias("text_md5"),
        F.col("metadata")["num_paragraphs_extracted"].alias("n_paragraphs"),
    )


@query(
    "xlsx_pages",
    f"""SELECT document_id, 2 AS page, concat('# Hoja: Lines', chr(10), chr(10),
               '| ', lpad('line', w1, ' '), ' | ', lpad('chars', w2, ' '), ' |', chr(10),
               '|', repeat('-', w1 + 1), ':|', repeat('-', w2 + 1), ':|', chr(10), body) AS text
        FROM (SELECT document_id, any_value(w1) AS w1, any_value(w2) AS w2,
                     string_agg(concat('| ', lpad(CAST(n AS VARCHAR), w1, ' '), ' | ',
                                       lpad(CAST(length(line) AS VARCHAR), w2, ' '), ' |'), chr(10) ORDER BY n) AS body
              FROM (SELECT *, CAST(greatest(6, max(length(CAST(n AS VARCHAR))) OVER d) AS INT) AS w1,
                           CAST(greatest(7, max(length(CAST(length(line) AS VARCHAR))) OVER d) AS INT) AS w2
                    FROM {LINES_SQL} WINDOW d AS (PARTITION BY document_id)) GROUP BY document_id)""",
)
def xlsx_pages(spark, folder):
    """Line lengths stored as a worksheet and read back as a page with a pipe table."""
    made = _extracted(spark, folder, as_xlsx, mime.XLSX)
    return made.select("document_id", F.inline("pages"))
