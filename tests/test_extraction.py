import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sheafline.functions import markup, mime
from sheafline.operators import extraction
from sheafline.operators.chunking import ChunkSpec, chunk_records
from sheafline.schemas import PAGES
from sheafline.sources.objects import list_objects, read_objects, split_by_length, with_guessed_type
from tests.office_files import docx, paragraph, xlsx

DOCX_BYTES = docx(
    paragraph("First  line")
    + "<w:p><w:r><w:t> </w:t></w:r></w:p>"
    + "<w:tbl><w:tr><w:tc>" + paragraph("in a table") + "</w:tc></w:tr></w:tbl>"
    + "<w:p><w:r><w:t>tab</w:t><w:tab/><w:t>bed</w:t><w:br/></w:r>"
    "<w:hyperlink><w:r><w:t>link</w:t></w:r></w:hyperlink><w:del><w:r><w:t>gone</w:t></w:r></w:del></w:p>"
)
XLSX_BYTES = xlsx(
    {
        "Datos": '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><t>when</t></is></c></row>'
        '<row r="2"><c r="A2"><v>1</v></c><c r="B2" t="s"><v>2</v></c><c r="C2" s="1"><v>45292</v></c></row>'
        '<row r="3"><c r="A3"><v>22</v></c></row>',
        "Empty": "",
        "Header only": '<row r="1"><c r="A1" t="s"><v>0</v></c></row>',
        "Broken": None,
        "Decimals": '<row r="1"><c r="A1" t="inlineStr"><is><t>x</t></is></c><c r="B1" t="inlineStr"><is><t>y</t></is></c></row>'
        '<row r="2"><c r="A2"><v>1.5</v></c><c r="B2" t="b"><v>1</v></c></row><row r="3"><c r="A3"><v>10</v></c><c r="B3" t="b"><v>0</v></c></row>',
    },
    shared=("id", "name", "Ana"),
    formats=(14,),
)


def extract(spark, rows, **options):
    df = spark.createDataFrame(
        [(str(i), bytearray(content), kind) for i, (content, kind) in enumerate(rows)],
        "path STRING, content BINARY, content_type STRING",
    )
    return extraction.extract_text(df, **options).orderBy(F.col("path").cast("int")).collect()


@pytest.mark.parametrize(
    "html, lines, title",
    [
        ("<p>a<b>b</b><!-- c -->d</p><script>x</script>", ["a", "b", "d"], None),
        ("<title>T &amp; &#233;</title><style>p{}</style><p> x <br>y&nbsp;</p>", ["T & é", "x", "y"], "T & é"),
        ("<!DOCTYPE html><p>1 < 2 &unknown; &copy;</p>", ["1 < 2 &unknown ©"], None),
        ("<p>open <b>never closed", ["open", "never closed"], None),
        ("<template><p>hidden</p></template><p>seen</p></div>", ["seen"], None),
        ("<title>a<b>c</b></title>", ["a", "c"], None),
        ("<title></title><title>second</title>", ["second"], None),
        ("<svg/><p/>text<script>if (a < b) { x = '</p>'; }</script>end", ["text", "end"], None),
        ("", [""], None),
    ],
)
def test_html_nodes(html, lines, title):
    text, found = markup.html_nodes(html)
    assert text.split("\n") == lines
    if "<title>a<b>" not in html:
        assert found == title


def test_html_decoding_and_types(spark):
    rows = extract(spark, [(b"<p>\xff\xc3\xb1</p>", "text/html"), (b"<p>x</p>", "text/html; charset=utf-8")])
    assert [r.pages[0].text for r in rows] == ["�ñ", "x"]
    strict = extract(
        spark,
        [(b"<p>x</p>", "text/html; charset=utf-8"), (b"x", "text/plain"), (XLSX_BYTES, mime.XLSX.upper())],
        strict=True,
    )
    assert [r.stage for r in strict] == ["unknown", None, None]


def test_plain_text_encodings(spark):
    rows = extract(spark, [("ñ".encode("latin-1"), "text/plain"), ("ñ".encode(), "text/plain"), (b"", "text/plain")])
    assert [r.pages[0].text for r in rows] == ["ñ", "ñ", ""]
    assert [r.metadata["encoding_used"] for r in rows] == ["latin-1", "utf-8", "utf-8"]
    assert all(r.pages[0].page is None and r.error is None for r in rows)


@pytest.mark.parametrize(
    "source, tokens",
    [
        ("Title\n=====\ntext", "# Title text"),
        ("Sub\n---\ntext", "## Sub text"),
        ("## Head ##", "## Head"),
        ("![alt](u.png) [label](http://x) [ref][1]\n\n[1]: http://y", "label ref"),
        ("- a\n+ b\n* c", "* a * b * c"),
        ("*em* and __strong__ and **bold**", "_em_ and **strong** and **bold**"),
        ("<http://x/y>", "http://x/y"),
        ("a\n\n***\n\nb", "a * * * b"),
        ("```python\nx = 1\n```", "`python x = 1`"),
        ("<b>x</b> <span class='k'>y</span><!-- no -->", "**x** y"),
        ("<me@example.org>", "me@example.org"),
        ("***both***", "**_both_**"),
        (r"\*not em\* &lt;tag&gt; a &amp;lt; b", "*not em* <tag> a &lt; b"),
    ],
)
def test_markdown_tokens(spark, source, tokens):
    row = extract(spark, [(source.encode(), "text/markdown")])[0]
    assert row.pages[0].text.split() == tokens.split()


def test_markdown_must_be_utf8(spark):
    row = extract(spark, [(b"\xff", "text/markdown")])[0]
    assert row.pages is None and row.stage == "unknown"


def test_docx(spark):
    row = extract(spark, [(DOCX_BYTES, mime.DOCX)])[0]
    assert row.pages[0].text == "First  line\ntab\tbed\nlink"
    assert row.metadata["num_paragraphs_extracted"] == "2"


def test_xlsx(spark):
    row = extract(spark, [(XLSX_BYTES, mime.XLSX)])[0]
    assert [p.page for p in row.pages] == [1, 5]
    assert row.metadata == {"total_sheets_extracted": "2", "sheet_names": "Datos,Empty,Header only,Broken,Decimals"}
    assert row.pages[0].text.split("\n") == [
        "# Hoja: Datos",
        "",
        "|   id | name   | when                |",
        "|-----:|:-------|:--------------------|",
        "|    1 | Ana    | 2024-01-01 00:00:00 |",
        "|   22 | nan    | NaT                 |",
    ]
    assert row.pages[1].text.split("\n")[2:] == [
        "|    x | y     |",
        "|-----:|:------|",
        "|  1.5 | True  |",
        "| 10   | False |",
    ]


def test_errors_are_rows(spark):
    rows = extract(
        spark,
        [(b"no zip", mime.DOCX), (b"no zip", mime.XLSX), (b"%PDF", "application/pdf"), (b"x", None), (b"ok", "text/plain")],
    )
    assert [r.stage for r in rows] == ["unknown"] * 4 + [None]
    assert "BadZipFile" in rows[0].error and "application/pdf" in rows[2].error
    documents, dead = extraction.split_results(
        extraction.extract_text(
            spark.createDataFrame([(bytearray(b"x"), "a/b"), (bytearray(b"x"), "text/plain")], "content BINARY, content_type STRING")
        )
    )
    assert documents.count() == 1 and dead.count() == 1 and "pages" not in dead.columns


def test_a_reader_plugs_in(spark):
    pdf = extraction.Reader(
        parse=lambda content: F.decode(content, "UTF-8"),
        pages=lambda t: F.array(F.struct(F.lit(1).alias("page"), t.alias("text"))),
    )
    row = extract(spark, [(b"one page", "application/pdf")], readers={"pdf": pdf})[0]
    assert row.error is None and (row.pages[0].page, row.pages[0].text) == (1, "one page")


def test_page_filter(spark):
    df = spark.createDataFrame([([(1, "a"), (2, " \n"), (3, "b"), (4, " ")],)], "pages ARRAY<STRUCT<page: INT, text: STRING>>")
    row = extraction.keep_text_pages(df.select(F.col("pages").cast(PAGES).alias("pages"))).first()
    assert [p.page for p in row.pages] == [1, 3] and row.total_pages_extracted == 2


def test_files_to_chunks(spark, tmp_path):
    for name, content in {"a/note 1.txt": b"one two three", "a/deep/d.docx": DOCX_BYTES, "b/s.xlsx": XLSX_BYTES}.items():
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
    objects = with_guessed_type(read_objects(spark, str(tmp_path)))
    assert {r.path for r in list_objects(spark, str(tmp_path)).collect()} == {"a/note 1.txt", "a/deep/d.docx", "b/s.xlsx"}
    documents = extraction.extract_text(objects).select(
        F.col("path").alias("document_id"), F.lit("c").alias("company_id"), "pages"
    )
    chunks = chunk_records(documents, ChunkSpec(2, 0))
    assert chunks.filter("document_id = 'a/note 1.txt'").count() == 2
    assert {r.page for r in chunks.filter("document_id = 'b/s.xlsx'").collect()} == {1, 5}
    small, large = split_by_length(read_objects(spark, str(tmp_path)), 20)
    assert [r.path for r in small.select("path").collect()] == ["a/note 1.txt"]
    assert {(r.path, r.stage) for r in large.collect()} == {("a/deep/d.docx", "s3_download"), ("b/s.xlsx", "s3_download")}
    assert all(r.length > 20 and str(r.length) in r.error for r in large.collect())


def test_bad_pages_become_rows(spark):
    marks = "\n".join(c * 20_000 for c in "*-_") + "\n" + "* " * 20_000
    rows = [("a", b"<![foo bar]>x", "text/html"), ("b", b"<p>good</p>", "text/html"), ("c", marks.encode(), "text/markdown")]
    files = spark.createDataFrame([(p, bytearray(c), t) for p, c, t in rows], "path STRING, content BINARY, content_type STRING")
    got = {r.path: r for r in extraction.extract_text(files).collect()}
    assert got["a"].error and got["a"].stage == "unknown" and got["a"].pages[0].text is None
    assert got["b"].error is None and got["b"].pages[0].text == "good"
    assert got["c"].error is None and got["c"].pages[0].text.split() == ["*", "*", "*"] * 4


def test_unclosed_tags_scale():
    def seconds(n):
        started = time.perf_counter()
        markup.html_nodes("<p>a<li>b" * n)
        return time.perf_counter() - started

    seconds(1000)
    small, large = min(seconds(20_000) for _ in range(3)), min(seconds(40_000) for _ in range(3))
    assert large < 3.5 * small


# Pieces that make some rule read ahead: none may be read again from every place.
TRAPS = [
    "# a{}b", "# {}", "# a #{}x", "```{}", "``` ", "`", "![", "![a](", "![a][", "[", "[a](", "[a](b(", "[a][", "[a]: ", "\n[", "<!--", "<!-- --", "<http:",
    "<a", "<a@", "<b", "a\n=", "a\n-", "\n#", "* ", "*", "***", "***a ", "__", "__a", "*a ", "\\", " \t", "&", "- \t",
]


@pytest.mark.parametrize("trap", TRAPS)
def test_markdown_rules_take_linear_time(spark, trap):
    def seconds(n):
        text = trap.format(" " * n) if "{}" in trap else trap * (n // len(trap)) + "x"
        frame = spark.createDataFrame([(text,)], "t string").select(F.length(markup.markdown_to_text(F.col("t"))).alias("n"))
        best = float("inf")
        for _ in range(2):
            started = time.perf_counter()
            frame.collect()
            best = min(best, time.perf_counter() - started)
        return best

    assert seconds(200_000) < 3 + 4 * seconds(20_000)


@pytest.mark.parametrize(
    ("markdown", "want"),
    [
        ("# a # b ##  ", "# a # b"), ("# a#", "# a"), ("# a # #", "# a #"), ("##", "##"), ("####### x", "####### x"), ("#a", "# a"),
        ("## a    b ## \nc", "## a    b\nc"), ("```py\n x \n\n```", "`py\n x`"), ("``` `a` ```", "``a``"), ("``````", "``"),
        ("a <!-- b --> c <!-- d", "a  c <!-- d"), ("[a](http://x/b_(c)) d", "a d"), ("[a [b](c)", "[a b"), ("![i](u) t", " t"),
        ("[a][r]\n[r]: http://x y", "a\n"), ("<http://x> <m@x.org> <b>k</b>", "http://x m@x.org **k**"),
    ],
)
def test_markdown_rules(spark, markdown, want):
    got = spark.createDataFrame([(markdown,)], "t string").select(markup.markdown_to_text(F.col("t")).alias("t")).first()["t"]
    assert got.split() == want.split()


def test_names_of_stored_files_mean_themselves(spark, tmp_path):
    root = tmp_path / "x"
    names = {"50%.txt", "a+b.txt", "a%20b.txt", f"deep/{str(root).strip('/')}/y.txt", "é ü.txt", "x/x/z.txt"}
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(name)
    for spelled in (str(root), f"{root}/", f"file://{root}", f"file:{root}/deep/.."):
        got = {r["path"]: bytes(r["content"]).decode() for r in read_objects(spark, spelled).collect()}
        assert got == {n: n for n in names}


def test_files_reach_python_in_bounded_batches(spark):
    """Files of a megabyte are handed over a few at a time, though their number is below Spark's limit."""

    @F.pandas_udf("string")
    def together(content: pd.Series) -> pd.Series:
        return pd.Series([str(len(content))] * len(content))

    plain = spark.newSession()
    plain.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = plain.range(0, 40, 1, 1).selectExpr("'text/plain' AS content_type", "CAST(repeat('x', 1000000) AS BINARY) AS content")
    reader = extraction.Reader(parse=together, pages=lambda n: F.array(F.struct(F.lit(None).cast("int").alias("page"), n.alias("text"))))
    sizes = [int(r["pages"][0]["text"]) for r in extraction.extract_text(rows, {"txt": reader}).collect()]
    assert len(sizes) == 40 and max(sizes) <= 10
