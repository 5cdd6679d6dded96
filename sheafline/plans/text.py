"""Extraction and chunking queries."""

from pyspark.sql import functions as F

from sheafline.functions import ids, markup, text
from sheafline.operators import chunking, events, extraction, joins
from sheafline.plans import inputs
from sheafline.plans.events import GUESS_SQL, READER_SQL
from sheafline.plans.registry import query
from sheafline.plans.sqltext import WS, chunk_id, chunk_rows, words
from sheafline.session import bounded_batches
from sheafline.sources.tables import dealt, read_table

SMALL = chunking.ChunkSpec(size=40, overlap=8)
PAGE_SPEC = chunking.ChunkSpec(size=12, overlap=3)

# Documents as page lists: one page per line, plus a blank page and a last page.
PAGED = inputs.Derived(
    "documents",
    {
        "document_id": inputs.ID,
        "company_id": "source",
        "body": "concat(text, '\n \t\n', lang)",
    },
)
PAGES_SQL = f"""(SELECT document_id, company_id, unnest(string_split(body, chr(10))) AS text,
                        CAST(generate_subscripts(string_split(body, chr(10)), 1) AS INT) AS page FROM {PAGED.sql})"""


def paged_documents(spark, folder):
    lines = F.split("body", "\n")
    pages = F.transform(lines, lambda t, i: F.struct((i + 1).alias("page"), t.alias("text")))
    return PAGED.frame(spark, folder, spread_out=True).select(
        "document_id", "company_id", pages.alias("pages")
    )


@query(
    "chunks",
    f"""SELECT {chunk_id()} AS chunk_id, document_id, company_id, text, -1 AS page, chunk_index
        FROM {chunk_rows(inputs.DOCUMENT_TEXT.sql, 1000, 200, 'document_id, company_id')}""",
)
def chunks(spark, folder):
    made = chunking.chunk_text(inputs.DOCUMENT_TEXT.frame(spark, folder, spread_out=True))
    return chunking.with_chunk_ids(made).select(
        "chunk_id", "document_id", "company_id", "text", F.lit(ids.NO_PAGE).alias("page"), "chunk_index"
    )


@query(
    "chunks_small",
    f"""SELECT document_id, chunk_index, text
        FROM {chunk_rows(inputs.DOCUMENT_TEXT.sql, 40, 8, 'document_id')}""",
)
def chunks_small(spark, folder):
    made = chunking.chunk_text(inputs.DOCUMENT_TEXT.frame(spark, folder, spread_out=True), SMALL)
    return made.select("document_id", "chunk_index", "text")


@query(
    "chunks_by_function",
    f"""SELECT document_id, company_id, chunk_index, text
        FROM {chunk_rows(inputs.DOCUMENT_TEXT.sql, 1000, 200, 'document_id, company_id')}
        UNION ALL SELECT document_id, 'sentences', CAST(i - 1 AS INT), s[i] FROM (
          SELECT document_id, list_filter(list_transform(string_split(text, '. '), lambda x: trim(x, ' ')), lambda x: x <> '') AS s,
                 unnest(range(1, len(s) + 1)) AS i FROM {inputs.DOCUMENT_TEXT.sql})""",
)
def chunks_by_function(spark, folder):
    """Chunkers as table functions of SQL: the default one, and one that cuts at sentences."""

    def sentences(content):
        return (s for s in (part.strip(" ") for part in content.split(". ")) if s)

    chunking.register_chunker(spark, "word_chunks", chunking.word_chunker())
    chunking.register_chunker(spark, "sentence_chunks", sentences)
    documents = inputs.DOCUMENT_TEXT.frame(spark, folder, spread_out=True)
    return spark.sql(
        """SELECT document_id, company_id, c.chunk_index, c.text FROM {documents} d, LATERAL word_chunks(d.text) c
           UNION ALL SELECT document_id, 'sentences', c.chunk_index, c.text FROM {documents} d, LATERAL sentence_chunks(d.text) c""",
        documents=documents,
    )


@query(
    "page_chunks",
    f"""SELECT {chunk_id('page')} AS chunk_id, * FROM (
          SELECT document_id, company_id, text, page,
                 CAST(row_number() OVER (PARTITION BY document_id ORDER BY page, chunk_index) - 1 AS INT) AS chunk_index
          FROM {chunk_rows(PAGES_SQL, 12, 3, 'document_id, company_id, page')})""",
)
def page_chunks(spark, folder):
    return chunking.chunk_records(paged_documents(spark, folder), PAGE_SPEC)


@query(
    "document_summary",
    f"""SELECT document_id, CAST(count(*) AS INT) AS total_pages_extracted,
               CAST(sum(length(text)) AS BIGINT) AS raw_text_length_chars,
               CAST(sum(CASE WHEN n = 0 THEN 0 ELSE 1 + greatest(0, ceil((n - 12) / 9.0)) END) AS INT) AS num_chunks_generated
        FROM (SELECT *, len({words('text')}) AS n FROM {PAGES_SQL}) GROUP BY document_id""",
)
def document_summary(spark, folder):
    return chunking.document_summary(paged_documents(spark, folder), PAGE_SPEC).drop("company_id")


@query(
    "page_filter",
    f"""SELECT document_id, CAST(count(*) AS INT) AS total_pages_extracted,
               string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) AS page_numbers
        FROM {PAGES_SQL} WHERE regexp_matches(text, '[^{WS}]') GROUP BY document_id""",
)
def page_filter(spark, folder):
    kept = extraction.keep_text_pages(paged_documents(spark, folder))
    numbers = F.transform("pages", lambda p: p["page"].cast("string"))
    return kept.select(
        "document_id", "total_pages_extracted", F.array_join(numbers, ",").alias("page_numbers")
    )


@query(
    "decode_text",
    """SELECT document_id, CASE WHEN lang = 'en' OR NOT regexp_matches(text, '[^\\x00-\\x7F]')
                                THEN 'utf-8' ELSE 'latin-1' END AS encoding, md5(t) AS text_md5
       FROM (SELECT CAST(doc_id AS VARCHAR) AS document_id, lang, text,
                    CASE WHEN lang = 'en' THEN text ELSE regexp_replace(text, '[^\\x{0}-\\x{FF}]', '?', 'g') END AS t
             FROM documents)""",
)
def decode_text(spark, folder):
    """English texts stored as UTF-8, the others as Latin-1 bytes, decoded again."""
    stored = read_table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"),
        F.when(F.col("lang") == "en", F.encode("text", "UTF-8"))
        .otherwise(F.encode("text", "ISO-8859-1"))
        .alias("content"),
    )
    decoded = stored.select("document_id", text.decode_bytes(F.col("content")).alias("d"))
    return decoded.select(
        "document_id", F.col("d.encoding").alias("encoding"), F.md5(F.col("d.text")).alias("text_md5")
    )


ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", "\u00a0"),
    ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)


def _decoded(expression):
    for name, char in ENTITIES:
        expression = f"replace({expression}, '{name}', '{char}')"
    return expression


HTML_NODES_SQL = (
    "regexp_split_to_array(regexp_replace(html, "
    "'(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->|<![^>]*>', '<x>', 'g'), '<[^>]*>')"
)


HTML_TEXT_SQL = f"""SELECT page_id, array_to_string(list_filter(list_transform({HTML_NODES_SQL},
          lambda t: regexp_replace({_decoded('t')}, '^[{WS}]+|[{WS}]+$', '', 'g')), lambda t: t <> ''), chr(10)) AS text
        FROM pages"""


@query("html_text", HTML_TEXT_SQL)
def html_text(spark, folder):
    pages = bounded_batches(dealt(read_table(spark, folder, "pages")))
    node_text = markup.html_to_text(F.encode("html", "UTF-8"))["text"]
    return pages.select("page_id", node_text.alias("text"))


@query(
    "html_title",
    f"""SELECT page_id, {_decoded("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title FROM pages""",
)
def html_title(spark, folder):
    pages = bounded_batches(dealt(read_table(spark, folder, "pages")))
    return pages.select("page_id", markup.html_to_text(F.encode("html", "UTF-8"))["title"].alias("title"))


# Every construct the renderer covers, around the plain words of a document: its marks
# are taken out first, so that what is expected can be written down.
MARKDOWN = inputs.Derived(
    "documents",
    {
        "document_id": inputs.ID,
        "source": "source",
        "lang": "lang",
        "body": "translate(text, '*#_&<>[]`+=-', '')",
        "md": (
            "concat(source, '\n=====\n\nPart\n---\n\n## About ', lang, ' ##\n\n![logo](http://x/y.png) See [the ', lang, "
            "' page](http://x/', source, ') or <http://x/z>.\n\n- first *item* here\n+ __second__ item\n\n***\n- - -\n\n', "
            "'a &amp; b &lt;c&gt; &quot;d&quot; <b>bold</b> <i>lean</i> ***both*** <!-- hidden\nnote --> `x`\n\n', "
            "'```\nfenced words\n```\n\n[ref]: http://x/ref\n\n', translate(text, '*#_&<>[]`+=-', ''))"
        ),
    },
)
MARKDOWN_TOKENS_SQL = words(
    "concat('# ', source, ' ## Part ## About ', lang, ' See the ', lang, ' page or http://x/z. * first _item_ here * **second** item ', "
    "'* * * * * * a & b <c> \"d\" **bold** _lean_ **_both_** `x` `fenced words` ', body)"
)


@query(
    "markdown_text",
    f"SELECT document_id, md5(array_to_string({MARKDOWN_TOKENS_SQL}, ' ')) AS tokens_md5, "
    f"CAST(len({MARKDOWN_TOKENS_SQL}) AS INT) AS n_tokens FROM {MARKDOWN.sql}",
)
def markdown_text(spark, folder):
    tokens = MARKDOWN.frame(spark, folder, spread_out=True).select(
        "document_id", text.words(markup.markdown_to_text(F.col("md"))).alias("tokens")
    )
    return tokens.select(
        "document_id",
        F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
        F.size("tokens").alias("n_tokens"),
    )


def _typed_pages(spark, folder):
    """Stored pages under every declared content type: one object per event."""
    events_ = events.with_content_type(inputs.EVENTS.frame(spark, folder))
    found, missing = joins.fetch_objects(events_, inputs.OBJECTS.frame(spark, folder))
    return found, missing


INFERRED_EVENTS_SQL = f"""(SELECT * REPLACE (coalesce(nullif(content_type, ''), {GUESS_SQL.format(p='s3_path')}) AS content_type)
                           FROM {inputs.EVENTS.sql})"""
READABLE_SQL = "('txt', 'html', 'md')"


@query(
    "extract_dispatch",
    f"""SELECT document_id, {READER_SQL} AS reader,
               coalesce({READER_SQL} IN {READABLE_SQL}, false) AS extracted
        FROM {INFERRED_EVENTS_SQL} e JOIN {inputs.OBJECTS.sql} o ON e.s3_path = o.path""",
)
def extract_dispatch(spark, folder):
    found, _ = _typed_pages(spark, folder)
    done = extraction.extract_text(found)
    return done.select("document_id", "reader", F.col("error").isNull().alias("extracted"))


@query(
    "event_object_join",
    f"""SELECT document_id, e.s3_path, CAST(octet_length(content) AS INT) AS content_length,
               sha256(content) AS content_hash, CASE WHEN o.path IS NULL THEN 's3_download' END AS stage
        FROM {inputs.EVENTS.sql} e LEFT JOIN {inputs.OBJECTS.sql} o ON e.s3_path = o.path""",
)
def event_object_join(spark, folder):
    found, missing = joins.fetch_objects(
        inputs.EVENTS.frame(spark, folder), inputs.OBJECTS.frame(spark, folder)
    )
    return found.select(
        "document_id",
        "s3_path",
        F.octet_length("content").alias("content_length"),
        F.sha2("content", 256).alias("content_hash"),
        F.lit(None).cast("string").alias("stage"),
    ).unionByName(missing.select("document_id", "s3_path", "stage"), allowMissingColumns=True)


@query(
    "missing_objects",
    f"""SELECT document_id, s3_path FROM {inputs.FILED_DOCUMENTS.sql}
        WHERE s3_path NOT IN (SELECT path FROM {inputs.LISTING.sql})""",
)
def missing_objects(spark, folder):
    gone = joins.missing_objects(
        inputs.FILED_DOCUMENTS.frame(spark, folder), inputs.LISTING.frame(spark, folder)
    )
    return gone.select("document_id", "s3_path")


@query(
    "stage_errors",
    f"""SELECT stage, count(*) AS n_errors FROM (
          SELECT CASE WHEN coalesce(company_id, '') = '' OR coalesce(e.s3_path, '') = ''
                        OR coalesce(content_type, '') = '' THEN 'validation'
                      WHEN o.path IS NULL THEN 's3_download'
                      WHEN coalesce({READER_SQL} NOT IN {READABLE_SQL}, true) THEN 'unknown' END AS stage
          FROM {INFERRED_EVENTS_SQL} e LEFT JOIN {inputs.OBJECTS.sql} o ON e.s3_path = o.path)
        WHERE stage IS NOT NULL GROUP BY stage""",
)
def stage_errors(spark, folder):
    """Every failing event ends in one stage: validation, download or extraction."""
    valid, invalid = events.validate(inputs.EVENTS.frame(spark, folder))
    found, missing = joins.fetch_objects(valid, inputs.OBJECTS.frame(spark, folder))
    _, dead = extraction.split_results(extraction.extract_text(found))
    stages = invalid.select("stage").unionByName(missing.select("stage")).unionByName(dead.select("stage"))
    return stages.groupBy("stage").agg(F.count(F.lit(1)).alias("n_errors"))
