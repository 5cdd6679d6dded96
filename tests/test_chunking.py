import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheafline.functions import text
from sheafline.operators import chunking
from sheafline.operators.chunking import ChunkSpec, chunk_records, chunk_text, document_summary

WHITESPACE = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def model(value, size, overlap):
    """Plain statement of the windows: starts every size-overlap words until one reaches the end."""
    tokens = value.split()
    if not tokens:
        return []
    starts = range(0, max(1, len(tokens) - overlap), size - overlap)
    return [" ".join(tokens[s : s + size]) for s in starts]


def run(spark, texts, spec):
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    out = [[] for _ in texts]
    for row in chunk_text(df, spec).orderBy("id", "chunk_index").collect():
        assert row.chunk_index == len(out[row.id])
        out[row.id].append(row.text)
    return out


@pytest.mark.parametrize("n, count", [(0, 0), (1, 1), (1000, 1), (1001, 2), (1800, 2), (1801, 3)])
def test_counts_at_default_size(spark, n, count):
    got = run(spark, [" ".join(["w"] * n)], ChunkSpec())[0]
    assert len(got) == count


def test_every_whitespace_character_splits(spark):
    # lone surrogates cannot be whitespace, so each character can be stored
    value = "".join(f"w{i}{c}" for i, c in enumerate(WHITESPACE))
    df = spark.createDataFrame([(value,)], "t STRING")
    row = df.select(text.words(F.col("t")).alias("w"), text.strip(F.lit("　 a　b\x1c")).alias("s")).first()
    assert row.w == value.split()
    assert row.s == "a　b"


def test_non_whitespace_controls_do_not_split(spark):
    value = "a​b᠎c⁠d\x00e\x08f\x1bg"
    df = spark.createDataFrame([(value,)], "t STRING")
    assert df.select(text.words(F.col("t"))).first()[0] == value.split()


words_and_blanks = st.lists(
    st.tuples(st.text("abcé漢", max_size=3), st.sampled_from(WHITESPACE)), max_size=60
).map(lambda parts: "".join(a + b for a, b in parts))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(words_and_blanks, min_size=1, max_size=20), size=st.integers(1, 9), data=st.data())
def test_matches_model(spark, texts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    got = run(spark, texts, ChunkSpec(size, overlap))
    assert got == [model(t, size, overlap) for t in texts]
    for value, chunks in zip(texts, got):
        n = len(value.split())
        assert len(chunks) == (1 + max(0, math.ceil((n - size) / (size - overlap))) if n else 0)
        rebuilt = [w for i, c in enumerate(chunks) for w in c.split(" ")[overlap if i else 0 :]]
        assert rebuilt == value.split()


@pytest.mark.parametrize("size, overlap", [(0, 0), (-1, 0), (10, -1), (10, 10), (10, 11)])
def test_bad_parameters(size, overlap):
    with pytest.raises(ValueError):
        ChunkSpec(size, overlap)


def paged(spark, pages):
    return spark.createDataFrame(
        [("d", "c", pages)],
        "document_id STRING, company_id STRING, pages ARRAY<STRUCT<page: INT, text: STRING>>",
    )


def test_pages_are_chunked_alone_and_numbered_through(spark):
    df = paged(spark, [(1, "a b c d e"), (2, " \n"), (3, "f g")])
    rows = chunk_records(df, ChunkSpec(3, 1)).orderBy("chunk_index").collect()
    assert [(r.page, r.chunk_index, r.text) for r in rows] == [
        (1, 0, "a b c"),
        (1, 1, "c d e"),
        (3, 2, "f g"),
    ]
    assert len({r.chunk_id for r in rows}) == 3


def test_unpaged_text_gets_the_page_sentinel_and_stable_ids(spark):
    df = paged(spark, [(None, "a b")])
    first, second = (chunk_records(df).first() for _ in range(2))
    assert first.page == -1 and first.chunk_id == second.chunk_id
    random = [chunk_records(df, random_ids=True).first().chunk_id for _ in range(2)]
    assert random[0] != random[1]


def test_summary(spark):
    row = document_summary(paged(spark, [(1, "a b c d e"), (2, " \n"), (3, "f g")]), ChunkSpec(3, 1)).first()
    assert (row.total_pages_extracted, row.raw_text_length_chars, row.num_chunks_generated) == (3, 14, 3)
    plain = document_summary(paged(spark, [(None, "abc")])).first()
    assert plain.total_pages_extracted is None and plain.num_chunks_generated == 1


def test_one_page_equals_plain_text(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "CAST(doc_id AS STRING) document_id", "source company_id", "text"
    )
    pages = docs.selectExpr(
        "document_id", "company_id", "array(named_struct('page', CAST(NULL AS INT), 'text', text)) AS pages"
    )
    columns = ["document_id", "chunk_index", "text"]
    spec = ChunkSpec(30, 7)
    a, b = chunk_text(docs, spec).select(*columns), chunk_records(pages, spec).select(*columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert chunking.chunk_text(docs).count() > 0


def test_plugged_in_chunker(spark):
    df = spark.createDataFrame([(1, "a. b. c"), (2, "  "), (3, "x")], "id INT, text STRING")
    rows = chunking.chunk_with(df, lambda t: t.split(". ")).orderBy("id", "chunk_index").collect()
    assert [(r.id, r.chunk_index, r.text) for r in rows] == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (3, 0, "x")]


def test_chunkers_as_table_functions(spark):
    texts = [(1, "a b c d e"), (2, ""), (3, None), (4, " 　\n"), (5, "one"), (6, "  a b   c ")]
    docs = spark.createDataFrame(texts, "id int, text string")
    for spec in (ChunkSpec(2, 1), ChunkSpec(3, 0), ChunkSpec(10, 2)):
        chunking.register_chunker(spark, "test_chunks", chunking.word_chunker(spec))
        got = spark.sql("SELECT d.id, c.chunk_index, c.text FROM {d} d, LATERAL test_chunks(d.text) c", d=docs)
        want = chunking.chunk_text(docs, spec)
        assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
