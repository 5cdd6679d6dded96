import json

import pytest
from pyspark.sql import functions as F

from sheafline.functions import ids, mime, payload, text
from sheafline.operators import events
from sheafline.schemas import CHUNK
from sheafline.sinks.topics import keyed_json, window_result_json


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


TENANT_CASES = [
    ('{"company_id":"a"}', "a"),
    ('{"company_id":7}', "7"),
    ('{"company_id":null}', None),
    ('{"company_id":"a","company_id":"b"}', "b"),
    ('{"company_id":"ñ\\u00e9","x":{"company_id":"no"}}', "ñé"),
    ('{"x":1}', "error_parsing"),
    ("not json", "error_parsing"),
    ('{"company_id":"a"', "error_parsing"),
    ('{"company_id":"a"} tail', "error_parsing"),
    ("[1]", "error_parsing"),
    ('["company_id"]', "error_parsing"),
    ('"company_id"', "error_parsing"),
    ("5", "error_parsing"),
    ("null", "error_parsing"),
    ("", "error_parsing"),
    (None, "error_parsing"),
]


def test_safe_tenant(spark):
    df = spark.createDataFrame(TENANT_CASES, "value STRING, expected STRING")
    rows = df.withColumn("got", payload.safe_tenant(payload.decode(F.col("value")))).collect()
    assert [r.got for r in rows] == [r.expected for r in rows]


def test_large_messages_give_the_same_results(spark, monkeypatch):
    cases = spark.createDataFrame(TENANT_CASES, "value STRING, expected STRING")
    monkeypatch.setattr(payload, "VARIANT_BYTES", -1)
    doc = payload.decode(F.col("value"))
    rows = cases.select("expected", payload.safe_tenant(doc).alias("got"), payload.is_object(doc).alias("object"), "value").collect()
    assert [r.got for r in rows] == [r.expected for r in rows]
    assert [r.object for r in rows] == [r.value is not None and r.value.startswith("{") and r.value.endswith("}") for r in rows]


def test_a_message_above_the_variant_limit_keeps_its_tenant(spark):
    df = spark.range(1).select(F.concat(F.lit('{"company_id":"a","text":"'), F.repeat(F.lit("x"), 17 * 1024**2), F.lit('"}')).alias("value"))
    doc = payload.decode(F.col("value"))
    row = df.select(payload.safe_tenant(doc).alias("t"), F.length(payload.text_field(doc, "text")).alias("n"), payload.is_object(doc).alias("o")).first()
    assert (row.t, row.n, row.o) == ("a", 17 * 1024**2, True)


def plain_tenant(value):
    try:
        found = json.loads(value)
        return str(found["company_id"]) if isinstance(found, dict) else "error_parsing"
    except (ValueError, TypeError, KeyError):
        return "error_parsing"


def test_safe_tenant_agrees_with_a_json_library_on_string_tenants(spark):
    values = [v for v, expected in TENANT_CASES if expected is not None]
    df = spark.createDataFrame([(v,) for v in values], "value STRING")
    got = [r[0] for r in df.select(payload.safe_tenant(payload.decode(F.col("value")))).collect()]
    assert got == [plain_tenant(v) for v in values]


def test_absent_key_gets_default_null_stays(spark):
    df = spark.createDataFrame([('{"x":1}',), ('{"company_id":null}',), ('{"company_id":"a"}',)], "v STRING")
    got = [r[0] for r in df.select(payload.tenant_or(payload.decode(F.col("v")), "unknown")).collect()]
    assert got == ["unknown", None, "a"]


def test_decode_routes_bad_messages(spark):
    df = spark.createDataFrame([('{"text":"t","page":3}', 1), ("[1]", 2), ("{", 3), (None, 4)], "value STRING, offset INT")
    good, bad = events.decode_messages(df, CHUNK)
    assert [(r.offset, r.text, r.page) for r in good.collect()] == [(1, "t", 3)]
    assert {r.offset: r.reason for r in bad.collect()} == {
        2: "not_an_object", 3: "invalid_json", 4: "invalid_json",
    }


@pytest.mark.parametrize(
    "name, expected",
    [("  my   file .pdf ", "my file .pdf"), (" a b\x1f", "a b"), ("", "")],
)
def test_filename(spark, name, expected):
    assert one(spark, text.normalize_filename(F.lit(name))) == expected


@pytest.mark.parametrize(
    "kind, normal, reader",
    [
        (" Text/HTML; charset=utf-8", "text/html", "html"),
        ("\ttext/plain\n;x", "text/plain", "txt"),
        ("application/msword", "application/msword", "docx"),
        ("application/vnd.ms-excel", "application/vnd.ms-excel", "xlsx"),
        ("image/png", "image/png", None),
        ("", "", None),
    ],
)
def test_mime(spark, kind, normal, reader):
    assert one(spark, mime.normalize_mime(F.lit(kind))) == normal
    assert one(spark, mime.reader_for(F.lit(kind))) == reader


@pytest.mark.parametrize(
    "given, path, expected",
    [
        (None, "c/d/notes.md", "text/markdown"),
        ("", "c/d/NOTES.MD", "text/markdown"),
        ("text/plain", "c/d/x.pdf", "text/plain"),
        (None, "c/d/x.pdf", "application/pdf"),
        (None, "c/d.txt/plain", None),
        (None, "c/d/.pdf", None),
        (None, "c/d/a..pdf", "application/pdf"),
        (None, "c/d/a.txt.gz", "text/plain"),
        (None, "c/d/a.tgz", "application/x-tar"),
        (None, "c/d/line\nbreak.html", "text/html"),
        (None, None, None),
    ],
)
def test_infer_type(spark, given, path, expected):
    made = mime.infer_content_type(F.lit(given).cast("string"), F.lit(path).cast("string"))
    assert one(spark, made) == expected


def test_allowlist_is_exact(spark):
    assert one(spark, mime.is_accepted(F.lit("text/plain")))
    assert not one(spark, mime.is_accepted(F.lit("Text/Plain")))
    assert one(spark, mime.is_accepted(F.lit(None).cast("string"))) is False


def test_validation(spark):
    df = spark.createDataFrame(
        [("d", "c", "p.txt", None), ("d", "", "p.txt", "t"), (None, "c", "p.txt", "t"), ("d", "c", "p", None)],
        "document_id STRING, company_id STRING, s3_path STRING, content_type STRING",
    )
    good, bad = events.validate(df)
    assert [r.content_type for r in good.collect()] == ["text/plain"]
    assert [r.stage for r in bad.collect()] == ["validation"] * 3


def test_upload_status(spark):
    df = spark.createDataFrame(
        [("text/plain", True), ("text/plain", False), ("image/png", True), (None, True), ("text/plain", None)],
        "content_type STRING, stored BOOLEAN",
    )
    assert [r.status for r in events.upload_status(df).collect()] == [
        "success", "error_server", "error_client", "error_client", "error_server",
    ]


def test_keyed_json_keeps_nulls_and_unicode(spark):
    df = spark.createDataFrame([("d1", None, 'ñ "q"\n', [0.5])], "document_id STRING, company_id STRING, text STRING, vector ARRAY<FLOAT>")
    row = keyed_json(df).first()
    assert row.key == "d1"
    assert json.loads(row.value) == {"document_id": "d1", "company_id": None, "text": 'ñ "q"\n', "vector": [0.5]}


def test_window_result_json(spark):
    df = spark.createDataFrame([("c", 4)], "company_id STRING, chunk_count LONG")
    row = window_result_json(df).first()
    record = json.loads(row.value)
    assert row.key == "c" and record["company_id"] == "c" and record["chunk_count_30s"] == 4
    assert record["timestamp_utc"] > 1.6e9


def test_chunk_key_depends_on_every_part(spark):
    keys = {
        one(spark, ids.chunk_key(F.lit(d), F.lit(p).cast("int"), F.lit(k)))
        for d, p, k in [("a", None, 0), ("a", None, 1), ("a", 1, 0), ("b", None, 0)]
    }
    assert len(keys) == 4
