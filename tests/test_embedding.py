import math

import pytest
from pyspark.sql import functions as F

from sheafline.operators import embedding, search
from sheafline.operators.embedding import Retry, RetryableError

SCHEMA = "chunk_id STRING, document_id STRING, company_id STRING, text STRING"


def chunks(spark, texts):
    return spark.createDataFrame([(f"c{i}", "d", "t", x) for i, x in enumerate(texts)], SCHEMA)


def test_default_model_is_deterministic_and_unit_length(spark):
    df = chunks(spark, ["a b a", "b a a", "c", None, ""])
    rows = {r.chunk_id: r for r in embedding.embed_chunks(df, 32).collect()}
    assert set(rows) == {"c0", "c1", "c2", "c4"}
    assert rows["c0"].vector == rows["c1"].vector != rows["c2"].vector
    assert all(len(r.vector) == 32 for r in rows.values())
    assert math.isclose(sum(x * x for x in rows["c0"].vector), 1.0, rel_tol=1e-6)
    assert rows["c4"].vector == [0.0] * 32
    assert set(rows["c0"].asDict()) == {"chunk_id", "document_id", "company_id", "vector"}


def test_messages(spark):
    values = [
        '{"chunk_id":"1","document_id":"d","company_id":"t","text":"a b"}',
        '{"chunk_id":"2","document_id":"d","text":"a"}',
        '{"chunk_id":"3","document_id":"d","company_id":null,"text":"a"}',
        '{"chunk_id":"4","document_id":"d","company_id":"t","text":null}',
        '{"chunk_id":"5"}',
        "broken",
    ]
    df = spark.createDataFrame([(v,) for v in values], "value STRING")
    records, dead = embedding.embed_messages(df, 8)
    assert {r.chunk_id: r.company_id for r in records.collect()} == {"1": "t", "2": "unknown", "3": None}
    assert {r.value: r.reason for r in dead.collect()} == {values[3]: "no_text", values[4]: "no_text", "broken": "invalid_json"}


def test_plugged_in_model_sees_batches_and_keeps_pairing(spark):
    def factory():
        return lambda texts: [[float(len(t)), float(len(texts))] for t in texts]

    df = chunks(spark, ["x" * i for i in range(1, 8)]).coalesce(1)
    rows = embedding.embed_with(df, factory, dimension=2, batch_size=3).collect()
    assert [r.vector[0] for r in sorted(rows, key=lambda r: r.chunk_id)] == [1, 2, 3, 4, 5, 6, 7]
    assert sorted(r.vector[1] for r in rows) == [1, 3, 3, 3, 3, 3, 3]
    assert all(r.error is None for r in rows)


def test_failures_become_error_rows(spark):
    def short():
        return lambda texts: [[0.0]] * (len(texts) - 1)

    def failing():
        def run(texts):
            if "bad" in texts:
                raise RuntimeError("model refused")
            return [[1.0, 2.0]] * len(texts)

        return run

    df = chunks(spark, ["ok", "bad", "ok"]).coalesce(1)
    rows = embedding.embed_with(df, short).collect()
    assert len(rows) == 3 and all("expected 3 vectors, got 2" in r.error and r.vector is None for r in rows)
    rows = {r.chunk_id: r for r in embedding.embed_with(df, failing, batch_size=1).collect()}
    assert rows["c1"].error == "RuntimeError: model refused" and rows["c0"].vector == [1.0, 2.0]
    rows = embedding.embed_with(df, failing, dimension=3, batch_size=1).collect()
    assert sorted(r.error for r in rows)[-1] == "dimension 2, expected 3"


def test_retry_is_bounded_and_selective():
    waits, calls = [], []

    def flaky(fail, kind):
        def run(_):
            calls.append(1)
            if len(calls) <= fail:
                raise kind("no")
            return "done"

        return run

    retry = Retry(sleep=waits.append)
    assert retry.call(flaky(3, RetryableError), 0) == "done" and waits == [2.0, 2.0, 4.0]
    calls.clear(), waits.clear()
    with pytest.raises(RetryableError):
        retry.call(flaky(9, RetryableError), 0)
    assert len(calls) == 4
    calls.clear(), waits.clear()
    with pytest.raises(ValueError):
        retry.call(flaky(9, ValueError), 0)
    assert len(calls) == 1 and not waits
    assert Retry(retries=9).wait(9) == 10.0


def test_dimension_check_and_model_info(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0]), ("c", None)], "chunk_id STRING, vector ARRAY<FLOAT>")
    good, bad = embedding.split_by_dimension(df, 2)
    assert [r.chunk_id for r in good.collect()] == ["a"]
    assert {r.chunk_id: r.dimension for r in bad.collect()} == {"b": 1, "c": 0}
    row = embedding.with_model_info(df, "m", 2).first()
    assert (row.model_name, row.model_dimension) == ("m", 2)


def test_tenant_topk_is_scoped_and_ordered(spark):
    df = spark.createDataFrame(
        [("a", "t", [1.0, 0.0]), ("b", "t", [1.0, 1.0]), ("c", "t", [2.0, 0.0]), ("d", "t", [0.0, 0.0]), ("e", "u", [1.0, 0.0])],
        "chunk_id STRING, company_id STRING, vector ARRAY<FLOAT>",
    ).withColumn("document_id", F.lit("d"))
    rows = search.tenant_topk(df, "t", [1.0, 0.0], 3).collect()
    assert [r.chunk_id for r in rows] == ["a", "c", "b"]
    assert math.isclose(rows[2].score, 0.5**0.5)
