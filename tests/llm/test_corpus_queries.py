"""The registered corpus queries, and the stages of the pipeline."""

from collections import Counter

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from sheafline.llm import near_dups, packing, queries, secrets, toxicity
from tests.llm.test_pair_operators import brute_groups
from tests.oracle import compare, connect

COLUMNS = {
    "op1_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op2_secrets": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op3_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op4_vector_duplicates": {"vec_id", "n_links", "component_id", "kept"},
    "op5_top_products": {"query_id", "rank", "vec_id", "score"},
    "op6_mixture": {"doc_id", "size", "source_size", "target", "taken"},
    "op7_packing": {"doc_id", "length", "bucket", "batch", "slot"},
    "op8_near_duplicates": {"doc_id", "n_shingles", "component_id", "kept"},
    "op9_tokens": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op10_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op11_main_text": {"page_id", "url", "text", "n_chars"},
    "op12_hard_negatives": {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"},
    "op13_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, folder, name):
    assert compare(spark, connect(folder), folder, queries.QUERIES[name], queries.ORACLES[name]) is None


def test_queries_are_registered():
    registered = entry_points.queries()
    assert set(COLUMNS) | {"pipeline"} <= set(registered)
    assert set(queries.ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(queries.ORACLES) - {"op13_whitening"}))
def test_query_covers_its_table(spark, folder, name):
    out = queries.QUERIES[name](spark, folder)
    assert COLUMNS[name] <= set(out.columns)
    assert out.select("doc_id").distinct().count() == spark.read.parquet(f"{folder}/documents.parquet").count() == out.count()


def test_whitening_covers_its_table(spark, folder):
    out = queries.QUERIES["op13_whitening"](spark, folder)
    assert COLUMNS["op13_whitening"] <= set(out.columns)
    rows = out.groupBy("vec_id").count().collect()
    assert len(rows) == spark.read.parquet(f"{folder}/embeddings.parquet").count() and {r["count"] for r in rows} == {4}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "secrets", "mixture", "packing"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")

    model = toxicity.fit(docs, labels)
    scores = toxicity.WordValues(model)
    rows = docs.collect()
    clean = stages["toxicity"](spark, docs, folder)
    want = {r["doc_id"] for r, s in zip(rows, scores.score([r["text"] for r in rows])) if s < toxicity.THRESHOLD}
    assert {r["doc_id"] for r in clean.collect()} == want and clean.columns == docs.columns

    single = stages["near_duplicates"](spark, docs, folder)
    groups = brute_groups([(r["doc_id"], r["text"]) for r in rows], near_dups.SHINGLE, near_dups.PERCENT)[1]
    assert {r["doc_id"] for r in single.collect()} == {i for i, c in groups.items() if i == c}

    safe = {r["doc_id"]: r for r in stages["secrets"](spark, docs, folder).collect()}
    for r in rows:
        assert safe[r["doc_id"]]["text"] == secrets.blanked(r["text"], secrets.scan(r["text"]))
        assert safe[r["doc_id"]]["n_chars"] == len(safe[r["doc_id"]]["text"])

    mixed = stages["mixture"](spark, docs, folder)
    assert mixed.columns == docs.columns
    words, sizes = Counter(), {r["doc_id"]: len(r["text"].encode().split()) for r in rows}
    for r in mixed.collect():
        words[r["doc_id"]] += len(r["text"].encode().split())
    assert all(words[i] <= 2 * n for i, n in sizes.items())
    assert sum(words.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.02)

    packed = stages["packing"](spark, docs, folder)
    assert packed.count() == len(rows)
    assert packed.where(f"bucket_length * (slot + 1) > greatest({packing.BATCH_TOKENS}, bucket_length)").isEmpty()


def test_pipeline_runs(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 0 and {"doc_id", "text", "bucket", "batch", "slot"} <= set(out.columns)
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_stages_take_nulls(spark, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, "a b c d e f", None, "s", 11), (2, "a b c d e f", None, "s", 11)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name in ("secrets", "packing"):
            assert out.count() == len(rows)
        else:
            out.collect()
