"""Embedding and similarity queries."""

from pyspark.sql import functions as F

from sheafline.functions import vectors
from sheafline.operators import embedding, search
from sheafline.plans import inputs
from sheafline.plans.registry import query
from sheafline.plans.sqltext import chunk_id, chunk_rows
from sheafline.plans.text import chunks

DIMENSION = 256
STORED_DIMENSION = 64
TOP_K = 10
# Fixed query vector and tenant of the similarity report.
QUERY_VECTOR = [((i * 37) % STORED_DIMENSION) / STORED_DIMENSION - 0.5 for i in range(STORED_DIMENSION)]
QUERY_SQL = f"list_transform(range({STORED_DIMENSION}), lambda i: ((i * 37) % {STORED_DIMENSION}) / {STORED_DIMENSION}.0::DOUBLE - 0.5)"
DOUBLES_SQL = "CAST(vector AS DOUBLE[])"
TENANT = "3"


def vectors_sql(rows, keep, dimension=DIMENSION):
    """SQL text: ``keep`` columns of ``rows`` (with a unique row_key and text) and the word-count vector."""
    place = f"CAST(CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % {dimension} AS INTEGER)"
    return f"""(WITH given AS (SELECT * FROM {rows}),
        counted AS (SELECT row_key, {place} AS place, count(*) AS n
            FROM (SELECT row_key, unnest(list_filter(string_split(text, ' '), lambda w: w <> '')) AS word FROM given) GROUP BY ALL),
        sized AS (SELECT row_key, map(list(place), list(n)) AS counts, sqrt(sum(n * n)) AS length FROM counted GROUP BY row_key)
        SELECT {keep}, list_transform(range({dimension}),
            lambda i: CAST(coalesce(counts[CAST(i AS INTEGER)] / length, 0) AS FLOAT)) AS vector
        FROM given LEFT JOIN sized USING (row_key))"""


CHUNK_ROWS_SQL = f"""(SELECT *, {chunk_id()} AS row_key
                      FROM {chunk_rows(inputs.DOCUMENT_TEXT.sql, 1000, 200, 'document_id, company_id')})"""


@query("embed_chunks", f"SELECT row_key AS chunk_id, * EXCLUDE row_key FROM {vectors_sql(CHUNK_ROWS_SQL, 'row_key, document_id, company_id')}")
def embed_chunks(spark, folder):
    return embedding.embed_chunks(chunks(spark, folder), DIMENSION)


# Messages as the embedding consumer meets them: whole, without tenant, with a null
# tenant, without text, with a null text, no object, cut off, missing.
_SHAPE = "(conv_id + turn) % 8"
_WORDS = "regexp_replace(text, '[^A-Za-z ]', ' '{})"
_TAIL = "concat(',\"document_id\":\"', conv_id, '\",\"text\":\"', {}, '\"}}')"


def _message(words):
    tail = _TAIL.format(words)
    head = "concat('{\"chunk_id\":\"', conv_id, '/', turn, '\"')"
    return (
        f"CASE {_SHAPE} WHEN 1 THEN concat({head}, {tail}) WHEN 2 THEN concat({head}, ',\"company_id\":null', {tail}) "
        f"WHEN 3 THEN concat({head}, '}}') WHEN 4 THEN concat({head}, ',\"text\":null}}') "
        f"WHEN 5 THEN concat('[', {head}, ']') WHEN 6 THEN {head} WHEN 7 THEN CAST(NULL AS STRING) "
        f"ELSE concat({head}, ',\"company_id\":\"', role, '\"', {tail}) END"
    )


CHUNK_MESSAGES = inputs.Derived(
    "conversations",
    {
        "shape": _SHAPE,
        "chunk_id": "concat(conv_id, '/', turn)",
        "document_id": "CAST(conv_id AS STRING)",
        "role": "role",
        "text": tuple(_WORDS.format(g) for g in ("", ", 'g'")),
        "value": tuple(_message(_WORDS.format(g)) for g in ("", ", 'g'")),
    },
)
_SENT_SQL = f"""(SELECT chunk_id AS row_key, document_id, text,
                        CASE shape WHEN 1 THEN 'unknown' WHEN 2 THEN NULL ELSE role END AS company_id
                 FROM {CHUNK_MESSAGES.sql} WHERE shape IN (0, 1, 2))"""


@query(
    "embed_messages",
    f"""SELECT row_key AS chunk_id, document_id, company_id, vector, CAST(NULL AS VARCHAR) AS reason
        FROM {vectors_sql(_SENT_SQL, 'row_key, document_id, company_id', 16)}
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, CASE WHEN shape IN (3, 4) THEN 'no_text' ELSE 'invalid_json' END
        FROM {CHUNK_MESSAGES.sql} WHERE shape > 2""",
)
def embed_messages(spark, folder):
    """Messages to vectors; those without one are kept with the reason."""
    records, dead = embedding.embed_messages(CHUNK_MESSAGES.frame(spark, folder).select("value"), 16)
    kept = records.withColumn("reason", F.lit(None).cast("string"))
    return kept.unionByName(dead.select("reason"), allowMissingColumns=True)


@query(
    "embedding_contract",
    f"""SELECT {chunk_id()} AS chunk_id, document_id, company_id, 'hashed-words' AS model_name,
               {DIMENSION} AS dimension, true AS dimension_ok, 1.0::DOUBLE AS vector_norm
        FROM {chunk_rows(inputs.DOCUMENT_TEXT.sql, 1000, 200, 'document_id, company_id')}""",
)
def embedding_contract(spark, folder):
    """What every embedded chunk must satisfy: one unit vector of the model's dimension."""
    made = embedding.embed_chunks(chunks(spark, folder), DIMENSION)
    checked = embedding.check_dimension(
        embedding.with_model_info(made, dimension=DIMENSION), DIMENSION
    )
    return checked.select(
        "chunk_id",
        "document_id",
        "company_id",
        "model_name",
        "dimension",
        "dimension_ok",
        F.round(vectors.norm(F.col("vector")), 3).alias("vector_norm"),
    )


@query(
    "vector_dim_check",
    f"""SELECT chunk_id, CASE tenant WHEN '3' THEN 63 WHEN '7' THEN 0 ELSE {STORED_DIMENSION} END AS dimension,
               tenant NOT IN ('3', '7') AS dimension_ok FROM {inputs.VECTORS.sql}""",
)
def vector_dim_check(spark, folder):
    """Stored vectors, of which two tenants lost their last value or all of it."""
    damaged = inputs.VECTORS.frame(spark, folder).withColumn(
        "vector",
        F.when(F.col("tenant") == "3", F.slice("vector", 1, STORED_DIMENSION - 1)).when(
            F.col("tenant") != "7", F.col("vector")
        ),
    )
    return embedding.check_dimension(damaged, STORED_DIMENSION).select(
        "chunk_id", "dimension", "dimension_ok"
    )


@query(
    "tenant_topk",
    f"""SELECT chunk_id, company_id, round(score, 6) AS score FROM (
          SELECT chunk_id, tenant AS company_id, list_cosine_similarity({DOUBLES_SQL}, {QUERY_SQL}) AS score
          FROM (SELECT * FROM {inputs.DAMAGED_VECTORS.sql} WHERE tenant = '{TENANT}' AND len(vector) = {STORED_DIMENSION}))
        ORDER BY score DESC, chunk_id LIMIT {TOP_K}""",
)
def tenant_topk(spark, folder):
    table = inputs.read_table(spark, folder, "embeddings")
    named = table.selectExpr(*inputs.DAMAGED_VECTORS.expressions, "label").drop("company_id")
    # The stored column itself is compared, so the scan skips what no row of the tenant can be in.
    best = search.tenant_topk(named.withColumnRenamed("label", "company_id"), int(TENANT), QUERY_VECTOR, TOP_K)
    return best.select("chunk_id", F.col("company_id").cast("string"), F.round("score", 6).alias("score"))
