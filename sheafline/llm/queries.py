"""One query per operator, over whole tables, and the SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.llm import (
    hard_negatives,
    language,
    mixture,
    near_dups,
    packing,
    page_text,
    secrets,
    tokens,
    toxicity,
    vector_dups,
    vector_search,
    warc,
    whitening,
)
from sheafline.llm.common import held_out, tables, word_count
from sheafline.session import shared_folder

QUERIES = {}
ORACLES = {}
VOCABULARY = "byte_bpe_50k.json"


def query(name, oracle=None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op2_secrets")
def op2_secrets(spark, folder):
    found = secrets.digest(secrets.find_secrets(tables(spark, folder, "documents", "doc_id", "text")))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_private_key", "n_signed_token"
    )


@query("op3_toxicity")
def op3_toxicity(spark, folder):
    docs = tables(spark, folder, "documents", "doc_id", "text")
    labels = tables(spark, folder, "labels", "doc_id", "toxic").where(~held_out())
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op9_tokens")
def op9_tokens(spark, folder):
    import public_tokenizers

    definition = tokens.read_definition(public_tokenizers.path(VOCABULARY))
    counted = tokens.count_tokens(tables(spark, folder, "documents", "doc_id", "text"), definition)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op10_language")
def op10_language(spark, folder):
    docs = tables(spark, folder, "documents", "doc_id", "text", "lang")
    return language.identify_own(docs).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected"
    )


@query("op6_mixture")
def op6_mixture(spark, folder):
    return mixture.mix(tables(spark, folder, "documents", "doc_id", "text", "source"))


@query("op7_packing")
def op7_packing(spark, folder):
    docs = tables(spark, folder, "documents", "doc_id", "text").select("doc_id", word_count().alias("words"))
    packed = packing.pack(docs, length=F.col("words"))
    return packed.select("doc_id", "length", "bucket", "bucket_length", "batch", "slot", "padding")


def reachable_sql(pairs, nodes):
    """SQL text: smallest node reachable from each of ``nodes`` (id) over ``pairs`` (a, b)."""
    return f"""edges AS (SELECT a, b FROM ({pairs}) UNION SELECT b, a FROM ({pairs})),
        walk AS (SELECT id AS node, id AS seen FROM ({nodes})
                 UNION SELECT w.node, e.b FROM walk w JOIN edges e ON w.seen = e.a),
        roots AS (SELECT node, min(seen) AS component_id FROM walk GROUP BY node)"""


OP8_SQL = f"""WITH RECURSIVE texts AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
        FROM documents),
    shingles AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s FROM texts),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x
        JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL) p
        JOIN sizes p1 ON p.a = p1.doc_id JOIN sizes p2 ON p.b = p2.doc_id WHERE 100 * c >= 85 * (p1.n + p2.n - c)),
    {reachable_sql("SELECT a, b FROM pairs", "SELECT doc_id AS id FROM documents")}
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d LEFT JOIN sizes z ON d.doc_id = z.doc_id JOIN roots r ON d.doc_id = r.node"""


@query("op8_near_duplicates", OP8_SQL)
def op8_near_duplicates(spark, folder):
    docs = tables(spark, folder, "documents", "doc_id", "text")
    return near_dups.group_near_duplicates(docs, k=3, percent=85).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept"
    )


OP4_SQL = f"""WITH RECURSIVE usable AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
          AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
    pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id < y.vec_id
        AND len(x.x) = len(y.x) WHERE list_cosine_similarity(x.x, y.x) >= 0.98),
    {reachable_sql("SELECT a, b FROM pairs", "SELECT vec_id AS id FROM embeddings")},
    counts AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings e JOIN roots r ON e.vec_id = r.node LEFT JOIN counts c ON e.vec_id = c.a"""


@query("op4_vector_duplicates", OP4_SQL)
def op4_vector_duplicates(spark, folder):
    vectors = tables(spark, folder, "embeddings", "vec_id", "embedding", "label")
    return vector_dups.group_close_vectors(vectors).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept"
    )


OP5_SQL = """WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
               CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
        FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query("op5_top_products", OP5_SQL)
def op5_top_products(spark, folder):
    return vector_search.top_products(tables(spark, folder, "embeddings", "vec_id", "embedding"))


OP1_SQL = """WITH hashed AS (
        SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS hex FROM pages),
    first AS (SELECT hex, octet_length(body) AS n, min(page_id) AS page FROM hashed GROUP BY ALL)
    SELECT h.page_id, CAST(octet_length(h.body) AS BIGINT) AS payload_bytes,
        array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
            (CAST('0x' || substr(h.hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31) AS INTEGER), 1)), '') AS payload_digest,
        CASE WHEN h.page_id = f.page THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN h.page_id <> f.page THEN f.page END AS refers_to
    FROM hashed h JOIN first f ON h.hex = f.hex AND octet_length(h.body) = f.n"""


@query("op1_warc", OP1_SQL)
def op1_warc(spark, folder):
    path = shared_folder(spark, "archives")
    warc.write_archives(tables(spark, folder, "pages", "page_id", "url", "html"), path)
    records = warc.resolve_revisits(warc.read_records(spark, path))
    return records.select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# Reads the one template the table's pages have; the operator knows nothing of it.
OP11_SQL = """WITH cut AS (SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''),
        '<article>(.*)</article>', 1, 's'), '</?(?:p|h1)>') AS parts FROM pages),
    plain AS (SELECT page_id, url, list_transform(parts, lambda b: regexp_replace(regexp_replace(
        replace(replace(b, '<br>', ' '), '<b>', ''), '&quot;?', chr(34), 'g'), '&amp;?', '&', 'g')) AS parts FROM cut),
    blocks AS (SELECT page_id, url, array_to_string(list_filter(list_transform(parts,
        lambda b: trim(regexp_replace(b, '[ \t\r\n]+', ' ', 'g'))), lambda b: b <> ''), chr(10) || chr(10)) AS text FROM plain)
    SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM blocks"""


@query("op11_main_text", OP11_SQL)
def op11_main_text(spark, folder):
    return page_text.extract_main_text(tables(spark, folder, "pages", "page_id", "url", "html"))


OP12_SQL = """WITH whole AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda v: floor(256 * CAST(v AS DOUBLE))) AS x FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
    scored AS (SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
            CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
        FROM whole a JOIN whole c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.x) = len(c.x)),
    positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    ranked AS (SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
            CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
        FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
            AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark, folder):
    vectors = tables(spark, folder, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(vectors.withColumn("label", moved))


@query("op13_whitening")
def op13_whitening(spark, folder):
    whitened = whitening.whiten(tables(spark, folder, "embeddings", "vec_id", "embedding"))
    return whitened.withColumnRenamed("id", "vec_id")
