"""TF-IDF weights, lexical and dense retrieval, recall, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import dense as dn
from ..operators import retrieval as rt
from ..plans.sizing import fits_broadcast
from ..plans.staging import stage_table
from ..sources.tables import documents, table
from .base import query, r6, sql_tokens

K = 10

INDEX_CTE = f"""
corpus AS (SELECT doc_id, source AS title, source || '. ' || text AS text FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest({sql_tokens('text')}) AS term FROM corpus) GROUP BY ALL),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM corpus)) / (1 + count(*))::DOUBLE) + 1 AS idf
  FROM tf GROUP BY term),
raw AS (SELECT doc_id, tf.term, tf, tf * idf AS w FROM tf JOIN idf ON tf.term = idf.term),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY doc_id),
weights AS (SELECT raw.doc_id, term, tf, w / norm AS weight
  FROM raw JOIN norms ON raw.doc_id = norms.doc_id)
"""

TOPK_CTE = f"""
q AS (SELECT item_id AS query_id, text AS query FROM benchmark),
qtf AS (SELECT query_id, term, count(*) AS tf FROM (
  SELECT query_id, unnest({sql_tokens('query')}) AS term FROM q) GROUP BY ALL),
qraw AS (SELECT query_id, qtf.term, tf * idf AS w FROM qtf JOIN idf ON qtf.term = idf.term),
qnorm AS (SELECT query_id, sqrt(sum(w * w)) AS norm FROM qraw GROUP BY query_id),
qw AS (SELECT qraw.query_id, term, w / norm AS weight
  FROM qraw JOIN qnorm ON qraw.query_id = qnorm.query_id),
hit AS (SELECT query_id, doc_id, sum(qw.weight * weights.weight) AS score
  FROM qw JOIN weights ON qw.term = weights.term GROUP BY ALL),
every AS (SELECT q.query_id, c.doc_id, coalesce(hit.score, 0.0) AS score
  FROM q CROSS JOIN corpus c
  LEFT JOIN hit ON hit.query_id = q.query_id AND hit.doc_id = c.doc_id),
topk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id
  ORDER BY round(score, 9) DESC, doc_id)::INT AS rank FROM every) WHERE rank <= {K})
"""


def corpus(spark, sf):
    docs = documents(spark, sf, "doc_id", "source", "text")
    return rt.corpus(docs, "source", "text").withColumnRenamed("source", "title")


def queries(spark, sf):
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def ranked(spark, sf, k):
    return rt.retrieve(rt.build_index(corpus(spark, sf)), queries(spark, sf), k)


@query(
    "tfidf_weights",
    f"""WITH {INDEX_CTE} SELECT doc_id, term, tf, round(weight, 6) AS weight FROM weights""",
)
def tfidf_weights(spark, sf):
    index = rt.build_index(corpus(spark, sf))
    return index.postings.select("doc_id", "term", "tf", r6("weight"))


@query(
    "retrieve_topk",
    f"""WITH {INDEX_CTE}, {TOPK_CTE}
    SELECT query_id, rank, doc_id, round(score, 6) AS score FROM topk""",
)
def retrieve_topk(spark, sf):
    return ranked(spark, sf, K).select("query_id", "rank", "doc_id", r6("score"))


GOLD_CTE = f"""
gold AS (SELECT q.query_id, c.doc_id AS expected FROM q CROSS JOIN documents c
  WHERE contains(c.text, q.query))
"""


def gold(spark, sf, df):
    """Documents that hold a query text word for word.

    Each query is looked up by its rarest inner token, which any such document must
    contain, and only those documents are compared in full. ``df(term, df)`` tells
    how rare a token is. A query without an inner token is compared with every text.
    """
    q = queries(spark, sf).withColumn("_t", tx.tokens(F.col("query")))
    inner = q.where(F.size("_t") > 2).select(
        "query_id",
        "query",
        F.explode(F.array_distinct(F.slice("_t", 2, F.size("_t") - 2))).alias("term"),
    )
    docs = documents(spark, sf, "doc_id", "text")
    anchor = (
        inner.join(df.select("term", "df"), "term", "left")
        .groupBy("query_id")
        .agg(
            F.min_by("term", F.struct(F.coalesce("df", F.lit(0)), F.col("term"))).alias("term"),
            F.first("query").alias("query"),
        )
    )
    tokens = docs.select(
        "doc_id", F.explode(F.array_distinct(tx.tokens(F.col("text")))).alias("term")
    )
    anchor = stage_table(anchor, "anchors")
    anchor = F.broadcast(anchor) if fits_broadcast(anchor) else anchor
    candidates = stage_table(tokens.join(anchor, "term").select("doc_id", "query_id", "query"), "candidates")
    candidates = F.broadcast(candidates) if fits_broadcast(candidates) else candidates
    holds = F.contains("text", "query")
    long = candidates.join(docs, "doc_id").where(holds)
    short = q.where(F.coalesce(F.size("_t"), F.lit(0)) <= 2).select("query_id", "query")
    short = stage_table(short, "short-queries")
    short = F.broadcast(short) if fits_broadcast(short) else short
    found = long.select("query_id", "doc_id").unionByName(
        docs.join(short, holds).select("query_id", "doc_id")
    )
    return found.withColumnRenamed("doc_id", "expected")


@query(
    "recall_at_k",
    f"""WITH {INDEX_CTE}, {TOPK_CTE}, {GOLD_CTE},
    best AS (SELECT gold.query_id, min(rank) AS best FROM gold
      LEFT JOIN topk ON topk.query_id = gold.query_id AND topk.doc_id = gold.expected
      GROUP BY gold.query_id)
    SELECT k::INT AS k, round(avg(coalesce((best <= k)::INT, 0)), 6) AS recall
    FROM best, (SELECT unnest([1, 3, 5, {K}]) AS k) GROUP BY k""",
)
def recall_at_k(spark, sf):
    index = rt.build_index(corpus(spark, sf))
    top = rt.retrieve(index, queries(spark, sf), K)
    out = rt.recall_at_k(top, gold(spark, sf, index.idf), (1, 3, 5, K))
    return out.select("k", r6("recall"))


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query(
    "rag_prompt",
    f"""WITH {INDEX_CTE}, {TOPK_CTE},
    src AS (SELECT query_id, string_agg('[' || rank || '] (' || topk.doc_id || ') ' ||
        title || ' — ' || text, chr(10) || chr(10) ORDER BY rank) AS sources
      FROM topk JOIN corpus ON topk.doc_id = corpus.doc_id WHERE rank <= 2 GROUP BY query_id)
    SELECT src.query_id, {_lit(rt.PROMPT_HEAD)} || {_lit(rt.PROMPT_SOURCES)} || sources ||
      {_lit(rt.PROMPT_QUERY)} || query || chr(10) AS prompt
    FROM src JOIN q ON src.query_id = q.query_id""",
)
def rag_prompt(spark, sf):
    docs = corpus(spark, sf)
    return rt.prompts(ranked(spark, sf, 2), docs, queries(spark, sf))


def centroids(spark, sf):
    """Mean vector per label: one query for each group of embeddings."""
    dims = table(spark, sf, "embeddings", "label", "embedding").select(
        "label", F.posexplode("embedding").alias("i", "x")
    )
    return (
        dims.groupBy("label", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("m"))
        .groupBy(F.col("label").alias("query_id"))
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]
            ).alias("embedding")
        )
    )


@query(
    "dense_topk",
    """WITH d AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v
      FROM embeddings),
    c AS (SELECT label, i, avg(v[i]) AS m
      FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM d) GROUP BY label, i),
    q AS (SELECT label AS query_id, list(m ORDER BY i) AS q FROM c GROUP BY label),
    s AS (SELECT query_id, vec_id, list_cosine_similarity(q, v) AS score FROM q CROSS JOIN d)
    SELECT query_id, rank, vec_id, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id
        ORDER BY round(score, 9) DESC, vec_id)::INT AS rank FROM s) WHERE rank <= 5""",
)
def dense_topk(spark, sf):
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding")
    return dn.dense_topk(vectors, centroids(spark, sf), 5).select(
        "query_id", "rank", "vec_id", r6("score")
    )
