"""The queries of this subpackage on the given tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (
    conversations, decontaminate, hard_negatives, langid, licenses, ngram_join, ngram_lm, packing,
    quality, secret_scan, simhash, token_counts, url_filter,
)
from .tables import table

#: The vocabulary file that the token queries read, on all machines at the same place.
TOKENIZER_FILE = "byte_bpe_50k.json"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER_FILE))


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op7_quality_rules")
def op7_quality_rules(spark, sf):
    docs, labels = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "labels")
    rows = quality.quality_rules(docs, labels)
    return rows.select("doc_id", *quality.COUNTS, "base_failed", "kept", "score")


@query("op9_simhash")
def op9_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents", "doc_id", "text"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_words(column: str) -> str:
    folded = f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({folded}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op2_decontaminate",
    f"""WITH d AS (SELECT doc_id, {_sql_words("text")} AS w FROM documents),
    b AS (SELECT item_id, {_sql_words("text")} AS w FROM benchmark),
    sized AS (SELECT *, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win
      FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
    places AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    hits AS (SELECT doc_id, item_id, s, n FROM places JOIN windows USING (n, win)),
    marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
    listed AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
      coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN listed USING (doc_id)""",
)
def op2_decontaminate(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf, "benchmark"))
    return decontaminate.judged(found).drop("row", "items")


def _sql_spans(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, source, lang, {rank} AS rank, '{kind}' AS kind, value,
        pos - length(whole) AS a, pos AS b FROM (
      SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id ORDER BY i) AS pos
      FROM (SELECT doc_id, source, lang, i, g[i] AS gap, w[i] AS whole, v[i] AS value
        FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM (
          SELECT doc_id, source, lang, regexp_split_to_array(text, '{p}') AS g,
            regexp_extract_all(text, '{p}', 0) AS w, regexp_extract_all(text, '{p}', {group}) AS v
          FROM documents)))) WHERE length(value) >= {least}"""


_ALL_KINDS = enumerate(secret_scan.BASE + secret_scan.ADDED)
_SQL_SPANS = " UNION ALL ".join(_sql_spans(i, *k) for i, k in _ALL_KINDS)
_SPAN_LIST = "string_agg(kind || ':' || a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a, rank)"


@query(
    "op5_secret_scan",
    f"""WITH s AS ({_SQL_SPANS}),
    owners AS (SELECT value, count(DISTINCT source) AS n_owners FROM s GROUP BY value),
    judged AS (SELECT s.*, n_owners, n_owners <= {secret_scan.MAX_OWNERS} AND
      len(list_distinct(string_split(value, ''))) >= {secret_scan.MIN_CHARACTERS} AS live
      FROM s JOIN owners USING (value)),
    per AS (SELECT doc_id, count_if(rank = 0) AS n_assign, count_if(rank = 1) AS n_access,
      count_if(rank = 2) AS n_hex, {_SPAN_LIST} FILTER (rank < 3) AS base,
      {_SPAN_LIST} FILTER (rank < 3 OR live) AS spans, count_if(live) AS n_live,
      count_if(n_owners > {secret_scan.MAX_OWNERS}) AS n_copied
      FROM judged GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign,
      coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
      coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_copied, 0)::BIGINT AS n_copied
    FROM documents LEFT JOIN per USING (doc_id)""",
)
def op5_secret_scan(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    repo = F.concat_ws("/", "source", "lang")
    return secret_scan.secret_scan(docs, "doc_id", "text", F.col("source"), repo)


@query("op3_token_counts")
def op3_token_counts(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    return token_counts.token_counts(docs, tokenizer_path())


@query("op8_packing")
def op8_packing(spark, sf):
    return packing.packed(table(spark, sf, "documents", "doc_id", "text"), tokenizer_path())


def document_path():
    """Invented paths, as the documents have none: a third of them lie under the source, a
    third under its language, a third in folders of a thousand ids below that."""
    depth = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3))
    folder = F.floor(F.col("doc_id") / 1000).cast("string")
    return F.concat_ws(
        "/", "source", F.when(depth >= 1, F.col("lang")), F.when(depth == 2, folder),
        F.col("doc_id").cast("string"),
    )


#: A text of at most so many characters that has a notice counts as a licence file.
LICENSE_FILE_CHARS = 600


@query("op1_license_scan")
def op1_license_scan(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    return licenses.license_scan(
        docs, F.col("doc_id"), F.col("text"), document_path(),
        F.length("text") <= LICENSE_FILE_CHARS,
    )


@query("op10_langid")
def op10_langid(spark, sf):
    return langid.identify(table(spark, sf, "documents", "doc_id", "text", "lang"))


@query("op4_ngram_lm")
def op4_ngram_lm(spark, sf):
    return ngram_lm.lm_scores(table(spark, sf, "documents", "doc_id", "text"))


@query("op6_url_filter")
def op6_url_filter(spark, sf):
    return url_filter.filter_urls(table(spark, sf, "pages", "page_id", "url", "html"))


@query("op11_conversations")
def op11_conversations(spark, sf):
    rows = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    return conversations.repair_digest(conversations.damage(rows), rows)


@query(
    "op12_hard_negatives",
    """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
      list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT * FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
    n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id,
      p.score AS positive_score, s.score AS negative_score,
      row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
      AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score,
      negative_score FROM n WHERE rank <= 5""",
)
def op12_hard_negatives(spark, sf):
    rows = table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(
        rows, "vec_id", "embedding", label, F.col("vec_id") % 100 == 0
    )


_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"


@query(
    "op13_ngram_jaccard",
    f"""WITH RECURSIVE d AS (SELECT doc_id,
      regexp_extract_all({_FOLDED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i
        FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
    reach AS (SELECT doc_id, doc_id AS other FROM d
      UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
    c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
    FROM c LEFT JOIN n USING (doc_id)""",
)
def op13_ngram_jaccard(spark, sf):
    return ngram_join.jaccard_components(table(spark, sf, "documents", "doc_id", "text"))
