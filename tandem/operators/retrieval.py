"""Lexical and dense retrieval: TF-IDF index, exact top-k, prompts, recall."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..plans.sizing import fits_broadcast
from ..plans.skew import frequent_lookup, heavy_keys, salted_join
from ..plans.staging import stage_table


def corpus(df: DataFrame, title: str, text: str) -> DataFrame:
    """Indexed text of a titled document: title, a full stop, then the text."""
    return df.withColumn("text", F.concat_ws(". ", F.col(title), F.col(text)))


def document_frequency(df: DataFrame, text: str = "text", terms=tx.tokens) -> DataFrame:
    """Documents per term. Partial counts leave one row per term and task."""
    return (
        df.select(F.explode(F.array_distinct(terms(F.col(text)))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def idf_table(df: DataFrame, text: str = "text", terms=tx.tokens) -> DataFrame:
    """(term, df, idf) with the smoothed idf ``ln((1 + n) / (1 + df)) + 1``. Staged."""
    n = df.agg(F.count("*")).scalar()
    idf = F.log((n + 1) / (F.col("df") + 1)) + 1
    return stage_table(
        document_frequency(df, text, terms).withColumn("idf", idf), "idf"
    )


def term_counts(df: DataFrame, doc: str, text: str = "text", terms=tx.tokens) -> DataFrame:
    """(doc, term, tf). Texts move once by document; the count itself does not shuffle."""
    return (
        df.select(doc, text)
        .repartition(doc)
        .select(doc, F.explode(terms(F.col(text))).alias("term"))
        .groupBy(doc, "term")
        .agg(F.count("*").alias("tf"))
    )


def weigh(counts: DataFrame, idf: DataFrame, doc: str) -> DataFrame:
    """L2-normalised TF-IDF weights of term counts. Unknown terms drop out.

    With the idf of all terms broadcast, counts stay where their document is. Otherwise the
    counts that met their idf are staged, and the norms come to them.
    """
    w = (F.col("tf") * F.col("idf")).alias("_w")
    square = F.sum(F.col("_w") * F.col("_w"))
    raw = frequent_lookup(counts, idf, "term", F.col(doc), "df").select(doc, "term", "tf", w)
    normed = None
    if not fits_broadcast(idf):
        raw = stage_table(raw, "raw-weights")
        norms = stage_table(raw.groupBy(F.col(doc).alias("_doc")).agg(F.sqrt(square).alias("_norm")), "norms")
        if fits_broadcast(norms):
            normed = raw.join(F.broadcast(norms), F.col(doc).eqNullSafe(F.col("_doc")))
    if normed is None:
        normed = raw.withColumn("_norm", F.sqrt(square.over(Window.partitionBy(doc))))
    return normed.select(
        doc,
        "term",
        "tf",
        F.when(F.col("_norm") > 0, F.col("_w") / F.col("_norm"))
        .otherwise(F.lit(0.0))
        .alias("weight"),
    )


@dataclass(frozen=True)
class LexicalIndex:
    """Postings with unit-length document vectors, idf values and document order."""

    postings: DataFrame
    idf: DataFrame
    documents: DataFrame
    doc: str

    def write(self, path: str) -> None:
        self.postings.write.parquet(f"{path}/postings")
        self.idf.write.parquet(f"{path}/idf")
        self.documents.write.parquet(f"{path}/documents")

    @staticmethod
    def read(spark, path: str, doc: str) -> "LexicalIndex":
        part = lambda name: spark.read.parquet(f"{path}/{name}")
        return LexicalIndex(part("postings"), part("idf"), part("documents"), doc)


def build_index(df: DataFrame, doc: str = "doc_id", text: str = "text") -> LexicalIndex:
    """Index the documents; ``doc`` is unique and gives the tie order."""
    idf = idf_table(df, text)
    return LexicalIndex(weigh(term_counts(df, doc, text), idf, doc), idf, df, doc)


def query_weights(
    index: LexicalIndex, queries: DataFrame, query_id: str, query: str
) -> DataFrame:
    """Unit-length query vectors over the index vocabulary.

    The idf rows a query batch needs are few, so the big side is the idf table:
    it is filtered by the query terms before weights are made.
    """
    counts = term_counts(queries, query_id, query)
    known = index.idf.join(counts.select("term").distinct(), "term", "left_semi")
    raw = counts.join(known, "term").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(query_id)))
    return raw.withColumn("_n", norm).select(
        query_id, "term", (F.col("_w") / F.col("_n")).alias("q_weight"),
        F.col("df"),
    )


def retrieve(
    index: LexicalIndex,
    queries: DataFrame,
    k: int = 3,
    query_id: str = "query_id",
    query: str = "query",
) -> DataFrame:
    """Exact top-k of every query: (query, rank, doc, score).

    Every query gets min(k, n) documents: where fewer than k share a term with it,
    the lowest documents in index order follow with score 0. Ties go to the lower
    document.

    Postings are partitioned by document, so with the query terms broadcast the
    scores add up without a shuffle, and each task passes on only its k best
    documents per query. A query set too large for that is joined by a shuffle on
    the term, with hot terms salted by document.
    """
    doc = index.doc
    q = stage_table(query_weights(index, queries, query_id, query), "query-terms")
    if fits_broadcast(q):
        hits = index.postings.join(F.broadcast(q), "term")
    else:
        terms = q.groupBy("term").agg(F.first("df").alias("df"))
        hot = heavy_keys(terms, "term", "df")
        hits = salted_join(index.postings, q, "term", hot, F.col(doc))
    scores = hits.groupBy(query_id, doc).agg(
        F.sum(F.col("weight") * F.col("q_weight")).alias("score")
    )
    # Rounding far below any meaningful difference makes ties independent of the
    # order in which partial sums arrive.
    best = Window.partitionBy(query_id).orderBy(F.round("score", 9).desc(), doc)
    top = scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    top = stage_table(top, "topk")
    return _pad(top, index.documents, queries, k, query_id, doc)


def _pad(
    top: DataFrame, documents: DataFrame, queries: DataFrame, k: int, query_id: str, doc: str
) -> DataFrame:
    """Fill queries with fewer than k hits from the first documents, at score 0.

    A query short of k hits leaves at least k of the first 2k documents unmatched.
    """
    first = documents.orderBy(doc).select(doc).limit(2 * k)
    candidates = first.agg(F.array_sort(F.collect_list(doc))).scalar()
    have = top.groupBy(query_id).agg(F.count("*").alias("_have"))
    short = (
        queries.select(query_id)
        .join(have, query_id, "left")
        .withColumn("_have", F.coalesce("_have", F.lit(0)))
        .where(F.col("_have") < k)
    )
    filler = (
        short.withColumn(doc, F.explode(candidates))
        .join(top.select(query_id, doc), [query_id, doc], "left_anti")
        .withColumn(
            "_r", F.row_number().over(Window.partitionBy(query_id).orderBy(doc))
        )
        .select(
            query_id,
            doc,
            F.lit(0.0).alias("score"),
            (F.col("_have") + F.col("_r")).cast("int").alias("rank"),
        )
        .where(F.col("rank") <= k)
    )
    return top.select(query_id, doc, "score", "rank").unionByName(filler)


def recall_at_k(
    ranked: DataFrame,
    gold: DataFrame,
    ks: tuple[int, ...] = (1, 3),
    query_id: str = "query_id",
    doc: str = "doc_id",
) -> DataFrame:
    """Share of gold queries with an expected document among the first k, per k."""
    best = (
        gold.select(query_id, F.col("expected").alias(doc))
        .join(ranked, [query_id, doc], "left")
        .groupBy(query_id)
        .agg(F.min("rank").alias("_best"))
    )
    rows = F.array(
        *[F.struct(F.lit(k).alias("k"), F.col(f"r{k}").alias("recall")) for k in ks]
    )
    return best.agg(
        *[
            F.avg(F.coalesce((F.col("_best") <= k).cast("double"), F.lit(0.0))).alias(
                f"r{k}"
            )
            for k in ks
        ]
    ).select(F.inline(rows))


def source_blocks(
    ranked: DataFrame, documents: DataFrame, query_id: str, doc: str, title: str
) -> DataFrame:
    """Numbered source blocks of each query, in rank order, as one string.

    A query has at most k ranked documents, so the gathered arrays are that short. Few ranked
    rows go to the documents, whose texts then stay where they are.
    """
    ranked = stage_table(ranked, "ranked")
    ranked = F.broadcast(ranked) if fits_broadcast(ranked) else ranked
    block = F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] ("),
        F.col(doc).cast("string"), F.lit(") "), F.col(title), F.lit(" — "), F.col("text"),
    )
    return (
        ranked.join(documents.select(doc, title, "text"), doc)
        .groupBy(query_id)
        .agg(F.array_sort(F.collect_list(F.struct("rank", block.alias("b")))).alias("_s"))
        .select(
            query_id,
            F.array_join(F.transform("_s", lambda s: s["b"]), "\n\n").alias("sources"),
        )
    )


# The instruction lines of the retrieval prompt.
PROMPT_HEAD = (
    "Tu es l'agent de recherche d'offres.\n"
    "Réponds UNIQUEMENT à partir des offres ci-dessous.\n"
    "Cite tes sources avec leur numéro [n]. Si aucune offre ne convient, "
    "dis-le explicitement au lieu d'inventer.\n\n"
)
PROMPT_SOURCES = "OFFRES :\n"
PROMPT_QUERY = "\n\nPROFIL RECHERCHÉ (anonymisé) : "


def prompts(
    ranked: DataFrame,
    documents: DataFrame,
    queries: DataFrame,
    query_id: str = "query_id",
    query: str = "query",
    doc: str = "doc_id",
    title: str = "title",
) -> DataFrame:
    """One prompt per query: instructions, numbered sources, the query itself."""
    return (
        source_blocks(ranked, documents, query_id, doc, title)
        .join(queries.select(query_id, query), query_id)
        .select(
            query_id,
            F.concat(
                F.lit(PROMPT_HEAD), F.lit(PROMPT_SOURCES), F.col("sources"),
                F.lit(PROMPT_QUERY), F.col(query), F.lit("\n"),
            ).alias("prompt"),
        )
    )
