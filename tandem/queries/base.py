"""Registration of queries with their SQL counterparts, and shared inputs of both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..plans.staging import stage_table
from ..sources.tables import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# ---- SQL fragments ---------------------------------------------------------------

WORD = tx.WORD
NOT_WORD = r"[^\p{L}\p{N}_]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{tx.WS}+|{tx.WS}+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{tx.WS}+', ' ', 'g'))"


def sql_normalize(x: str) -> str:
    return sql_collapse(f"nfc_normalize({x})")


def sql_fold(x: str) -> str:
    out = f"lower({x})"
    for src, dst in tx.FOLDINGS:
        out = f"replace({out}, '{src}', '{dst}')"
    return out


def sql_present(x: str) -> str:
    marks = ", ".join(f"'{m}'" for m in tx.MISSING_MARKERS)
    return f"{x} IS NOT NULL AND lower({sql_strip(x)}) NOT IN ({marks})"


def sql_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{WORD}{{2,}}')"


def sql_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{tx.WS}+'), lambda w: w <> '')"


def sql_clean(source: str, row_id: str = "doc_id", keep: str = "") -> str:
    """Subquery: cleaned and deduplicated rows of ``source``."""
    extra = f", {keep}" if keep else ""
    return f"""(SELECT {row_id}, norm AS text{extra} FROM (
      SELECT *, row_number() OVER (PARTITION BY fold ORDER BY {row_id}) AS rn FROM (
        SELECT *, {sql_fold('norm')} AS fold FROM (
          SELECT *, {sql_normalize('text')} AS norm FROM {source}
          WHERE {sql_present('text')}))) WHERE rn = 1)"""


# ---- labelled documents -----------------------------------------------------------

LABELLED_SQL = """(SELECT d.doc_id, d.text, d.lang, d.n_chars, l.quality = 1 AS label,
  l.toxic = 1 AS toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Documents that carry labels; columns are pruned at the scan."""
    docs = documents(spark, sf, "doc_id", *columns)
    labels = table(spark, sf, "labels").select(
        "doc_id",
        (F.col("quality") == 1).alias("label"),
        (F.col("toxic") == 1).alias("toxic"),
    )
    return docs.join(labels, "doc_id")


# ---- profiles, offers and applications ---------------------------------------------

MATCH_CTE = """
bought AS (
  SELECT o_custkey, o_orderkey, p_brand, p_type, p_size
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
profiles AS (
  SELECT o_custkey AS profile_id, list_sort(list(DISTINCT p_brand)) AS skills,
         count(DISTINCT o_orderkey)::INT AS years
  FROM bought GROUP BY o_custkey),
offers AS (
  SELECT p_type || '|' || p_size AS offer_id,
         list_sort(list(DISTINCT p_brand)) AS required, p_size % 9 AS min_years
  FROM part GROUP BY p_type, p_size),
applications AS (
  SELECT DISTINCT o_custkey AS profile_id, p_type || '|' || p_size AS offer_id FROM bought)
"""

PAIR_SQL = """
len(list_intersect(skills, required)) / len(required)::DOUBLE AS coverage,
(len(required) - len(list_intersect(skills, required)))::DOUBLE AS missing,
(years - min_years)::DOUBLE AS margin, len(skills)::DOUBLE AS width
"""


def bought(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    part = table(spark, sf, "part", "p_partkey", "p_brand", "p_type", "p_size")
    rows = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    return rows.select("o_custkey", "o_orderkey", "p_brand", "p_type", "p_size")


def match_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Applications, profiles and offers; the joined line items behind them are staged once."""
    rows = stage_table(bought(spark, sf), "bought")
    return applications(rows), profiles(rows), offers(spark, sf)


def profiles(rows: DataFrame) -> DataFrame:
    """A customer's skills are the brands bought, its years the number of orders.

    The distinct count makes Spark combine by (customer, order) first, so a customer
    with a large share of the rows reaches the last stage as merged partial sets.
    """
    return (
        rows.groupBy(F.col("o_custkey").alias("profile_id"))
        .agg(
            F.array_sort(F.collect_set("p_brand")).alias("skills"),
            F.count_distinct("o_orderkey").cast("int").alias("years"),
        )
    )


def _offer_id():
    return F.concat_ws("|", "p_type", F.col("p_size").cast("string"))


def offers(spark: SparkSession, sf: str) -> DataFrame:
    """An offer per part type and size; it requires the brands of its parts."""
    return (
        table(spark, sf, "part", "p_type", "p_size", "p_brand")
        .groupBy("p_type", "p_size")
        .agg(F.array_sort(F.collect_set("p_brand")).alias("required"))
        .select(
            _offer_id().alias("offer_id"),
            "required",
            (F.col("p_size") % 9).cast("int").alias("min_years"),
        )
    )


def applications(rows: DataFrame) -> DataFrame:
    """Pairs to score: a customer applies to the offers whose parts it bought."""
    return rows.select(
        F.col("o_custkey").alias("profile_id"), _offer_id().alias("offer_id")
    ).distinct()


#: Listed pairs with their features, as a subquery over ``MATCH_CTE``.
LISTED_SQL = f"""(SELECT a.profile_id, a.offer_id, {PAIR_SQL} FROM applications a
  JOIN profiles p ON a.profile_id = p.profile_id JOIN offers o ON a.offer_id = o.offer_id)"""


def r6(name: str):
    return F.round(F.col(name), 6).alias(name)
