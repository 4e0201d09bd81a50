"""Pair features, compatibility, requests, pair scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matching as mc
from ..plans.staging import scratch_path, stage_table
from ..sources import requests as rq
from ..sources.tables import table
from ..streaming import scoring as st
from .base import LISTED_SQL, MATCH_CTE, PAIR_SQL, match_sides, query, r6

# Coefficients of the published scoring model, in feature order.
COEF = (8.0, -0.75, 0.25, 0.05)
INTERCEPT = -6.0

_ROUNDED = "round(coverage, 6) AS coverage, missing, margin, width"


def _pair_view(df, *keys):
    return df.select(*keys, r6("coverage"), "missing", "margin", "width")


def listed(spark, sf):
    return mc.listed_pairs(*match_sides(spark, sf))


# Two names of one query: the features of the pairs that are to be scored.
_LISTED = f"WITH {MATCH_CTE} SELECT profile_id, offer_id, {_ROUNDED} FROM {LISTED_SQL}"


@query("pair_features", _LISTED)
@query("pair_features_listed", _LISTED)
def pair_features(spark, sf):
    return _pair_view(listed(spark, sf), "profile_id", "offer_id")


TOP = 5  # offers shown to a profile


@query(
    "pair_features_indexed",
    f"""WITH {MATCH_CTE} SELECT profile_id, offer_id, rank::INT AS rank, {_ROUNDED} FROM (
      SELECT *, row_number() OVER (PARTITION BY profile_id
        ORDER BY coverage DESC, margin DESC, offer_id) AS rank FROM {LISTED_SQL})
      WHERE rank <= {TOP}""",
)
def pair_features_indexed(spark, sf):
    return _pair_view(mc.best_offers(listed(spark, sf), TOP), "profile_id", "offer_id", "rank")


@query(
    "compat_rule",
    f"""WITH {MATCH_CTE} SELECT profile_id, offer_id FROM {LISTED_SQL}
      WHERE coverage >= 0.6 AND margin >= 0""",
)
def compat_rule(spark, sf):
    pairs = listed(spark, sf).where(mc.compatible(F.col("coverage"), F.col("margin")))
    return pairs.select("profile_id", "offer_id")


@query(
    "pair_grid",
    f"WITH {MATCH_CTE} SELECT {_ROUNDED}, count(*) AS n FROM {LISTED_SQL} GROUP BY ALL",
)
def pair_grid(spark, sf):
    return _pair_view(mc.feature_classes(listed(spark, sf)), "n")


# ---- requests ----------------------------------------------------------------------

REQUEST_CTE = f"""{MATCH_CTE},
requests AS (
  SELECT a.profile_id || '/' || a.offer_id AS request_id, c.c_mktsegment AS seg,
    c.c_acctbal AS bal, c.c_nationkey AS nat, skills, years, required, min_years
  FROM applications a JOIN profiles p ON a.profile_id = p.profile_id
  JOIN offers o ON a.offer_id = o.offer_id JOIN customer c ON a.profile_id = c.c_custkey),
judged AS (
  SELECT *, list_filter([
      CASE WHEN nat = 7 THEN 'not_an_object' END,
      CASE WHEN seg = 'MACHINERY' AND nat <> 7 THEN 'extra_field' END,
      CASE WHEN nat = 7 OR nat = 3 OR len(skills) NOT BETWEEN 1 AND 50 THEN 'skills' END,
      CASE WHEN nat = 7 OR len(required) NOT BETWEEN 1 AND 50 THEN 'offer_required' END,
      CASE WHEN nat = 7 OR (CASE WHEN bal < 0 THEN -years ELSE years END) NOT BETWEEN 0 AND 60
        THEN 'years' END,
      CASE WHEN nat = 7 OR min_years NOT BETWEEN 0 AND 60 THEN 'offer_min_years' END],
      lambda x: x IS NOT NULL) AS reasons FROM requests)
"""


TASK_REQUESTS = 100_000  # requests that a task makes


def request_rows(spark, sf):
    """One raw request per application, as its sender wrote it.

    Some customers send a forbidden field, a negative number of years, no skills at
    all, or text after the document.
    """
    customers = table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    pairs, profiles, offers = match_sides(spark, sf)
    # Few bytes now, but much text and work each later: adaptive execution would merge them into few tasks.
    pairs = stage_table(pairs, "pairs")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pairs.count() // TASK_REQUESTS))
    rows = (
        pairs.repartition(tasks, "profile_id").join(profiles, "profile_id")
        .join(offers, "offer_id")
        .join(customers, F.col("profile_id") == F.col("c_custkey"))
    )
    body = F.to_json(
        F.struct(
            F.when(F.col("c_nationkey") != 3, F.transform("skills", F.upper)).alias("skills"),
            F.when(F.col("c_acctbal") < 0, -F.col("years")).otherwise(F.col("years")).alias("years"),
            F.transform("required", F.upper).alias("offer_required"),
            F.col("min_years").alias("offer_min_years"),
            F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_name")).alias("name"),
        )
    )
    tail = F.when(F.col("c_nationkey") == 7, F.lit(" merci")).otherwise(F.lit(""))
    return rows.select(
        F.concat_ws("/", F.col("profile_id").cast("string"), "offer_id").alias("request_id"),
        F.concat(body, tail).alias("raw"),
    )


@query(
    "request_validate",
    f"""WITH {REQUEST_CTE} SELECT request_id, len(reasons) = 0 AS valid,
      array_to_string(reasons, ',') AS reasons FROM judged""",
)
def request_validate(spark, sf):
    return rq.parse(request_rows(spark, sf)).select(
        "request_id", "valid", F.array_join("reasons", ",").alias("reasons")
    )


_z = f"{INTERCEPT} + coverage * {COEF[0]} + missing * ({COEF[1]}) + margin * {COEF[2]} + width * {COEF[3]}"
_SCORE_SQL = f"""WITH {REQUEST_CTE},
  f AS (SELECT request_id, {PAIR_SQL} FROM judged WHERE len(reasons) = 0),
  p AS (SELECT request_id, 1 / (1 + exp(-({_z}))) AS p FROM f)
  SELECT request_id, round(p, 3) AS probability, p >= 0.5 AS compatible,
    0.5::DOUBLE AS threshold FROM p"""


@query("score_requests", _SCORE_SQL)
def score_requests(spark, sf):
    parsed = rq.parse(request_rows(spark, sf))
    return rq.respond(parsed, COEF, INTERCEPT).select(
        "request_id", "probability", "compatible", "threshold"
    )


@query("score_stream", _SCORE_SQL)
def score_stream(spark, sf):
    """The same requests, arriving as files and scored by the streaming job."""
    inbox, out, state = (scratch_path(spark, n) for n in ("inbox", "scored", "state"))
    request_rows(spark, sf).write.parquet(inbox)
    stream = st.score_stream(st.request_stream(spark, inbox), COEF, INTERCEPT)
    st.run_available(stream, out, state)
    return spark.read.parquet(out)


@query("score_served", _SCORE_SQL)
def score_served(spark, sf):
    """The same requests, each sent twice and answered once."""
    inbox, out, state = (scratch_path(spark, n) for n in ("inbox", "served", "state"))
    rows = request_rows(spark, sf).select(
        "request_id", "raw", F.timestamp_seconds(F.lit(1_000_000)).alias("arrived")
    )
    # A batch is a number of files, and joins may make them in fewer tasks than asked for.
    rows.write.option("maxRecordsPerFile", TASK_REQUESTS).parquet(inbox)
    # The second time as sent, not made anew.
    again = spark.read.schema(rows.schema).parquet(inbox)
    again.write.mode("append").option("maxRecordsPerFile", TASK_REQUESTS).parquet(inbox)
    stream = st.once_each(st.arriving_requests(spark, inbox))
    st.serve_available(stream, COEF, INTERCEPT, out, state)
    return st.served(spark, out)


@query(
    "pair_confusion",
    f"""WITH {MATCH_CTE}, f AS {LISTED_SQL},
    y AS (SELECT coverage >= 0.6 AND margin >= 0 AS y, 1 / (1 + exp(-({_z}))) >= 0.5 AS p FROM f)
    SELECT count(*) FILTER (NOT y AND NOT p) AS tn, count(*) FILTER (NOT y AND p) AS fp,
      count(*) FILTER (y AND NOT p) AS fn, count(*) FILTER (y AND p) AS tp FROM y""",
)
def pair_confusion(spark, sf):
    from ..operators.metrics import confusion

    return confusion(scored_pairs(spark, sf).withColumn("pred", F.col("p") >= 0.5), "y", "pred")


def scored_pairs(spark, sf):
    return listed(spark, sf).select(
        "profile_id",
        "offer_id",
        *mc.FEATURES,
        mc.compatible(F.col("coverage"), F.col("margin")).alias("y"),
        mc.logistic([F.col(c) for c in mc.FEATURES], COEF, INTERCEPT).alias("p"),
    )
