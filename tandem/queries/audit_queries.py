"""Metrics, group fairness, drift, gates, fingerprints and the registry."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import drift as dr
from ..operators import gates as gt
from ..operators import hashtree as ht
from ..operators import matching as mc
from ..operators import metrics as mt
from ..operators import registry as rg
from ..operators.attention import group_softmax, self_attention
from ..operators.days import DayStore
from ..plans.staging import scratch_path, stage_table
from ..sources.tables import documents, spread, table
from ..streaming.drift import day_outcomes, day_window, report_available, reports, window_bin_counts
from ..streaming.scoring import run_available
from .base import LABELLED_SQL, LISTED_SQL, MATCH_CTE, NOT_WORD, ORACLES, labelled, query, r6, sql_collapse
from .match_queries import scored_pairs
from .privacy_queries import LEAKS_SQL

LONG = 1000  # documents of at least this many characters are predicted good

COUNTS_SQL = """count(*) FILTER (NOT label AND NOT pred) AS tn,
  count(*) FILTER (NOT label AND pred) AS fp, count(*) FILTER (label AND NOT pred) AS fn,
  count(*) FILTER (label AND pred) AS tp"""
RATIOS_SQL = """round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0)::DOUBLE, 0), 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS "precision",
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1"""
PRED_SQL = f"(SELECT *, n_chars >= {LONG} AS pred FROM {LABELLED_SQL})"

RATIO_NAMES = ("accuracy", "precision", "recall", "f1")


def predicted(spark, sf, at_least=LONG):
    rows = labelled(spark, sf, "n_chars", "lang")
    return rows.withColumn("pred", F.col("n_chars") >= at_least)


# ---- classification metrics ---------------------------------------------------------


@query("confusion", f"SELECT {COUNTS_SQL} FROM {PRED_SQL}")
def confusion(spark, sf):
    return mt.confusion(predicted(spark, sf), "label", "pred")


@query(
    "binary_metrics",
    f"SELECT lang, {RATIOS_SQL} FROM (SELECT lang, {COUNTS_SQL} FROM {PRED_SQL} GROUP BY lang)",
)
def binary_metrics(spark, sf):
    out = mt.binary_metrics(predicted(spark, sf), "label", "pred", ["lang"])
    return out.select("lang", *[r6(c) for c in RATIO_NAMES])


@query(
    "threshold_sweep",
    f"""SELECT t AS threshold, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS "precision",
      round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall FROM (
      SELECT t, count(*) FILTER (label AND s >= t) AS tp,
        count(*) FILTER (NOT label AND s >= t) AS fp, count(*) FILTER (label AND s < t) AS fn
      FROM (SELECT label, n_chars / (n_chars + 1000.0)::DOUBLE AS s FROM {LABELLED_SQL}),
        (SELECT unnest([0.3, 0.5, 0.7])::DOUBLE AS t) GROUP BY t)""",
)
def threshold_sweep(spark, sf):
    rows = labelled(spark, sf, "n_chars").withColumn(
        "s", F.col("n_chars") / (F.col("n_chars") + 1000.0)
    )
    return mt.threshold_sweep(rows, "label", "s").select("threshold", r6("precision"), r6("recall"))


@query(
    "majority_baseline",
    f"""SELECT answer, {RATIOS_SQL} FROM (SELECT any_value(answer) AS answer, {COUNTS_SQL} FROM (
      SELECT label, answer, answer AS pred FROM {LABELLED_SQL},
        (SELECT 2 * count(*) FILTER (label) > count(*) AS answer FROM {LABELLED_SQL})))""",
)
def majority_baseline(spark, sf):
    out = mt.majority_baseline(labelled(spark, sf), "label")
    return out.select("answer", *[r6(c) for c in RATIO_NAMES])


@query(
    "class_weights",
    f"""SELECT label, count(*) AS n, round((SELECT count(*) FROM {LABELLED_SQL})
      / (2.0::DOUBLE * count(*)), 6) AS weight FROM {LABELLED_SQL} GROUP BY label""",
)
def class_weights(spark, sf):
    return mt.class_weights(labelled(spark, sf), "label").select("label", "n", r6("weight"))


# ---- group fairness -------------------------------------------------------------------


@query(
    "hire_rate_by_group",
    f"""SELECT lang, round(avg(label::INT), 6) AS hire_rate FROM {LABELLED_SQL}
      WHERE NOT toxic GROUP BY lang""",
)
def hire_rate_by_group(spark, sf):
    rows = labelled(spark, sf, "lang").where("not toxic")
    return mt.group_rates(rows, "lang", F.col("label"), "hire_rate").select("lang", r6("hire_rate"))


@query(
    "selection_rates",
    f"SELECT lang, round(avg(pred::INT), 6) AS rate FROM {PRED_SQL} GROUP BY lang",
)
def selection_rates(spark, sf):
    return mt.group_rates(predicted(spark, sf), "lang", F.col("pred"), "rate").select("lang", r6("rate"))


@query(
    "disparate_impact",
    f"""SELECT round(a, 6) AS rate_a, round(b, 6) AS rate_b,
      round(CASE WHEN a > 0 THEN b / a ELSE 0 END, 6) AS impact,
      CASE WHEN a > 0 THEN b / a ELSE 0 END < 0.8 AS alarm FROM (
      SELECT coalesce(avg(pred::INT) FILTER (lang = 'en'), 0) AS a,
        coalesce(avg(pred::INT) FILTER (lang = 'fr'), 0) AS b FROM {PRED_SQL})""",
)
def disparate_impact(spark, sf):
    out = mt.disparate_impact(predicted(spark, sf), "lang", "pred", "en", "fr")
    return out.select(r6("rate_a"), r6("rate_b"), r6("impact"), "alarm")


@query(
    "utility_f1",
    f"""SELECT f1 FROM (SELECT {RATIOS_SQL} FROM (
      SELECT {COUNTS_SQL} FROM (SELECT NOT toxic AS label, pred FROM {PRED_SQL})))""",
)
def utility_f1(spark, sf):
    rows = predicted(spark, sf).withColumn("truth", ~F.col("toxic"))
    return mt.binary_metrics(rows, "truth", "pred").select(r6("f1"))


# A word of the test corpus stands in for the proxy word.
MARKER = "nichts?"
_MARK_RE = f"(^|{NOT_WORD}){MARKER}({NOT_WORD}|$)"


@query(
    "proxy_marker",
    f"""SELECT lang, count(*) AS n, count(*) FILTER (regexp_matches(lower(text), '{_MARK_RE}'))
      AS marked FROM documents GROUP BY lang""",
)
def proxy_marker(spark, sf):
    return (
        documents(spark, sf, "lang", "text")
        .groupBy("lang")
        .agg(
            F.count("*").alias("n"),
            F.count_if(mt.has_marker(F.col("text"), MARKER)).alias("marked"),
        )
    )


_once = lambda x: f"regexp_replace({x}, '{_MARK_RE}', '\\1 \\2', 'g')"


@query(
    "neutralize",
    f"SELECT doc_id, {sql_collapse(_once(_once('lower(text)')))} AS text FROM documents",
)
def neutralize(spark, sf):
    docs = documents(spark, sf, "doc_id", "text")
    return docs.select("doc_id", mt.neutralize(F.lower("text"), MARKER).alias("text"))


# ---- drift ------------------------------------------------------------------------------

CUT = "2024-01-16"
FEATURES = ["value", "user_id", "k", "hour"]

EVENTS_CTE = f"""
wide AS (SELECT ts, event_id, value, user_id::DOUBLE AS user_id,
    (props->>'$.k')::DOUBLE AS k, extract(hour FROM ts)::DOUBLE AS hour FROM events),
long AS (
  SELECT ts, event_id, unnest(['value', 'user_id', 'k', 'hour']) AS feature,
    unnest([value, user_id, k, hour]) AS value FROM wide),
ref AS (SELECT * FROM long WHERE ts < TIMESTAMP '{CUT}'),
prod AS (SELECT ts, event_id, feature, value FROM long WHERE ts >= TIMESTAMP '{CUT}'
  UNION ALL SELECT ts, event_id, 'value_shifted', value + 10 FROM long
  WHERE ts >= TIMESTAMP '{CUT}' AND feature = 'value'),
refs AS (SELECT ts, event_id, feature, value FROM ref
  UNION ALL SELECT ts, event_id, 'value_shifted', value FROM ref WHERE feature = 'value'),
edges AS (SELECT feature, quantile_cont(value, [{', '.join(str(i / 10) for i in range(1, 10))}]) AS e
  FROM refs GROUP BY feature),
spine AS (SELECT feature, unnest(range(0, 10)) AS bin FROM edges),
rc AS (SELECT r.feature, len(list_filter(e, lambda x: r.value >= x)) AS bin, count(*) AS c
  FROM refs r JOIN edges ON r.feature = edges.feature GROUP BY ALL),
rs AS (SELECT s.feature, s.bin, greatest(coalesce(c, 0) / (sum(c) OVER (PARTITION BY s.feature))::DOUBLE, 1e-4) AS p
  FROM spine s LEFT JOIN rc ON rc.feature = s.feature AND rc.bin = s.bin)
"""

_PSI_ALL = f"""{EVENTS_CTE},
pc AS (SELECT r.feature, len(list_filter(e, lambda x: r.value >= x)) AS bin, count(*) AS c
  FROM prod r JOIN edges ON r.feature = edges.feature GROUP BY ALL),
ps AS (SELECT s.feature, s.bin, greatest(coalesce(c, 0) / (sum(c) OVER (PARTITION BY s.feature))::DOUBLE, 1e-4) AS q
  FROM spine s LEFT JOIN pc ON pc.feature = s.feature AND pc.bin = s.bin),
report AS (SELECT rs.feature, sum((q - p) * ln(q / p)) AS psi
  FROM rs JOIN ps ON rs.feature = ps.feature AND rs.bin = ps.bin GROUP BY rs.feature)
"""
_STATUS = """CASE WHEN psi >= 0.2 THEN 'ALERTE' WHEN psi >= 0.1 THEN 'A SURVEILLER'
  ELSE 'stable' END"""


def _wide(spark, sf):
    ev = spread(table(spark, sf, "events", "ts", "value", "user_id", "props"))
    return ev.select(
        "ts",
        "value",
        "user_id",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").alias("hour"),
    )


def drift_samples(spark, sf):
    """Reference and production rows in long form, one production feature shifted.

    The JSON is parsed once into a staged table of numbers, which the passes over the
    features then read column by column.
    """
    wide = stage_table(_wide(spark, sf), "events-wide").withColumn("value_shifted", F.col("value"))
    cut = F.lit(CUT).cast("timestamp_ntz")
    names = [*FEATURES, "value_shifted"]
    ref = dr.unpivot(wide.where(F.col("ts") < cut), ["ts"], names)
    moved = wide.where(F.col("ts") >= cut).withColumn("value_shifted", F.col("value") + 10)
    return ref, dr.unpivot(moved, ["ts"], names)


@query("drift_psi", f"WITH {_PSI_ALL} SELECT feature, round(psi, 6) AS psi FROM report")
def drift_psi(spark, sf):
    return dr.drift_report(*drift_samples(spark, sf)).select("feature", r6("psi"))


@query(
    "drift_report",
    f"WITH {_PSI_ALL} SELECT feature, round(psi, 6) AS psi, {_STATUS} AS status FROM report",
)
def drift_report(spark, sf):
    return dr.drift_report(*drift_samples(spark, sf)).select("feature", r6("psi"), "status")


@query(
    "drift_worst",
    f"""WITH {_PSI_ALL} SELECT feature, round(psi, 6) AS psi, {_STATUS} AS status FROM report
      ORDER BY report.psi DESC LIMIT 1""",
)
def drift_worst(spark, sf):
    worst = dr.worst(dr.drift_report(*drift_samples(spark, sf)))
    return worst.select("feature", r6("psi"), "status")


@query(
    "quantile_edges",
    f"""WITH {EVENTS_CTE} SELECT feature, i::INT AS i, round(e[i + 1], 6) AS edge
      FROM (SELECT feature, e, unnest(range(0, 9)) AS i FROM edges)""",
)
def quantile_edges(spark, sf):
    ref, _ = drift_samples(spark, sf)
    return dr.quantile_edges(ref).select("feature", F.posexplode("edges").alias("i", "edge")).select(
        "feature", "i", r6("edge")
    )


@query(
    "drift_by_window",
    f"""WITH {EVENTS_CTE},
    pc AS (SELECT strftime(ts, '%Y-%m-%d') AS day, r.feature,
        len(list_filter(e, lambda x: r.value >= x)) AS bin, count(*) AS c
      FROM prod r JOIN edges ON r.feature = edges.feature GROUP BY ALL),
    days AS (SELECT DISTINCT day, feature FROM pc),
    ps AS (SELECT d.day, s.feature, s.bin,
        greatest(coalesce(c, 0) / (sum(c) OVER (PARTITION BY d.day, s.feature))::DOUBLE, 1e-4) AS q
      FROM days d JOIN spine s ON s.feature = d.feature
      LEFT JOIN pc ON pc.day = d.day AND pc.feature = s.feature AND pc.bin = s.bin),
    report AS (SELECT day, rs.feature, sum((q - p) * ln(q / p)) AS psi
      FROM rs JOIN ps ON rs.feature = ps.feature AND rs.bin = ps.bin GROUP BY ALL)
    SELECT day, feature, round(psi, 6) AS psi, {_STATUS} AS status FROM report""",
)
def drift_by_window(spark, sf):
    ref, prod = drift_samples(spark, sf)
    by_day = prod.withColumn("day", day_window(F.col("ts")))
    return dr.drift_report(ref, by_day, ["day"]).select("day", "feature", r6("psi"), "status")


@query(
    "drift_stream",
    f"""WITH {EVENTS_CTE}
    SELECT strftime(ts, '%Y-%m-%d') AS day, r.feature,
      len(list_filter(e, lambda x: r.value >= x))::INT AS bin, count(*) AS c
    FROM prod r JOIN edges ON r.feature = edges.feature
    WHERE r.value IS NOT NULL AND date_trunc('day', ts) + INTERVAL 1 DAY
      <= (SELECT max(ts) FROM prod) - INTERVAL 1 HOUR GROUP BY ALL""",
)
def drift_stream(spark, sf):
    """Bins of the production days that the watermark has closed, from a stream of files."""
    ref, prod = drift_samples(spark, sf)
    inbox, out, state = (scratch_path(spark, n) for n in ("events", "bins", "state"))
    prod.write.parquet(inbox)
    stream = spark.readStream.schema(prod.schema).parquet(inbox)
    run_available(window_bin_counts(stream, dr.quantile_edges(ref)), out, state)
    return spark.read.schema("day string, feature string, bin int, c long").parquet(out)


def day_store(spark, sf):
    """All events in a store of days."""
    ref, prod = drift_samples(spark, sf)
    store = DayStore(spark, scratch_path(spark, "day-store"))
    store.add(ref.unionByName(prod).withColumn("day", day_window(F.col("ts"))))
    return store


#: Ranges of days, both ends included.
RANGES = (("2024-01-01", "2024-01-10"), ("2024-01-08", "2024-01-21"), ("2024-01-30", "2024-01-30"))


@query(
    "edges_of_days",
    f"""WITH {EVENTS_CTE}, every AS (SELECT * FROM refs UNION ALL SELECT * FROM prod),
    ranges AS (SELECT unnest({[r[0] for r in RANGES]}) AS first_day, unnest({[r[1] for r in RANGES]}) AS last_day),
    cut AS (SELECT first_day, last_day, feature, count(value) AS n,
        quantile_cont(value, [{', '.join(str(i / 10) for i in range(1, 10))}]) AS e
      FROM every JOIN ranges ON strftime(ts, '%Y-%m-%d') BETWEEN first_day AND last_day GROUP BY ALL)
    SELECT first_day, last_day, feature, n, i::INT AS i, round(e[i + 1], 6) AS edge
    FROM (SELECT *, unnest(range(0, 9)) AS i FROM cut)""",
)
def edges_of_days(spark, sf):
    """Quantile edges of ranges of days, from a store that reads each day once."""
    store = day_store(spark, sf)
    parts = [
        store.edges(*days).select(
            F.lit(days[0]).alias("first_day"), F.lit(days[1]).alias("last_day"), "feature", "n",
            F.posexplode("edges").alias("i", "edge"),
        )
        for days in RANGES
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("edge", r6("edge"))


@query("drift_of_days", ORACLES["drift_by_window"])
def drift_of_days(spark, sf):
    """The daily report from a store of days: production against all days before the cut."""
    last = (date.fromisoformat(CUT) - timedelta(days=1)).isoformat()
    report = day_store(spark, sf).report((None, last), (CUT, None), by_day=True)
    return report.select("day", "feature", r6("psi"), "status")

@query(
    "drift_day_reports",
    f"""WITH {EVENTS_CTE},
    pc AS (SELECT strftime(ts, '%Y-%m-%d') AS day, r.feature,
        len(list_filter(e, lambda x: r.value >= x)) AS bin, count(*) AS c
      FROM prod r JOIN edges ON r.feature = edges.feature
      WHERE r.value IS NOT NULL AND date_trunc('day', ts) + INTERVAL 1 DAY
        <= (SELECT max(ts) FROM prod WHERE value IS NOT NULL) - INTERVAL 1 HOUR GROUP BY ALL),
    days AS (SELECT day, feature, sum(c)::BIGINT AS n FROM pc GROUP BY ALL),
    ps AS (SELECT d.day, s.feature, s.bin, d.n, greatest(coalesce(c, 0) / d.n::DOUBLE, 1e-4) AS q
      FROM days d JOIN spine s ON s.feature = d.feature
      LEFT JOIN pc ON pc.day = d.day AND pc.feature = s.feature AND pc.bin = s.bin),
    report AS (SELECT day, rs.feature, n, sum((q - p) * ln(q / p)) AS psi
      FROM rs JOIN ps ON rs.feature = ps.feature AND rs.bin = ps.bin GROUP BY ALL)
    SELECT day, feature, n, round(psi, 6) AS psi, {_STATUS} AS status FROM report""",
)
def drift_day_reports(spark, sf):
    """PSI of each production day, reported by the stream when the watermark closes the day."""
    ref, prod = drift_samples(spark, sf)
    inbox, out, state = (scratch_path(spark, n) for n in ("events", "reports", "state"))
    prod.write.parquet(inbox)
    stream = spark.readStream.schema(prod.schema).parquet(inbox)
    report_available(day_outcomes(stream, dr.reference_bins(ref)), out, state)
    return reports(spark, out).select("day", "feature", "n", r6("psi"), "status")


# ---- gates --------------------------------------------------------------------------------

_GATE_DATA_SQL = f"""SELECT 'data_gate' AS name,
    n >= 200 AND holes = 0 AND rate BETWEEN 0.02 AND 0.5 AS passed,
    CASE WHEN n < 200 THEN n || ' lignes < minimum 200'
      WHEN holes > 0 THEN 'valeurs manquantes dans les features'
      WHEN rate NOT BETWEEN 0.02 AND 0.5
        THEN 'taux de positifs ' || printf('%.1f', rate * 100) || '% hors bornes [2%, 50%]'
      ELSE n || ' lignes, ' || printf('%.1f', rate * 100) || '% de positifs' END AS reason
  FROM (SELECT count(*) AS n, avg(y::INT) AS rate, count(*) FILTER (coverage IS NULL OR
      missing IS NULL OR margin IS NULL OR width IS NULL) AS holes
    FROM (SELECT *, coalesce(coverage >= 0.6 AND margin >= 0, false) AS y FROM {LISTED_SQL}))"""


@query("data_gate", f"WITH {MATCH_CTE} {_GATE_DATA_SQL}")
def data_gate(spark, sf):
    return gt.data_gate(scored_pairs(spark, sf), list(mc.FEATURES), "y")


def _recall_at(n: int) -> str:
    return f"""(SELECT coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) FROM (
      SELECT count(*) FILTER (label AND n_chars >= {n}) AS tp,
        count(*) FILTER (label AND n_chars < {n}) AS fn FROM {LABELLED_SQL}))"""


_GATE_MODEL_SQL = f"""SELECT 'model_gate' AS name, new >= old - 0.02 AS passed,
    CASE WHEN new < old - 0.02 THEN 'recall du challenger ' || printf('%.3f', new) ||
      ' < champion ' || printf('%.3f', old) || ' (tolérance 0.02)'
    ELSE 'recall : challenger ' || printf('%.3f', new) || ' vs champion ' || printf('%.3f', old)
    END AS reason FROM (SELECT {_recall_at(2000)} AS new, {_recall_at(500)} AS old)"""


def model_metrics(spark, sf):
    """(role, metric, value) of two length rules on the labelled documents."""
    out = None
    for role, n in (("champion", 500), ("challenger", 2000)):
        m = mt.binary_metrics(predicted(spark, sf, n), "label", "pred")
        part = m.unpivot([], list(RATIO_NAMES), "metric", "value").select(
            F.lit(role).alias("role"), "metric", "value"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("model_gate", _GATE_MODEL_SQL)
def model_gate(spark, sf):
    return gt.model_gate(model_metrics(spark, sf))


_GATE_SAFETY_SQL = f"""SELECT 'safety_gate' AS name, first IS NULL AS passed,
    CASE WHEN first IS NULL THEN n || ' sorties inspectées, zéro fuite'
    ELSE 'fuite PII dans la sortie ' || (first.p + 1) || ' : [' ||
      array_to_string(first.l, ', ') || ']' END AS reason
  FROM (SELECT count(*) AS n, arg_min({{'p': doc_id, 'l': l}}, doc_id) FILTER (len(l) > 0) AS first
    FROM (SELECT doc_id, list_sort(list_distinct({LEAKS_SQL})) AS l FROM documents))"""


@query("safety_gate", _GATE_SAFETY_SQL)
def safety_gate(spark, sf):
    docs = documents(spark, sf, "doc_id", "text")
    return gt.safety_gate(docs, "doc_id", declared=False)


@query(
    "run_gates",
    f"""WITH {MATCH_CTE} SELECT count(*) AS gates, coalesce(bool_and(passed), true) AS passed
      FROM ({_GATE_DATA_SQL} UNION ALL {_GATE_MODEL_SQL} UNION ALL {_GATE_SAFETY_SQL})""",
)
def run_gates(spark, sf):
    results = data_gate(spark, sf).unionByName(model_gate(spark, sf)).unionByName(safety_gate(spark, sf))
    return gt.run_gates(results)


# ---- fingerprint and registry ---------------------------------------------------------------

_LANES_SQL = ", ".join(
    f"coalesce(sum(('0x' || substr(h, {1 + 15 * i}, 15))::UBIGINT::HUGEINT), 0)::VARCHAR AS s{i}"
    for i in range(4)
)
_FINGERPRINT_SQL = f"""(SELECT n AS n_rows,
    sha256(concat_ws('|', n::VARCHAR, s0, s1, s2, s3)) AS dataset_hash
  FROM (SELECT count(*) AS n, {_LANES_SQL} FROM (
    SELECT sha256(concat_ws(',', coalesce(sha256(doc_id::VARCHAR), '-'),
      coalesce(sha256(quality::VARCHAR), '-'), coalesce(sha256(toxic::VARCHAR), '-'))) AS h
    FROM labels)))"""


@query("dataset_fingerprint", f"SELECT n_rows, dataset_hash FROM {_FINGERPRINT_SQL}")
def dataset_fingerprint(spark, sf):
    return rg.fingerprint(table(spark, sf, "labels"), "doc_id", ["quality", "toxic"])

# ---- changes between two versions ------------------------------------------------------------

REVISED = "o_orderkey % 499 = 0"
DROPPED = "o_orderkey % 997 = 1"
CHANGE_WIDTH = 64


def order_versions(spark, sf):
    """Orders, and a later version of them: some prices corrected, some orders taken out."""
    before = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    price = F.when(F.expr(REVISED), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return before, before.where(~F.expr(DROPPED)).withColumn("o_totalprice", price)


@query(
    "dataset_changes",
    f"""SELECT key_range * {CHANGE_WIDTH} AS first_key, key_range * {CHANGE_WIDTH} + {CHANGE_WIDTH - 1} AS last_key,
      n_before, n_after, n_revised, n_dropped
    FROM (SELECT o_orderkey // {CHANGE_WIDTH} AS key_range, count(*) AS n_before,
        count(*) FILTER (NOT {DROPPED}) AS n_after, count(*) FILTER ({REVISED} AND NOT {DROPPED}) AS n_revised,
        count(*) FILTER ({DROPPED}) AS n_dropped
      FROM orders GROUP BY ALL) WHERE n_revised + n_dropped > 0""",
)
def dataset_changes(spark, sf):
    """Ranges of order keys that differ between the versions, found by their trees, and how
    many keys of each range were revised or dropped, from rows of these ranges only."""
    versions, columns = order_versions(spark, sf), ["o_custkey", "o_orderstatus", "o_totalprice"]
    before, after = [ht.build(v, "o_orderkey", columns, CHANGE_WIDTH) for v in versions]
    ranges = ht.changed_ranges(before, after, CHANGE_WIDTH)
    keys = ht.changed_keys(*versions, "o_orderkey", columns, ranges, CHANGE_WIDTH)
    changes = keys.groupBy(ht.range_of(F.col("o_orderkey"), CHANGE_WIDTH).alias("node")).agg(
        F.count_if(F.col("change") == "changed").alias("n_revised"),
        F.count_if(F.col("change") == "removed").alias("n_dropped"),
    )
    return ranges.join(changes, "node").drop("node")


N_VERSIONS = 12
STEP = 250

_VERSIONS_CTE = f"""
ver AS (SELECT v AS version, {COUNTS_SQL} FROM (
    SELECT v, label, n_chars >= v * {STEP} AS pred
    FROM {LABELLED_SQL}, (SELECT unnest(range(1, {N_VERSIONS + 1})) AS v)) GROUP BY v),
versions AS (SELECT version::INT AS version, 'v' || version AS name,
    (version * {STEP})::INT AS min_chars, {RATIOS_SQL},
    (SELECT dataset_hash FROM {_FINGERPRINT_SQL}) AS dataset_hash FROM ver),
best AS (SELECT version, f1 >= max(f1) OVER (ORDER BY version) AS leads, recall FROM versions),
moves AS (SELECT 'staging' AS stage, version, version * 2 AS seq FROM best WHERE leads
  UNION ALL SELECT 'production', version, version * 2 + 1 FROM best WHERE leads AND recall >= 0.8),
current AS (SELECT stage, arg_max(version, seq)::INT AS version FROM moves GROUP BY stage)
"""


def model_versions(spark, sf):
    """One version per length rule, with its metrics and the data set's fingerprint."""
    data_hash = dataset_fingerprint(spark, sf).select("dataset_hash").scalar()
    y = F.col("label")
    aggs = []
    for v in range(1, N_VERSIONS + 1):
        for name, c in mt.counts(y, F.col("n_chars") >= v * STEP).items():
            aggs.append(c.alias(f"{name}{v}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(v).alias("version"),
                *[F.col(f"{n}{v}").alias(n) for n in ("tn", "fp", "fn", "tp")],
            )
            for v in range(1, N_VERSIONS + 1)
        ]
    )
    counted = labelled(spark, sf, "n_chars").agg(*aggs).select(F.inline(rows))
    ratios = mt.ratios(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    return counted.select(
        "version",
        (F.col("version") * STEP).cast("int").alias("min_chars"),
        *[F.round(c, 6).alias(n) for n, c in ratios.items()],
        data_hash.alias("dataset_hash"),
    )


def alias_events(versions):
    """A version that leads on f1 goes to staging, with enough recall to production.

    The window runs over the versions of the registry, one row each.
    """
    so_far = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, 0)
    leads = versions.withColumn("_best", F.max("f1").over(so_far)).where("f1 >= _best")
    move = lambda stage, extra: F.struct(
        F.lit(stage).alias("stage"),
        F.col("version"),
        (F.col("version") * 2 + extra).cast("bigint").alias("seq"),
    )
    both = F.when(F.col("recall") >= 0.8, F.array(move("staging", 0), move("production", 1))).otherwise(
        F.array(move("staging", 0))
    )
    return leads.select(F.inline(both))


@query(
    "registry_versions",
    f"""WITH {_VERSIONS_CTE} SELECT version, name, min_chars, accuracy, "precision", recall, f1,
      dataset_hash FROM versions""",
)
def registry_versions(spark, sf):
    return rg.versions_in_order(model_versions(spark, sf))


@query("registry_alias", f"WITH {_VERSIONS_CTE} SELECT stage, version FROM current")
def registry_alias(spark, sf):
    versions = model_versions(spark, sf)
    events = rg.valid_events(alias_events(versions), versions)
    return rg.current_aliases(events).select("stage", "version")


@query(
    "registry_report",
    f"""WITH {_VERSIONS_CTE} SELECT v.version, min_chars, accuracy, recall, f1,
      coalesce(stage, '') AS stage FROM versions v LEFT JOIN (
        SELECT version, string_agg(stage, ',' ORDER BY stage) AS stage FROM current
        GROUP BY version) c ON v.version = c.version""",
)
def registry_report(spark, sf):
    versions = model_versions(spark, sf)
    return rg.registry_report(versions, alias_events(versions)).select(
        "version", "min_chars", "accuracy", "recall", "f1", "stage"
    )


# ---- softmax and attention ---------------------------------------------------------------------


@query(
    "group_softmax",
    """SELECT event_id, user_id, round(exp(value - m) / sum(exp(value - m))
      OVER (PARTITION BY user_id), 6) AS softmax
      FROM (SELECT *, max(value) OVER (PARTITION BY user_id) AS m FROM events)""",
)
def softmax(spark, sf):
    ev = table(spark, sf, "events", "event_id", "user_id", "value")
    return group_softmax(ev, "user_id", "value", "event_id").select("event_id", "user_id", r6("softmax"))


SEQ = 32


@query(
    "attention_pool",
    f"""WITH e AS (SELECT vec_id // {SEQ} AS seq_id, vec_id % {SEQ} AS pos,
      list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    s AS (SELECT a.seq_id, a.pos, b.v AS v, list_dot_product(a.v, b.v) * 8 / sqrt(64) AS s
      FROM e a JOIN e b ON a.seq_id = b.seq_id),
    w AS (SELECT seq_id, pos, v, exp(s - max(s) OVER (PARTITION BY seq_id, pos)) AS w FROM s),
    d AS (SELECT seq_id, pos, w, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM w)
    SELECT seq_id, pos, (i - 1)::INT AS dim, round(sum(w * x) / sum(w) * 0.5, 6) AS output
    FROM d GROUP BY seq_id, pos, i""",
)
def attention_pool(spark, sf):
    import numpy as np

    eye = np.eye(64)
    rows = table(spark, sf, "embeddings", "vec_id", "embedding").select(
        F.floor(F.col("vec_id") / SEQ).alias("seq_id"),
        (F.col("vec_id") % SEQ).alias("pos"),
        "embedding",
    )
    out = self_attention(rows, "seq_id", "pos", "embedding", eye * 4, eye * 2, eye * 0.5)
    return out.select("seq_id", "pos", F.posexplode("output").alias("dim", "output")).select(
        "seq_id", "pos", "dim", r6("output")
    )
