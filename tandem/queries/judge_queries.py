"""Strict verdicts and pairwise judging of conversation turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.strict_json import verdict
from ..operators import judge as jd
from ..sources.tables import table
from .base import WORD, query, sql_words
from .privacy_queries import _EMAIL

_RAW_SQL = """CASE event_type
  WHEN 'click' THEN '{"winner":"A","reason":"' || user_id || '"}'
  WHEN 'view' THEN '{"winner": "B", "reason": "x"}'
  WHEN 'error' THEN '{"winner":"C","reason":"x"}'
  WHEN 'purchase' THEN '{"winner":"tie"} merci'
  WHEN 'signup' THEN 'Verdict : ' || props ELSE props END"""


@query(
    "judge_parse",
    f"""SELECT event_id, CASE WHEN json_valid(raw) THEN CASE
      WHEN json_extract_string(raw, '$.winner') IN ('A', 'B', 'tie')
      THEN json_extract_string(raw, '$.winner') END END AS winner
    FROM (SELECT event_id, {_RAW_SQL} AS raw FROM events)""",
)
def judge_parse(spark, sf):
    ev = table(spark, sf, "events", "event_id", "event_type", "user_id", "props")
    kind = F.col("event_type")
    raw = (
        F.when(
            kind == "click",
            F.concat(F.lit('{"winner":"A","reason":"'), F.col("user_id").cast("string"), F.lit('"}')),
        )
        .when(kind == "view", F.lit('{"winner": "B", "reason": "x"}'))
        .when(kind == "error", F.lit('{"winner":"C","reason":"x"}'))
        .when(kind == "purchase", F.lit('{"winner":"tie"} merci'))
        .when(kind == "signup", F.concat(F.lit("Verdict : "), F.col("props")))
        .otherwise(F.col("props"))
    )
    return ev.select("event_id", raw.alias("raw")).select("event_id", verdict(F.col("raw")).alias("winner"))


_DUELS_CTE = f"""
t AS (SELECT conv_id, turn, role, text FROM conversations),
duels AS (SELECT a.conv_id || '/' || a.turn AS duel_id,
    list_sort(list_distinct(regexp_extract_all(lower(u.text), '{WORD}{{4,}}'))) AS skills,
    a.text AS letter_a, b.text AS letter_b
  FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 2
  JOIN t u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1
  WHERE a.role = 'assistant' AND b.role = 'assistant' AND u.role = 'user')
"""


def _score_sql(letter: str) -> str:
    return f"""(2 * len(list_filter(skills, lambda s: contains(lower({letter}), lower(s))))
      - CASE WHEN regexp_matches({letter}, '{_EMAIL}') THEN 10 ELSE 0 END
      + CASE WHEN len({sql_words(letter)}) BETWEEN 50 AND 200 THEN 1 ELSE 0 END)::INT"""


def duels(spark, sf):
    """An assistant turn against the next one; skills are words of the user's turn.

    Turns meet on (conversation, turn), which is unique, so a long conversation is
    spread like any other rows.
    """
    t = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    a = t.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("letter_a"))
    b = t.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 2).alias("turn"), F.col("text").alias("letter_b")
    )
    words = F.regexp_extract_all(F.lower("text"), F.lit(rf"({WORD}{{4,}})"), 1)
    u = t.where("role = 'user'").select(
        "conv_id",
        (F.col("turn") + 1).alias("turn"),
        F.array_sort(F.array_distinct(words)).alias("skills"),
    )
    return a.join(b, ["conv_id", "turn"]).join(u, ["conv_id", "turn"]).select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("duel_id"),
        "skills", "letter_a", "letter_b",
    )


@query(
    "judge_pairs",
    f"""WITH {_DUELS_CTE} SELECT duel_id, a AS score_a, b AS score_b,
      CASE WHEN a > b THEN 'A' WHEN b > a THEN 'B' ELSE 'tie' END AS winner
    FROM (SELECT duel_id, {_score_sql('letter_a')} AS a, {_score_sql('letter_b')} AS b FROM duels)""",
)
def judge_pairs(spark, sf):
    return jd.judge_pairs(duels(spark, sf)).select("duel_id", "score_a", "score_b", "winner")


_q = lambda s: "'" + s.replace("'", "''") + "'"


@query(
    "judge_prompt",
    f"""WITH {_DUELS_CTE} SELECT duel_id, {_q(jd.RUBRIC)} || chr(10) || chr(10) ||
      {_q(jd.SKILLS_LINE)} || array_to_string(skills, ', ') || chr(10) || chr(10) ||
      {_q(jd.LETTER_A)} || chr(10) || letter_a || chr(10) || chr(10) ||
      {_q(jd.LETTER_B)} || chr(10) || letter_b AS prompt FROM duels""",
)
def judge_prompt(spark, sf):
    s, a, b = F.col("skills"), F.col("letter_a"), F.col("letter_b")
    return duels(spark, sf).select("duel_id", jd.judge_prompt(s, a, b).alias("prompt"))


@query(
    "judge_bias_control",
    f"""WITH {_DUELS_CTE} SELECT duel_id, 'A' AS single_pass, 'tie' AS double_pass FROM duels""",
)
def judge_bias_control(spark, sf):
    out = jd.both_passes(duels(spark, sf), lambda prompt: jd.biased_verdict())
    return out.select(
        "duel_id", F.col("first").alias("single_pass"), F.col("winner").alias("double_pass")
    )
