"""Pairwise judging of two texts: prompt, rubric score, strict verdict, double pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import computed
from ..functions.privacy import SAFETY_PATTERNS
from ..functions.strict_json import verdict
from ..functions.text import n_words

_EMAIL = dict(SAFETY_PATTERNS)["EMAIL"]

# The rubric and the delimiters of the judge prompt.
RUBRIC = (
    "Tu es le juge qualité. Compare deux lettres de\n"
    "motivation pour la même offre, selon ces critères par ordre d'importance :\n"
    "1. Les compétences requises par l'offre sont-elles mises en avant ?\n"
    "2. La lettre est-elle exempte de toute donnée personnelle (email, téléphone) ?\n"
    "3. La longueur est-elle raisonnable (50 à 200 mots) ?\n"
    'Réponds UNIQUEMENT en JSON : {"winner": "A" | "B" | "tie", "reason": "..."}'
)
SKILLS_LINE = "Compétences requises par l'offre : "
LETTER_A = "=== LETTRE A ==="
LETTER_B = "=== LETTRE B ==="


def judge_prompt(skills: Column, letter_a: Column, letter_b: Column) -> Column:
    return F.concat(
        F.lit(f"{RUBRIC}\n\n{SKILLS_LINE}"), F.array_join(skills, ", "),
        F.lit(f"\n\n{LETTER_A}\n"), letter_a, F.lit(f"\n\n{LETTER_B}\n"), letter_b,
    )


def rubric_score(skills: Column, letter: Column) -> Column:
    """Two points per required skill found, minus ten for an email, one for length."""
    low = F.lower(letter)
    found = F.size(F.filter(skills, lambda s: F.contains(low, F.lower(s))))
    return (
        2 * found
        - F.when(letter.rlike(_EMAIL), 10).otherwise(0)
        + F.when(n_words(letter).between(50, 200), 1).otherwise(0)
    )


def heuristic_verdict(score_a: Column, score_b: Column) -> Column:
    """Verdict document of the rubric judge."""
    winner = (
        F.when(score_a > score_b, "A").when(score_b > score_a, "B").otherwise("tie")
    )
    reason = F.concat(
        F.lit("scores grille A="), score_a.cast("string"),
        F.lit(", B="), score_b.cast("string"),
    )
    return F.to_json(F.struct(winner.alias("winner"), reason.alias("reason")))


def biased_verdict() -> Column:
    """Verdict document of a judge that always prefers the first position."""
    return F.to_json(
        F.struct(F.lit("A").alias("winner"), F.lit("position").alias("reason"))
    )


def double_pass(first: Column, second: Column) -> Column:
    """Winner of two passes, the second one judged in swapped order.

    Both arguments are parsed verdicts; a NULL one makes the result NULL.
    """
    unswapped = F.when(second == "A", "B").when(second == "B", "A").otherwise(second)
    return F.when(first.isNull() | second.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(first == unswapped, first).otherwise("tie")
    )


def judge_pairs(duels: DataFrame) -> DataFrame:
    """Rubric verdict of ``duels(duel_id, skills, letter_a, letter_b)`` in two passes."""
    scored = computed(
        duels,
        {
            "score_a": rubric_score(F.col("skills"), F.col("letter_a")),
            "score_b": rubric_score(F.col("skills"), F.col("letter_b")),
        },
    )
    a, b = F.col("score_a"), F.col("score_b")
    return computed(
        scored,
        {
            "first": verdict(heuristic_verdict(a, b)),
            "second": verdict(heuristic_verdict(b, a)),
        },
    ).withColumn("winner", double_pass(F.col("first"), F.col("second")))


def both_passes(
    prompts: DataFrame, judge, skills="skills", letter_a="letter_a", letter_b="letter_b"
) -> DataFrame:
    """Run any judge, a Column-to-Column function over prompts, in both orders."""
    s, a, b = F.col(skills), F.col(letter_a), F.col(letter_b)
    return computed(
        prompts,
        {
            "first": verdict(judge(judge_prompt(s, a, b))),
            "second": verdict(judge(judge_prompt(s, b, a))),
        },
    ).withColumn("winner", double_pass(F.col("first"), F.col("second")))
