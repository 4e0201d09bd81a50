"""Text expressions: Unicode-aware stripping, folding, tokens, chunks.

Character classes are written out so that the JVM and an RE2 engine read the same
pattern the same way.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# The characters Python treats as white space.
WS = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WORD = r"[\p{L}\p{N}_]"
# Text without any of these is already in NFC form.
NFC_GATE = r"[^\x00-\x{2ff}]"

# Strings that stand for a missing text.
MISSING_MARKERS = ("", "n/a", "na", "null", "-")

# The technical lexicon and the keywords of the rule classifier.
TECH_WORDS = (
    "python", "sql", "docker", "api", "rest", "git", "linux", "react",
    "kubernetes", "django", "postgresql", "ci/cd", "backend", "frontend",
)
SKILL_KEYWORDS = (
    "python", "javascript", "docker", "sql", "git",
    "linux", "api", "react", "kubernetes",
)

# Full case foldings that lower-casing alone does not make.
FOLDINGS = (
    ("ß", "ss"), ("ς", "σ"), ("ſ", "s"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"),
    ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"),
)


def _nfc_udf():
    @F.pandas_udf("string")
    def nfc(s: pd.Series) -> pd.Series:
        import unicodedata

        return s.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    return nfc


def nfc(text: Column) -> Column:
    """NFC form. Only text with characters at or above U+0300 reaches Python."""
    gated = F.when(text.rlike(NFC_GATE), text)
    return F.coalesce(_nfc_udf()(gated), text)


def collapse(text: Column) -> Column:
    """Turn each run of white space into one space and strip the ends."""
    return F.trim(F.regexp_replace(text, f"{WS}+", " "))


def normalize(text: Column) -> Column:
    return collapse(nfc(text))


def casefold(text: Column) -> Column:
    """Case-insensitive comparison key."""
    folded = F.lower(text)
    for src, dst in FOLDINGS:
        folded = F.replace(folded, F.lit(src), F.lit(dst))
    gate = "[" + "".join(src for src, _ in FOLDINGS) + "]"
    low = F.lower(text)
    return F.when(low.rlike(gate), folded).otherwise(low)


def is_missing(text: Column) -> Column:
    """NULL, or nothing but a marker between white space; fails at the first letter."""
    marks = "|".join(m for m in MISSING_MARKERS if m)
    return text.isNull() | text.rlike(f"(?i)^{WS}*(?:{marks})?{WS}*$")


def words(text: Column) -> Column:
    """White-space separated words; an empty text has none."""
    return F.filter(F.split(text, f"{WS}+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text))


def years_before(text: Column, unit: str = "ans") -> Column:
    """First number followed by white space and the unit word, else 0."""
    found = F.regexp_extract(text, rf"(\p{{Nd}}+){WS}+{unit}(?!{WORD})", 1)
    return F.coalesce(F.nullif(found, F.lit("")).try_cast("int"), F.lit(0))


def lexicon_count(text: Column, lexicon=TECH_WORDS) -> Column:
    """How many words, repeats included, belong to the lexicon."""
    lex = F.array(*[F.lit(w) for w in sorted(lexicon)])
    parts = F.split(F.lower(text), rf"(?:{WS}|[,:;'])+")
    return F.size(F.filter(parts, lambda w: F.array_contains(lex, w)))


def has_keyword(text: Column, keywords=SKILL_KEYWORDS) -> Column:
    """True if a keyword stands as a whole word once commas count as spaces."""
    parts = words(F.replace(F.lower(text), F.lit(","), F.lit(" ")))
    return F.arrays_overlap(parts, F.array(*[F.lit(k) for k in sorted(keywords)]))


def tokens(text: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"({WORD}{{2,}})"), 1)


def bigrams(toks: Column) -> Column:
    def pairs(t: Column) -> Column:
        n = F.greatest(F.size(t) - 1, F.lit(0))
        return F.zip_with(
            F.slice(t, 1, n), F.slice(t, 2, n), lambda a, b: F.concat_ws(" ", a, b)
        )

    return let(toks, pairs)


def ngrams_1_2(toks: Column) -> Column:
    return let(toks, lambda t: F.concat(t, bigrams(t)))


def chunks(text: Column, max_words: int = 40, overlap: int = 10) -> Column:
    """Overlapping word windows; a text of at most ``max_words`` words is kept as is."""
    if not 0 <= overlap < max_words:
        raise ValueError("overlap must be at least 0 and below max_words")
    step = max_words - overlap

    def windows(w: Column) -> Column:
        n = F.size(w)
        last = F.ceil((n - max_words) / F.lit(step)).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.array_join(F.slice(w, i * step + 1, max_words), " "),
        )
        return F.when(n <= max_words, F.array(text)).otherwise(cut)

    return let(words(text), windows)


def pretokens(text: Column) -> Column:
    """Word and punctuation pieces in reading order."""
    return F.regexp_extract_all(text, F.lit(rf"({WORD}+|[^\p{{L}}\p{{N}}_\s]+)"), 1)
