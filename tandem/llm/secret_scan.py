"""Secret scans with corpus-wide ownership, as Spark expressions throughout.

Candidates are found by fixed patterns. What each holds is hashed, and the hashes are
counted over the whole corpus by the distinct repositories and owners that have them. A
value that many owners have is an example that was copied from page to page; a value of
one owner that also looks random is a live credential. Patterns of the contract always
stay; further kinds are added as spans only where their value is live by that count.

Only texts with a candidate go through the positions, and only hashes and owners are
shuffled, never texts. Counting is by distinct (hash, owner, repository) with partial
aggregation, so a value copied a million times meets as one row for each task.

Defined results: a null or empty text has no spans. Repeated rows each get a row and count
once for their owner. A row without owner or repository counts as an owner of its own
called null. Positions are code points, the end exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import row_key, sha256_of, stage_table

# Fixed patterns of the contract. The minimal lengths are checked after the match, on
# ``assign`` the length of its value.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = (
    ("assign", ASSIGN, 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
# Further kinds: public formats of access tokens and private keys.
ADDED = (
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("bearer", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 26),
    ("uphex", r"[0-9A-F]{32,}", 0, 32),
    ("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 0, 27),
)
# A private key goes on after its first line to its END, or else over the base64 lines there
# are: at most 1,000, and as many lines of a removed file, as each repeat takes stack. The
# value is its base64 however it is broken into lines; a first line alone is its own value.
_PEM_END = r"(?:[A-Za-z0-9+/=\s\\\x22',:#>*|]++|-(?!-)){0,1000}+-{5,6}END (?:[A-Z]+ )?PRIVATE KEY-----"
_PEM_LINES = r"(?:(?:\s|\\[nr])*+[+>#-]?\x20*+[A-Za-z0-9+/=]{32,}+){1,1000}+(?:\s*+[A-Za-z0-9+/]++={1,2})?"
PEM_BLOCK = rf"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----(?:{_PEM_END}|{_PEM_LINES})?"
_PEM_FRAME = (
    r"-{5,6}(?:BEGIN|END) (?:[A-Z]+ )?PRIVATE KEY-----|(?:Proc-Type|DEK-Info):[^\n\\]*"
    r"|(?m:^\+)|\\[nr]|[^A-Za-z0-9+/=]"
)
KINDS = tuple(k for k, *_ in BASE + ADDED)
#: A value with more owners than this is a copied example.
MAX_OWNERS = 1
#: What stands for a secret in a masked text.
MASK = "[redacted]"
#: Distinct characters from which a value looks random.
MIN_CHARACTERS = 8


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """All matches of one kind as structs, leftmost first and not overlapping.

    The text is what stands between the matches and the matches, in turn, so lengths
    added up give the positions.
    """
    whole = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    values = (
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    )
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), whole.alias("found"), values.alias("value")
    )
    kept = F.lit(KINDS.index(kind))
    zero = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>").alias("out"),
    )

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["found"]), F.lit(0))
        span = F.struct(
            start.alias("start"), kept.alias("rank"), end.alias("end"), x["value"].alias("value")
        )
        ok = F.coalesce(F.length(x["value"]) >= least, F.lit(False))
        return F.struct(
            end.alias("at"),
            F.when(ok, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(pieces, zero, step, lambda acc: acc["out"])


def _key_body(value: Column) -> Column:
    body = F.regexp_replace(value, _PEM_FRAME, "")
    return F.when(body == "", value).otherwise(body)


def may_have(text: Column, patterns=BASE + ADDED) -> Column:
    """Whether any pattern is in the text at all."""
    return F.coalesce(
        reduce(lambda a, b: a | b, (text.rlike(p) for _, p, *_ in patterns)), F.lit(False)
    )


def all_spans(text: Column) -> Column:
    """Spans of every kind, sorted by start and then by kind."""
    of = lambda kind, pattern, *k: _spans(text, kind, PEM_BLOCK if kind == "pem" else pattern, *k)
    keys = F.transform(
        of(*ADDED[-1]), lambda s: s.withField("value", _key_body(s["value"]))
    )
    return F.array_sort(F.concat(*(of(*k) for k in BASE + ADDED[:-1]), keys))


def ownership(found: DataFrame) -> DataFrame:
    """``value_hash``, ``n_repos``, ``n_owners`` of (value_hash, owner, repo) rows."""
    named = found.select(
        "value_hash",
        F.coalesce(F.col("owner").cast("string"), F.lit("\0null")).alias("owner"),
        F.coalesce(F.col("repo").cast("string"), F.lit("\0null")).alias("repo"),
    ).distinct()
    owners = named.groupBy("value_hash", "owner").agg(F.count("*").alias("repos"))
    return owners.groupBy("value_hash").agg(
        F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners")
    )


def looks_random(value: Column) -> Column:
    return F.size(F.array_distinct(F.split(value, ""))) >= MIN_CHARACTERS


def scan(
    docs: DataFrame, doc_id: str, text: str, owner: Column, repo: Column,
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """One row for each row of ``docs``: ``row`` (a number of its own), ``doc_id`` and
    ``found``, the spans by start and kind, each with ``value``, ``n_owners``, ``n_repos``
    and ``live``. The texts are read once; their spans are staged."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
        owner.alias("owner"), repo.alias("repo"), F.col(text).alias("text"),
    )
    spans = F.when(may_have(F.col("text")), all_spans(F.col("text")))
    rows = rows.select("row", "doc_id", "owner", "repo", F.explode_outer(spans).alias("s"))
    rows = stage_table(
        rows.withColumn("value_hash", F.sha2(F.col("s.value").cast("binary"), 256)), "spans"
    )
    counts = ownership(rows.where("s is not null"))
    live = (F.col("n_owners") <= max_owners) & looks_random(F.col("s.value"))
    span = F.struct(
        F.col("s.start").alias("start"), F.col("s.rank").alias("rank"), F.col("s.end").alias("end"),
        F.col("s.value").alias("value"), "n_owners", "n_repos", live.alias("live"),
    )
    # A row without spans keeps a key that no value has, so that such rows spread.
    rows = rows.withColumn("value_hash", F.coalesce("value_hash", F.col("row").cast("string")))
    return (
        rows.join(counts, "value_hash", "left")
        .groupBy("row", "doc_id")
        .agg(F.array_sort(F.collect_list(F.when(F.col("s").isNotNull(), span))).alias("found"))
    )


def kept_spans(found: Column) -> Column:
    """Spans of the contract, and those of further kinds whose value is live."""
    return F.filter(found, lambda s: (s["rank"] < len(BASE)) | s["live"])


def redact(text: Column, spans: Column) -> Column:
    """``text`` with what the sorted ``spans`` cover replaced by ``MASK``."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        free = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(free, F.concat(acc["out"], gap, F.lit(MASK))).otherwise(acc["out"]).alias("out"),
        )

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.aggregate(spans, zero, step, rest)


def mask_secrets(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """``docs`` with the kept spans of their texts masked and ``n_chars`` made anew.

    Only texts with a candidate are joined with their spans; the others stay in place.
    """
    key = row_key(F.col("doc_id"), F.col("text"))
    hits = docs.where(may_have(F.col("text")))
    keyed = hits.select(key.alias("doc_id"), F.col("text"), owner.alias("o"), repo.alias("r"))
    found = scan(keyed, "doc_id", "text", F.col("o"), F.col("r"))
    spans = found.groupBy(F.col("doc_id").alias("_row_key")).agg(
        F.first(kept_spans(F.col("found"))).alias("_spans")
    )
    masked = hits.join(spans, key == F.col("_row_key"))
    masked = masked.withColumn("text", redact(F.col("text"), F.col("_spans")))
    masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.where(~may_have(F.col("text"))).unionByName(masked.select(docs.columns))


def _text_of(spans: Column) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"),
                s["end"].cast("string"),
            ),
        ),
        ",",
    )


def secret_scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: Column | None = None,
    repo: Column | None = None,
) -> DataFrame:
    """One row of counts and spans for each row of ``docs``."""
    owner = F.lit(None) if owner is None else owner
    repo = owner if repo is None else repo
    found = scan(docs, doc_id, text, owner, repo)
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    count = lambda test: F.size(F.filter("found", test)).cast("long")
    of_kind = lambda i: count(lambda s: s["rank"] == i)
    return found.select(
        "doc_id",
        *(of_kind(i).alias(f"n_{kind}") for i, (kind, *_) in enumerate(BASE)),
        sha256_of(_text_of(base)).alias("base_sha256"),
        _text_of(kept_spans(F.col("found"))).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: s["n_owners"] > MAX_OWNERS).alias("n_copied"),
    )
