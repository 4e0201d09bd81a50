"""URL filters: rules by host and path, and a word model for the rest.

A rule fits its host and all subdomains if the path starts with the rule's; the longest
wins. Where no rule fits, the host's labels are split into words by unigram Viterbi and a
multinomial naive Bayes model scores these words with the tokens of the path. Word counts
come from the text of all pages; the Bayes model learns from all urls that a rule decides,
and a list of seed words counts as seen in blocked ones. Its tokens are hashed to
``2 ** TOKEN_BITS`` places, so the model sent to the tasks has a fixed size.

Distinct labels are split once, distinct hosts are matched with rules once, and both are
joined back with the keys that hold a large share of the rows spread over salts. A label
meets only the word counts of its own substrings, never the whole dictionary.

Defined results: a null url, or one without ``://``, has an empty host and path. An equal
verdict of both classes is allow. Without urls that a rule decides, the seeds alone decide.
Repeated rows each get a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import heavy_keys, salted_join
from .tables import fold_ascii, stage_table

# The rules of the contract: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Words of hosts that are known as unwanted, and how often each counts as seen.
SEED_WORDS = (
    "ads", "adult", "bet", "bets", "bonus", "casino", "cheap", "click", "free", "loan", "pills",
    "poker", "porn", "promo", "track", "viagra", "win",
)
SEED_WEIGHT = 50.0

#: Letters of the longest word that a label is split into.
MAX_WORD = 20
TOKEN_BITS = 18
SMOOTHING = 1.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    return (
        fold_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def word_counts(html: DataFrame) -> DataFrame:
    """``word`` and ``n``: lower-case words of letters in the text of pages (html)."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<script.*?</script>|<[^>]*>", " ")
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))
    return (
        html.select(F.explode(words).alias("word"))
        .where(F.length("word") <= MAX_WORD)
        .groupBy("word").agg(F.count("*").alias("n"))
    )


def segment(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest words that ``label`` consists of.

    An unknown word gets a tenth of the chance for each letter it has; of equally likely
    splits the one with the longer last word wins.
    """
    best: list[tuple[float, int]] = [(0.0, 0)]
    total = max(total, 1)
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - MAX_WORD), end):
            word = label[start:end]
            n = counts.get(word)
            chance = math.log10(n / total) if n else -math.log10(total) - len(word)
            options.append((best[start][0] + chance, -start))
        score, start = max(options)
        best.append((score, -start))
    words, end = [], len(label)
    while end:
        start = best[end][1]
        words.append(label[start:end])
        end = start
    return words[::-1]


def split_labels(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """``label`` and ``words`` of distinct ``label`` of letters."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ends = F.sequence(F.lit(1), F.length("label"))
    lengths = F.sequence(F.lit(1), F.lit(MAX_WORD))
    parts = F.flatten(
        F.transform(
            ends,
            lambda i: F.transform(lengths, lambda n: F.substring(F.col("label"), i, n)),
        )
    )
    known = (
        labels.select("label", F.explode(F.array_distinct(parts)).alias("word"))
        .join(counts, "word")
        .groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    )

    def run(batches):
        for batch in batches:
            words = []
            for label, own in zip(*(batch.column(c).to_pylist() for c in ("label", "known"))):
                words.append(segment(label, {w["word"]: w["n"] for w in own or ()}, total))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(words, pa.list_(pa.string()))],
                names=["label", "words"],
            )

    return labels.join(known, "label", "left").mapInArrow(run, "label string, words array<string>")


def _by_key(rows: DataFrame, table: DataFrame, key: str, spread: Column) -> DataFrame:
    """Left join on ``key``; keys with a large share of ``rows`` are salted."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return salted_join(rows, table, key, heavy_keys(counts, key, "n"), spread, "left")


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host`` and ``words`` of distinct ``host``: its labels' words in order."""
    pieces = F.filter(F.split("host", r"[^\p{L}]+"), lambda x: x != "")
    rows = hosts.select("host", F.posexplode(pieces).alias("at", "label"))
    rows = stage_table(rows, "labels")
    words = stage_table(split_labels(rows.select("label").distinct(), counts), "segments")
    return (
        _by_key(rows, words, "label", F.xxhash64("host"))
        .groupBy("host")
        .agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("w"))
        .select("host", F.flatten("w.words").alias("words"))
    )


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and the rules (host, path, verdict) of it and of the domains above it."""
    parts = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )
    rows = hosts.select("host", F.explode(F.array_distinct(above)).alias("up"))
    table = rules.select(F.col("host").alias("up"), "path", "verdict").groupBy("up").agg(
        F.collect_list(F.struct(F.concat("up", "path").alias("rule"), "path", "verdict")).alias("r")
    )
    return (
        _by_key(rows, table, "up", F.xxhash64("host"))
        .groupBy("host").agg(F.flatten(F.collect_list("r")).alias("rules"))
    )


def longest_rule(rules: Column, path: Column) -> Column:
    """The fitting rule with the longest text; of equal ones a block before an allow."""
    fit = F.filter(F.coalesce(rules, F.array().cast("array<struct<rule:string,path:string,verdict:string>>")),
                   lambda r: F.startswith(path, r["path"]))
    ranked = F.transform(
        fit,
        lambda r: F.struct(
            F.length(r["rule"]).alias("n"), (r["verdict"] == "block").alias("b"),
            r["rule"].alias("rule"), r["verdict"].alias("verdict"),
        ),
    )
    return F.array_max(ranked)


def path_tokens(path: Column) -> Column:
    """Tokens of a path; a number is one token whatever its value."""
    tokens = F.regexp_extract_all(F.lower(path), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return F.transform(
        tokens, lambda t: F.concat(F.lit("/"), F.regexp_replace(t, r"^\p{N}+$", "0"))
    )


def places(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(1 << TOKEN_BITS)).cast("int"))


def learn(decided: DataFrame, seeds: Iterable[str] = SEED_WORDS) -> tuple[np.ndarray, float]:
    """Log odds of block to allow for each token place, and those of the classes.

    ``decided``: ``places`` and ``block``. What is fetched is two counts for each place.
    """
    counts = np.zeros((2, 1 << TOKEN_BITS))
    rows = decided.select(F.explode("places").alias("place"), "block").groupBy("place", "block")
    for place, block, n in rows.count().collect():
        counts[int(block), place] += n
    seeds = list(seeds)
    if seeds:
        spark = decided.sparkSession
        made = spark.createDataFrame([(s,) for s in seeds], "s string")
        for (place,) in made.select(places(F.array("s"))[0]).collect():
            counts[1, place] += SEED_WEIGHT
    smooth = counts + SMOOTHING
    odds = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    by_class = dict(decided.groupBy("block").count().collect())
    prior = math.log((by_class.get(True, 0) + 1) / (by_class.get(False, 0) + 1))
    return odds.astype(np.float32), prior


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and the model's ``log_odds`` of
    every row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = stage_table(urls, "urls")
    hosts = stage_table(urls.select("host").distinct(), "hosts")
    counts = stage_table(word_counts(pages.select("html")), "word_counts")
    rule_rows = spark.createDataFrame([*rules], "verdict string, host string, path string")
    table = host_words(hosts, counts).join(host_rules(hosts, rule_rows), "host", "full")
    table = stage_table(table, "host_table")

    joined = _by_key(urls, table, "host", F.xxhash64("page_id", "path"))
    empty = F.array().cast("array<string>")
    tokens = F.concat(F.coalesce("words", empty), path_tokens(F.col("path")))
    judged = joined.select(
        "page_id", "host", "path", longest_rule(F.col("rules"), F.col("path")).alias("r"),
        places(tokens).alias("places"),
    ).select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("own"), "places")
    judged = stage_table(judged, "judged_urls")

    decided = judged.where("own is not null").select("places", (F.col("own") == "block").alias("block"))
    odds, prior = learn(decided)
    shared = spark.sparkContext.broadcast(odds)

    def run(batches):
        for batch in batches:
            lists = batch.column("places")
            value = shared.value[lists.flatten().to_numpy()].astype(float)
            ends = np.concatenate([[0], np.cumsum(value)])
            n = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            score = prior + ends[n[1:]] - ends[n[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "host", "path", "rule", "own")), pa.array(score)],
                names=["page_id", "host", "path", "rule", "own", "log_odds"],
            )

    kind = judged.schema["page_id"].dataType.simpleString()
    scored = judged.mapInArrow(
        run, f"page_id {kind}, host string, path string, rule string, own string, log_odds double"
    )
    by_model = F.when(F.col("log_odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("own", by_model).alias("verdict"), "log_odds"
    )
