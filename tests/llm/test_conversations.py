"""Conversation repair on Spark against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tandem.llm import conversations
from tandem.llm.queries import QUERIES

DIR = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = (
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
    "repaired_sha256",
)


def damaged(rows):
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def solve(rows):
    """All edits of one conversation's rows, by recursion: figures, audit, repaired rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        inked = re.findall(r"[^\x20\x09-\x0D]", text)
        if not inked:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif inked[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))

    def legal(initials):
        return re.fullmatch("(s?(ua)+)?", initials) is not None

    def alive(initials):
        return any(legal(initials + end) for end in ("", "a", "ua"))

    @lru_cache(None)
    def best(i, last, inserted):
        """Least (cost, letters, rows) for rows i on; ``last`` initial written."""
        written = {"": "", "s": "s", "u": "u", "a": "ua"}[last]
        out = []
        if i == len(rows) and legal(written):
            out.append((0, "", ()))
        options = []
        if inserted < 3:
            options += [("I", 3, r, "", i, inserted + 1) for r in ("user", "assistant")]
        if i < len(rows):
            _, _, role, text = rows[i]
            options.append(("D", 4, None, None, i + 1, 0))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                options.append(("K", more, role, text, i + 1, 0))
                options += [("R", 3 + more, r, text, i + 1, 0) for r in ("user", "assistant")]
        for letter, cost, role, text, then, count in options:
            now = last
            if role:
                if not alive(written + role[0]):
                    continue
                now = role[0]
            rest = best(then, now, count)
            if rest is not None:
                line = () if role is None else ((role, text),)
                out.append((cost + rest[0], letter + rest[1], line + rest[2]))
        return min(out) if out else None

    cost, audit, lines = best(0, "", 0) if rows else (0, "", ())
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    )


def brute(rows):
    rows = list(rows)
    groups = {r[0]: [] for r in rows}
    for r in damaged(rows):
        groups[r[0]].append(r)
    return sorted(((c, *solve(g)) for c, g in groups.items()), key=str)


def digest(df):
    return conversations.repair_digest(conversations.damage(df), df)


def collected(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_query_equals_plain_search(spark):
    rows = spark.read.parquet(f"{DIR}/conversations.parquet")
    want = brute(tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect())
    assert collected(QUERIES["op11_conversations"](spark, DIR)) == want
    assert sum(r[6] > 0 for r in want) > 20


def test_random_conversations(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "usher", "Sys"]
    texts = ["Yes.", "No!", "cut off", "", None, " \t", "Yes.", "é?", "a b\n", "x" * 70 + "1", "x" * 70 + "2."]
    rows = []
    for conv in [*range(300), None]:
        for turn in range(rng.randrange(0, 9)):
            turn = rng.choice([turn, turn, turn, turn + 1, None])
            row = (conv, turn, rng.choice(roles), rng.choice(texts))
            if any(r[:3] == row[:3] for r in rows):
                continue  # the order of other texts in one turn and role is by a hash
            rows += [row] * rng.choice([1, 1, 1, 2])
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert collected(digest(df)) == brute(rows)


def test_long_runs_split_over_many_parts(spark):
    """One conversation holds nearly all rows; its runs come from many sorted parts."""
    n = 30_000
    rows = [(1, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(n // 2)]
    rows += [(1, i, "user", f"same {i}.") for i in range(n // 2, n)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hello.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    plans = conversations.structure(df).orderBy("conv").collect()
    assert (plans[1].cost, plans[1].audit) == (0, "KK")
    # An insert before the first assistant, every second user of the rest reroled, one at the end.
    audit = plans[0].audit
    assert (audit.count("K"), audit.count("R"), audit.count("I")) == (n - n // 4, n // 4, 2)
    assert plans[0].cost == 3 * (n // 4 + 2)
    assert plans[0].illegal == n // 2 and plans[0].gaps == 0
    out = conversations.repaired(df, conversations.structure(df))
    due = F.when(F.col("pos") % 2 == 0, "user").otherwise("assistant")
    assert out.where("conv = 1").where(F.col("role") == due).count() == n + 2


@pytest.mark.parametrize("symbol", range(20))
def test_powers_equal_single_steps(symbol):
    to_go = conversations._AT_END
    for n in range(1, 40):
        to_go = conversations.advance(symbol, 1, to_go)
        ahead = conversations.advance(symbol, n, conversations._AT_END)
        assert [min(x, 10**9) for x in to_go] == [min(x, 10**9) for x in ahead]


def test_many_copies_of_one_row(spark):
    rows = [(1, 0, "user", "Hi.")] * 5000 + [(1, 1, "assistant", "Hello.")]
    out = conversations.structure(spark.createDataFrame(rows, SCHEMA)).first()
    assert out.audit == "K" + "D" * 4999 + "K" and out.duplicate == 4999


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert digest(empty).count() == 0 and conversations.structure(empty).count() == 0
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    wide = df
    for name in ("conv", "first", "msg", "head", "part", "symbol", "n", "kind", "audit", "cost", "at"):
        wide = wide.withColumn(name, F.lit("x"))
    assert collected(digest(wide)) == collected(digest(df)) == brute(rows)


def test_conversation_without_rows(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], SCHEMA)
    empty_hash = hashlib.sha256(b"").hexdigest()
    assert collected(digest(df)) == [(dropped, 0, 0, 0, 0, 0, 0, "", empty_hash)]
    assert digest(df).schema["audit"].dataType.simpleString() == "string"
