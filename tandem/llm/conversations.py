"""Conversation structure repair by a run-length dynamic program.

A conversation's rows, in order, become symbols: the class of the role's first letter
and the row's first fault. Equal neighbours collapse into runs. Each symbol is a min-plus
matrix over the states of ``(s?(ua)+)?``; a run of n rows advances the costs by the binary
powers of its matrix, cached for all conversations of a task, and the choices of the
cheapest edits are unrolled run by run. Runs are made wherever a global sort put the rows,
so a conversation of any size is read by many tasks; only its runs meet in one group, and
they are smaller than the one audit string that it must return.

Order: by turn (nulls first), then role, then the first ``HEAD`` characters of the text,
then a hash of role and text. Faults, the first that fits: ``blank`` (only spaces),
``duplicate`` (role and text of an earlier row), ``truncated`` (the last character that is
no space is none of ``.!?``). Edits: K(eep) 0, R(erole) 3, D(elete) 4, which a blank or
duplicate row must be, I(nsert) 3; a truncated row that stays adds 3. Of the cheapest edits
the least string by ASCII counts. The letters fix every state, so they fix the repaired rows.

Defined results: a null role or text is one space, and such a text is blank; rows without
a conversation are one conversation. A role without letters adds nothing to the initials:
it may be kept anywhere. Repeated rows are rows of one turn, all but one duplicates.
An empty table gives no conversation. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import heavy_keys, salted_join
from .tables import stage_table

HEAD = 64
RUN_PARTS = 64

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FINE, BLANK, DUPLICATE, CUT = range(4)
SYSTEM, USER, ASSISTANT, OTHER, NO_ROLE = range(5)
_LETTERS = "sua"

#: States: nothing yet, after s, after u, after a. An accepted row ends in 0 or 3.
STATES, ACCEPTED = 4, (0, 3)
_FAR = np.int64(1) << 60
#: State after a role's class, by state; -1 where it may not follow.
_AFTER = {
    SYSTEM: (1, -1, -1, -1), USER: (2, 2, -1, 2), ASSISTANT: (-1, -1, 3, -1),
    OTHER: (-1, -1, -1, -1), NO_ROLE: (0, 1, 2, 3),
}
#: State after a rerole or an insert: whichever of user and assistant may follow.
_GIVEN = (2, 2, 3, 2)
_GIVEN_ROLE = ("user", "user", "assistant", "user")


@lru_cache(maxsize=None)
def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """What may be done with a row, as (letter, cost, state after it), by letter."""
    role, fault = divmod(symbol, 4)
    out = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = TRUNCATED * (fault == CUT)
    if _AFTER[role][state] >= 0:
        out.append(("K", KEEP + extra, _AFTER[role][state]))
    out.append(("R", REROLE + extra, _GIVEN[state]))
    return out


def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), _FAR)


def _step() -> np.ndarray:
    """Any number of inserts."""
    one = np.full((STATES, STATES), _FAR)
    np.fill_diagonal(one, 0)
    for state, after in enumerate(_GIVEN):
        one[state, after] = min(one[state, after], INSERT)
    return min_plus(min_plus(one, one), one)


_INSERTS = _step()
_AT_END = tuple(_INSERTS[:, list(ACCEPTED)].min(axis=1).tolist())


@lru_cache(maxsize=None)
def power(symbol: int, bit: int) -> np.ndarray:
    """The min-plus matrix of 2 ** bit rows of a symbol, inserts before each."""
    if bit:
        half = power(symbol, bit - 1)
        return min_plus(half, half)
    row = np.full((STATES, STATES), _FAR)
    for state in range(STATES):
        for _, cost, after in choices(symbol, state):
            row[state, after] = min(row[state, after], cost)
    return min_plus(_INSERTS, row)


@lru_cache(maxsize=None)
def _rows(symbol: int, bit: int) -> tuple:
    return tuple(tuple(int(x) for x in row) for row in power(symbol, bit))


def advance(symbol: int, n: int, to_go: tuple) -> tuple:
    """Cost to go before ``n`` rows of a symbol, from that after them."""
    bit = 0
    while n >> bit:
        if n >> bit & 1:
            a, b, c, d = to_go
            to_go = tuple(
                min(p + a, q + b, r + c, s + d) for p, q, r, s in _rows(symbol, bit)
            )
        bit += 1
    return to_go


def _unroll(symbol: int, n: int, state: int, after: tuple, out: list[str]) -> int:
    """Append the letters of a run's cheapest edits; return the state they end in."""
    blocks, left = [], n
    # Costs to go at every 1024 rows by powers, those between them row by row.
    while left:
        size = min(left, 1024)
        blocks.append((size, after))
        after = advance(symbol, size, after)
        left -= size
    for size, end in reversed(blocks):
        costs = [end]
        for _ in range(size):
            costs.append(advance(symbol, 1, costs[-1]))
        for left in range(size, 0, -1):
            done = False
            while not done:
                best = costs[left][state]
                moves = [(*c, True) for c in choices(symbol, state)]
                moves.append(("I", INSERT, _GIVEN[state], False))
                for letter, cost, then, done in sorted(moves):
                    rest = costs[left - 1][then] if done else costs[left][then]
                    if cost + rest == best:
                        break
                out.append(letter)
                state = then
    return state


def cheapest(runs: list[list[int]]) -> tuple[int, str]:
    """Cost and audit of runs (symbol, length)."""
    after = [_AT_END]
    for s, n in reversed(runs):
        after.append(advance(s, n, after[-1]))
    cost = after.pop()[0]
    state, out = 0, []
    for s, n in runs:
        state = _unroll(s, n, state, after.pop(), out)
    while state not in ACCEPTED:
        out.append("I")
        state = _GIVEN[state]
    return cost, "".join(out)


# --- rows ---------------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults, dealt by a checksum of ``conv_id:turn``: a twentieth each
    is dropped, emptied, loses its ``.!?``, is repeated, or becomes the user's."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = rows.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", ""))
        .otherwise(text).alias("text"),
        kind.alias("kind"),
    ).where("kind != 0")
    return rows.withColumn(
        "kind", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    ).drop("kind")


def _ordered(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, head, msg, text): what a row is sorted and compared by."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return rows.select(
        F.col("conv_id").alias("conv"), F.col("turn"), role.alias("role"),
        F.substring(text, 1, HEAD).alias("head"), F.unhex(F.md5(whole.cast("binary"))).alias("msg"),
        text.alias("text"),
    )


_ORDER = ("conv", "turn", "role", "head", "msg")


def _symbols(rows: DataFrame) -> DataFrame:
    """Distinct rows (``_ORDER``) with their number of copies and symbols: ``first`` of the
    first copy, ``rest`` of the others."""
    # Trailing spaces go by the six characters that count as such.
    spaces = " \t\n\x0b\x0c\r"
    last = F.substring(F.rtrim(F.col("text"), F.lit(spaces)), -1, 1)
    letter = F.substring("role", 1, 1)
    role = (
        F.when(letter == "", NO_ROLE).when(letter == "s", SYSTEM).when(letter == "u", USER)
        .when(letter == "a", ASSISTANT).otherwise(OTHER)
    )
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(CUT)
    slim = rows.select(*_ORDER, (role * 4 + fault).cast("int").alias("symbol"))
    slim = slim.groupBy(*_ORDER, "symbol").agg(F.count("*").alias("n"))
    # Messages that come in several turns: all but the first turn's rows are duplicates.
    message = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.hex("msg"))
    slim = stage_table(slim.withColumn("message", message), "slim_turns")
    spot = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = slim.groupBy("message").agg(F.min(spot).alias("at"), F.count("*").alias("m"))
    again = stage_table(again.where("m > 1"), "said_again")
    heavy = heavy_keys(again, "message", "m")
    slim = salted_join(slim, again.drop("m"), "message", heavy, F.col("turn"), "left")
    blank = F.col("symbol") % 4 == BLANK
    copy = F.when(blank, F.col("symbol")).otherwise(
        F.col("symbol") - F.col("symbol") % 4 + DUPLICATE
    )
    later = F.col("at").isNotNull() & ~F.col("at").eqNullSafe(spot)
    return slim.select(
        *_ORDER, "n", F.when(later, copy).otherwise(F.col("symbol")).cast("int").alias("first"),
        copy.cast("int").alias("rest"),
    )


def _push(runs: list, symbol: int, n: int) -> None:
    if n and runs and runs[-1][0] == symbol:
        runs[-1][1] += n
    elif n:
        runs.append([symbol, n])


def _runs(batches):
    """Runs of each conversation within a sorted partition, with its turns' extent."""
    block: dict = {}
    rows: list[dict] = []

    def close():
        if block:
            runs = np.array(block["runs"], dtype=np.int64).reshape(-1, 2)
            rows.append(
                {
                    "conv": block["conv"], "part": block["part"], "low": block["low"],
                    "high": block["high"], "turns": block["turns"],
                    "symbols": runs[:, 0].astype(np.uint8).tobytes(),
                    "lengths": runs[:, 1].tobytes(),
                }
            )

    def full():
        schema = pa.schema(
            [("conv", kind), ("part", pa.int32()), ("low", pa.int64()), ("high", pa.int64()),
             ("turns", pa.int64()), ("symbols", pa.binary()), ("lengths", pa.binary())]
        )
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    kind = None
    for batch in batches:
        kind = batch.schema.field("conv").type
        columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "part", "n", "first", "rest")]
        for conv, turn, part, n, first, rest in zip(*columns):
            if not block or block["conv"] != conv:
                close()
                block = {"conv": conv, "part": part, "low": None, "high": None, "turns": 0, "runs": []}
            if turn is not None and turn != block["high"]:
                block["low"] = turn if block["low"] is None else block["low"]
                block["high"] = turn
                block["turns"] += 1
            _push(block["runs"], first, 1)
            _push(block["runs"], rest, n - 1)
        if len(rows) >= 4096:
            yield full()
            rows.clear()
    close()
    if rows:
        yield full()


def _solved(conv, runs: list[list[int]], gaps: int) -> dict:
    """All figures of one conversation."""
    legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
    fault, illegal = [0, 0, 0, 0], 0
    for i, (symbol, n) in enumerate(runs):
        fault[symbol % 4] += n
        illegal += n - 1
        illegal += i > 0 and (runs[i - 1][0] // 4, symbol // 4) not in legal
    cost, audit = cheapest(runs)
    return {
        "conv": conv, "gaps": gaps, "blank": fault[BLANK], "duplicate": fault[DUPLICATE],
        "truncated": fault[CUT], "illegal": illegal, "cost": cost, "audit": audit,
    }


def _solve(batches):
    """Figures of each conversation, from its blocks of runs in order."""
    now: dict = {}
    out: list[dict] = []
    kind = None

    def close():
        if now:
            low, high = now["low"], now["high"]
            gaps = 0 if low is None else high - low + 1 - now["turns"]
            out.append(_solved(now["conv"], now["runs"], gaps))

    def full():
        schema = pa.schema(
            [("conv", kind)] + [(c, pa.int64()) for c in _FIGURES[:-1]] + [("audit", pa.string())]
        )
        return pa.RecordBatch.from_pylist(out, schema=schema)

    for batch in batches:
        kind = batch.schema.field("conv").type
        for b in batch.to_pylist():
            if not now or now["conv"] != b["conv"]:
                close()
                now = {"conv": b["conv"], "runs": [], "low": None, "high": None, "turns": 0}
            if b["low"] is not None:
                now["turns"] += b["turns"] - (b["low"] == now["high"])
                now["low"] = b["low"] if now["low"] is None else now["low"]
                now["high"] = b["high"]
            lengths = np.frombuffer(b["lengths"], np.int64).tolist()
            for s, n in zip(b["symbols"], lengths):
                _push(now["runs"], s, n)
        if out:
            yield full()
            out.clear()
    close()
    if out:
        yield full()


def structure(rows: DataFrame) -> DataFrame:
    """Faults, cost and audit of each conversation that has rows, one row each.

    ``rows`` has conv_id, turn, role and text; the result conv, gaps, blank, duplicate,
    truncated, illegal, cost, audit.
    """
    spark = rows.sparkSession
    slim = _symbols(_ordered(rows))
    parts = max(RUN_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sort = [F.col(c).asc_nulls_first() for c in _ORDER]
    dealt = (
        slim.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
        .select("conv", "turn", F.spark_partition_id().alias("part"), "n", "first", "rest")
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    blocks = dealt.mapInArrow(
        _runs, f"conv {kind}, part int, low long, high long, turns long, symbols binary, lengths binary"
    )
    # A number is given as the runs are small and their work is not.
    return (
        blocks.repartition(parts, "conv").sortWithinPartitions("conv", "part")
        .mapInArrow(
            _solve,
            f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, "
            "cost long, audit string",
        )
    )


_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _edited(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Conversations in sorted partitions: first a row with the figures (``first`` is 0),
    then the rows in order. No conversation is gathered, rows come one after another."""
    rows = _ordered(rows)
    none = [F.lit(None).cast(plans.schema[c].dataType).alias(c) for c in _FIGURES]
    turn, msg = rows.schema["turn"].dataType, rows.schema["msg"].dataType
    heads = plans.select(
        "conv", F.lit(0).alias("first"), F.lit(None).cast(turn).alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("head"),
        F.lit(None).cast(msg).alias("msg"), F.lit(None).cast("string").alias("text"), *_FIGURES,
    )
    both = heads.unionByName(rows.select("*", F.lit(1).alias("first"), *none))
    sort = [F.col(c).asc_nulls_first() for c in ("conv", "first", *_ORDER[1:])]
    return both.repartition("conv").sortWithinPartitions(*sort).drop("head", "msg")


def _walk(batches, start, message, end):
    """Follow the audits over sorted rows. ``start(row)`` makes a conversation's state,
    ``message(state, letter, role, text)`` takes each repaired row, ``end(state)`` closes."""
    state = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["first"] == 0:
                if state is not None:
                    _rest(state, message)
                    end(state)
                state = start(row)
                state |= {"audit": row["audit"] or "", "at": 0, "q": 0}
                continue
            audit = state["audit"]
            while audit[state["at"]] == "I":
                _insert(state, message)
            letter = audit[state["at"]]
            state["at"] += 1
            if letter == "K":
                role = row["role"]
                known = _LETTERS.find(role[0]) if role else NO_ROLE
                state["q"] = _AFTER[known][state["q"]]
                message(state, letter, role, row["text"])
            elif letter == "R":
                role = _GIVEN_ROLE[state["q"]]
                state["q"] = _GIVEN[state["q"]]
                message(state, letter, role, row["text"])
        yield
    if state is not None:
        _rest(state, message)
        end(state)
        yield


def _insert(state, message) -> None:
    role = _GIVEN_ROLE[state["q"]]
    state["q"] = _GIVEN[state["q"]]
    state["at"] += 1
    message(state, "I", role, "")


def _rest(state, message) -> None:
    while state["at"] < len(state["audit"]):
        _insert(state, message)


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired rows: conv, pos (from 0), edit (K, R or I), role, text.

    ``plans`` is the result of ``structure`` for the same rows.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        out: list[tuple] = []

        def start(row):
            return {"conv": row["conv"], "pos": 0}

        def message(state, letter, role, text):
            out.append((state["conv"], state["pos"], letter, role, text))
            state["pos"] += 1

        conv = None

        def watched():
            nonlocal conv
            for batch in batches:
                conv = batch.schema.field("conv").type
                yield batch

        for _ in _walk(watched(), start, message, lambda state: None):
            columns = list(zip(*out)) or [()] * 5
            types = (conv, pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["conv", "pos", "edit", "role", "text"],
            )
            out.clear()

    return _edited(rows, plans).mapInArrow(
        run, f"conv {kind}, pos long, edit string, role string, text string"
    )


def repair_digest(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Figures of each conversation and the SHA-256 of its repaired ``role:text`` lines.

    ``conversations`` names those to return (conv_id, repeats allowed), by default those of
    ``rows``; one without rows has zeros and the hash of the empty string. The hash of a
    conversation runs over all of its text in order, so its text passes one task, batch by
    batch; nothing of it is held.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    plans = structure(rows)
    if conversations is not None:
        named = conversations.select(F.col("conv_id").alias("conv")).distinct()
        plans = named.alias("a").join(
            plans.alias("b"), F.col("a.conv").eqNullSafe(F.col("b.conv")), "left"
        ).select("a.conv", *[F.col(f"b.{c}").alias(c) for c in _FIGURES])

    def run(batches):
        out: list[dict] = []
        schema = None

        def start(row):
            return {"row": row, "sha": hashlib.sha256(), "any": False}

        def message(state, letter, role, text):
            state["sha"].update(f"{chr(10) * state['any']}{role}:{text}".encode())
            state["any"] = True

        def end(state):
            row = {c: state["row"][c] or 0 for c in _FIGURES[:-1]}
            out.append(
                {"conv_id": state["row"]["conv"], **row, "audit": state["audit"],
                 "repaired_sha256": state["sha"].hexdigest()}
            )

        def watched():
            nonlocal schema
            for batch in batches:
                schema = pa.schema(
                    [("conv_id", batch.schema.field("conv").type)]
                    + [(c, pa.int64()) for c in _FIGURES[:-1]]
                    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
                )
                yield batch

        for _ in _walk(watched(), start, message, end):
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()

    return _edited(rows, plans).mapInArrow(
        run,
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, "
        "cost long, audit string, repaired_sha256 string",
    )
