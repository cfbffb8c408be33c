"""Repair of conversations: the cheapest edits that give roles `(s?(ua)+)?`, by a checkpointed dynamic program.

Edits of a row: Keep (0), Rerole to user or assistant (3), Delete (4; required for blank and duplicate rows);
between rows Insert an empty user or assistant row (3). A truncated row that isn't deleted costs 3 more. Of the
cheapest edits the ASCII-least sequence of initials is taken.

The program has four states (nothing yet, s, u, a). Backward costs to the end are kept at checkpoints only,
about a square root of rows apart; a block's costs are computed again while walking forward from its checkpoint.
That holds twice. The table is sorted by conversation over all tasks and cut into units: the rows of one
conversation in one block of at most 2**bits rows, where 2**bits is the square root of all rows. A conversation
in several units, however long, gets its checkpoints from the units' cost matrices (min-plus products, last unit
first); the state in which each unit is entered follows first unit first; then all units are walked on their own, with
checkpoints inside. So no task holds more than a block's rows, as two letters each, and a conversation is never
gathered but for its audit and its digest, which are one value by contract (the digest is streamed).

Defined results: a null role or text is one space; null turns come first; rows of a turn are ordered by role,
then text, so that equal rows are neighbours; a null conversation id is a conversation; an empty table gives
no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import materialize

BLANK = " \t\n\x0b\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NEVER = 1 << 40
#: The state after a row of a role, from each state (-1: not allowed), and after an inserted or changed row.
AFTER = {"s": (SYSTEM, -1, -1, -1), "u": (USER, USER, -1, USER), "a": (-1, -1, ASSISTANT, -1), "o": (-1, -1, -1, -1)}
TURN = (USER, USER, ASSISTANT, USER)
END = (0, INSERT + INSERT, INSERT, 0)
#: Letters of a plan: inserted user and assistant, changed to user and assistant.
INSERTED, CHANGED = {USER: "u", ASSISTANT: "a"}, {USER: "U", ASSISTANT: "A"}
LEAST_BITS = 8

Costs = tuple[int, ...]


def _before_row(v: Costs, role: str, fault: str) -> Costs:
    """Costs to the end before a row, without rows inserted there, from those after it."""
    if fault in "bd":
        return tuple(DELETE + x for x in v)
    more, after = TRUNCATED * (fault == "t"), AFTER[role]
    keep = [v[n] + more if n >= 0 else NEVER for n in after]
    return tuple(min(DELETE + v[s], keep[s], REROLE + more + v[TURN[s]]) for s in range(4))


def _before(v: Costs, role: str, fault: str) -> Costs:
    """With rows inserted before it: at most two in a row."""
    w = _before_row(v, role, fault)
    once = tuple(min(w[s], INSERT + w[TURN[s]]) for s in range(4))
    return tuple(min(w[s], INSERT + once[TURN[s]]) for s in range(4))


@lru_cache(maxsize=4096)
def matrix(roles: str, faults: str) -> tuple[Costs, ...]:
    """Costs of the edits of a unit from each state before it to each state after it."""
    columns = []
    for t in range(4):
        v = tuple(0 if s == t else NEVER for s in range(4))
        for role, fault in zip(reversed(roles), reversed(faults), strict=True):
            v = _before(v, role, fault)
        columns.append(v)
    return tuple(zip(*columns, strict=True))


@lru_cache(maxsize=16384)
def walk(roles: str, faults: str, end: Costs, state: int, last: bool) -> tuple[tuple[str, ...], int, int]:
    """The plan of each row, the state after the unit and the cost. `end` are the costs after the unit."""
    n = len(roles)
    span = math.isqrt(n) + 1
    marks, v = {n: end}, end
    for i in range(n - 1, -1, -1):
        v = _before(v, roles[i], faults[i])
        if i % span == 0:
            marks[i] = v
    plans, cost = [], 0
    for lo in range(0, n, span):
        hi = min(n, lo + span)
        block = [marks[hi]]
        for i in range(hi - 1, lo - 1, -1):
            block.append(_before(block[-1], roles[i], faults[i]))
        block.reverse()
        for i in range(lo, hi):
            here, then, plan = block[i - lo], block[i - lo + 1], ""
            role, fault = roles[i], faults[i]
            more = TRUNCATED * (fault == "t")
            while True:
                want = here[state]
                if DELETE + then[state] == want:
                    plan, cost = plan + "D", cost + DELETE
                    break
                if INSERT + here[TURN[state]] == want:
                    state, cost = TURN[state], cost + INSERT
                    plan += INSERTED[state]
                    continue
                kept = AFTER[role][state]
                if kept >= 0 and more + then[kept] == want:
                    state, plan, cost = kept, plan + "K", cost + more
                else:
                    state, cost = TURN[state], cost + REROLE + more
                    plan += CHANGED[state]
                break
            plans.append(plan)
    while last and state in (SYSTEM, USER):
        state, cost = TURN[state], cost + INSERT
        plans[-1] += INSERTED[state]
    return tuple(plans), state, cost


def _streamed(df: DataFrame, schema: str, of: Callable[[dict], tuple], fresh: Callable[[], object] | None = None) -> DataFrame:
    """df with `of` applied to each row in turn, in Arrow batches. With `fresh`, `of` also gets what it returned last
    for the same conversation (at first fresh()), and returns (row, that)."""
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if fresh is None:
                    out.append(of(row))
                    continue
                if before != row["c"]:
                    before, held = row["c"], fresh()
                made, held = of(row, held)
                out.append(made)
            yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in out], schema=kinds)

    return df.mapInArrow(run, schema)


def sorted_turns(rows: DataFrame, *, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(c, conv, turn, role, text, at): rows in the order of conversations and turns over all tasks, numbered by it;
    `at` runs without gaps in a task. Tasks are cut by the beginning of texts, not whole ones."""
    conv = F.col(conv_col)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    base = rows.select(F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("")).alias("c"), conv.alias("conv"), F.col(turn_col).cast("long").alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text"))
    dealt = base.repartitionByRange("c", F.asc_nulls_first("turn"), "role", F.substring("text", 1, 64))
    return materialize(dealt.sortWithinPartitions("c", F.asc_nulls_first("turn"), "role", "text").withColumn("at", F.monotonically_increasing_id()), "turns")


def marked(turns: DataFrame) -> DataFrame:
    """(c, conv, turn, at, role, fault): the initial of the role (s, u, a; o any other), and the first fault: b(lank),
    d(uplicate), t(runcated) or a point."""
    text = F.btrim("text", F.lit(BLANK))
    key = F.substring(F.unhex(F.sha2(F.encode(F.concat("role", F.lit("\0"), "text"), "UTF-8"), 256)), 1, 16)
    initial = F.substring("role", 1, 1)
    light = turns.select("c", "conv", "turn", "at", F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("role"), (text == "").alias("blank"), (~F.substring(text, -1, 1).isin(".", "!", "?")).alias("cut"), key.alias("key"))
    # first places of what comes again; written, so that the join may split a frequent key
    first = materialize(light.groupBy("c", "key").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeats")
    fault = F.when(F.col("blank"), "b").when(F.col("at") > F.col("first"), "d").when(F.col("cut"), "t").otherwise(".")
    return light.join(first, ["c", "key"], "left").select("c", "conv", "turn", "at", "role", fault.alias("fault"))


def units(rows: DataFrame, bits: int) -> DataFrame:
    """One row for each conversation and block: its rows as two strings, turns counted, and what the unit before ends with."""
    one = F.struct("at", "role", "fault")
    u = rows.groupBy("c", F.shiftright("at", bits).alias("block")).agg(
        F.first("conv").alias("conv"),
        F.array_sort(F.collect_list(one)).alias("rows"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        F.size(F.collect_set("turn")).alias("turns"),
    )
    letters = lambda f: F.array_join(F.transform("rows", lambda r: r[f]), "")
    u = u.select("c", "block", "conv", F.get("rows", F.lit(0))["at"].alias("lo"), letters("role").alias("roles"), letters("fault").alias("faults"), "low", "high", "turns")
    w = Window.partitionBy("c")
    by = w.orderBy("block")
    u = u.withColumns({"n_units": F.count(F.lit(1)).over(w), "nth": F.row_number().over(by), "prior": F.lag(F.substring("roles", -1, 1)).over(by), "prior_turn": F.lag("high").over(by)})
    return materialize(u, "units")


def checkpoints(u: DataFrame) -> DataFrame:
    """(c, block, end, state) for conversations in more than one unit: costs after each unit and the state before it."""
    many = u.where("n_units > 1")
    cells = _streamed(many.select("c", "block", "roles", "faults"), "c string, block long, m array<long>", lambda r: (r["c"], r["block"], [x for row in matrix(r["roles"], r["faults"]) for x in row]))

    def back(r: dict, v: list[int]) -> tuple:
        m = r["m"]
        return (r["c"], r["block"], v), [min(m[4 * s + t] + v[t] for t in range(4)) for s in range(4)]

    ends = materialize(_streamed(cells.repartition("c").sortWithinPartitions("c", F.desc("block")), "c string, block long, end array<long>", back, lambda: list(END)), "ends")
    there = many.select("c", "block", "roles", "faults").join(ends, ["c", "block"])
    exits = _streamed(there, "c string, block long, exits array<int>", lambda r: (r["c"], r["block"], [walk(r["roles"], r["faults"], tuple(r["end"]), s, False)[1] for s in range(4)]))
    forth = _streamed(exits.repartition("c").sortWithinPartitions("c", "block"), "c string, block long, state int", lambda r, s: ((r["c"], r["block"], s), r["exits"][s]), lambda: START)
    return ends.join(forth, ["c", "block"])


class Repair:
    """The edits of a table of conversations: `turns` (its rows in order), `edits` (by unit)."""

    def __init__(self, rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", bits: int | None = None) -> None:
        self.turns = sorted_turns(rows, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
        bits = bits or max(LEAST_BITS, math.ceil(math.log2(max(1, self.turns.count())) / 2))
        u = units(marked(self.turns), bits)
        known = u.join(checkpoints(u), ["c", "block"], "left")

        def plan(r: dict) -> tuple:
            end = tuple(r["end"]) if r["end"] else END
            plans, _, cost = walk(r["roles"], r["faults"], end, r["state"] or START, r["nth"] == r["n_units"])
            return (*(r[x] for x in kept), list(plans), cost)

        kept = ("c", "block", "conv", "lo", "roles", "faults", "low", "high", "turns", "prior", "prior_turn")
        kind = dict(u.dtypes)
        self.edits = materialize(_streamed(known, ", ".join([f"{x} {kind[x]}" for x in kept] + ["plans array<string>", "cost long"]), plan), "edits")

    def report(self) -> DataFrame:
        """One row for each conversation that has rows: c, conv, gaps, blank, duplicate, truncated, illegal, cost, audit."""
        count = lambda x: F.sum(F.length("faults") - F.length(F.replace("faults", F.lit(x), F.lit("")))).cast("long")
        line = F.concat(F.coalesce("prior", F.lit("")), "roles")
        legal = lambda c: F.length(c) - F.length(F.regexp_replace(c, "(?=su|ua|au)(.)", ""))
        pairs = F.length(line) - 1 - legal(line)
        again = F.coalesce((F.col("low") == F.col("prior_turn")).cast("int"), F.lit(0))
        audit = F.translate(F.array_join("plans", ""), "uaUA", "IIRR")
        out = self.edits.groupBy("c").agg(
            F.first("conv").alias("conv"),
            F.coalesce(F.max("high") - F.min("low") + 1 - F.sum(F.col("turns") - again), F.lit(0)).cast("long").alias("gaps"),
            count("b").alias("blank"),
            count("d").alias("duplicate"),
            count("t").alias("truncated"),
            F.sum(pairs).cast("long").alias("illegal"),
            F.sum("cost").alias("cost"),
            F.array_sort(F.collect_list(F.struct("block", audit.alias("a")))).alias("parts"),
        )
        return out.withColumn("audit", F.array_join(F.transform("parts", lambda p: p["a"]), "")).drop("parts")

    def repaired(self) -> DataFrame:
        """(c, conv, at, nth, role, text): the rows that are left, changed and inserted, in the order of at, nth."""
        plans = self.edits.select(F.col("lo"), F.posexplode("plans").alias("i", "plan")).select((F.col("lo") + F.col("i")).alias("at"), "plan")
        rows = self.turns.join(plans, "at").where("plan <> 'D'")
        made = F.transform(F.filter(F.split("plan", ""), lambda x: ~x.isin("D", "")), self._row)
        return rows.select("c", "conv", "at", F.posexplode(made).alias("nth", "r")).select("c", "conv", "at", "nth", "r.role", "r.text")

    @staticmethod
    def _row(x: Column) -> Column:
        role = F.when(x == "K", F.col("role")).when(F.lower(x) == "u", "user").otherwise("assistant")
        return F.struct(role.alias("role"), F.when(x.isin("u", "a"), "").otherwise(F.col("text")).alias("text"))


def digests(repaired: DataFrame) -> DataFrame:
    """(c, repaired_sha256): of the lines `role:text`, joined by a line feed. A digest takes its bytes one after the other,
    so a conversation is streamed by one task, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, h = None, None
        for batch in batches:
            done = []
            for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("c", "role", "text")), strict=True):
                if c != before:
                    if h is not None:
                        done.append((before, h.hexdigest()))
                    before, h = c, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_pydict({"c": [x[0] for x in done], "repaired_sha256": [x[1] for x in done]}, schema=kinds)
        if h is not None:
            yield pa.RecordBatch.from_pydict({"c": [before], "repaired_sha256": [h.hexdigest()]}, schema=kinds)

    kinds = pa.schema([("c", pa.string()), ("repaired_sha256", pa.string())])
    return repaired.select("c", "at", "nth", "role", "text").repartition("c").sortWithinPartitions("c", "at", "nth").select("c", "role", "text").mapInArrow(run, "c string, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of id and turn."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(text("conv_id"), F.lit(":"), text("turn")), "UTF-8")) % 20
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    out = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(text("role")).alias("role"), said.alias("text"), kind.alias("kind")).where("kind <> 0")
    return out.select("conv_id", "turn", "role", "text", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def audit(original: DataFrame, rows: DataFrame) -> DataFrame:
    """A report on every conversation of `original`, of whose rows `rows` are left or damaged."""
    done = Repair(rows)
    all_ = original.select("conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("c")).distinct()
    j = all_.join(done.report().drop("conv"), "c", "left").join(digests(done.repaired()), "c", "left")
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return j.select("conv_id", *[F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in longs], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
