"""Repair of the structure of conversations by target alignment.

A sound conversation has the role initials `(s?(ua)+)?`: nothing, or user and
assistant in turn after at most one system turn. For every length there is one such
text at most, so a conversation is aligned by Wagner-Fischer with the target of each
feasible length. The cheapest alignment found so far bounds the next ones: a length
whose lower bound is dearer is not tried, and of a table only the diagonals are
computed that can lie on a path as cheap (Ukkonen). Backtracing takes the least letter
of all optimal moves; of equal costs the ASCII-least audit wins.

Turns are aligned in segments. For each state of the target before and after a segment
its best (cost, audit) is found; two neighbours join by trying the states between them.
No audit of a segment is the beginning of another of equal cost and states, as only
inserts could follow and they cost, so the least of the parts is the least of the whole.

Conversations up to `HOLD` bytes are worked on whole, in one sorted stream a task. Longer
ones are cut into ranges: first places of equal turns, joined pieces, and repaired turns
are each computed in parallel, and only one row a range meets in one task.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tempolane.sources.shared import new_path, settled

# Costs of the edits, and what a turn may end with.
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
ENDS = (".", "!", "?")
BLANKS = " \t\n\x0b\x0c\r"
SEGMENT = 24
HOLD = 4 << 20  # bytes of text (and 64 a turn) of a conversation that a task holds
SENT_LONG = 100_000  # keys of long conversations that may be sent to all tasks
KEPT = 100_000  # segments whose alignment a worker remembers
NEVER = 1 << 60

# States of the target: nothing yet, after the system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
GROWS = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # what may be inserted
LEGAL = {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}

Matrix = dict[tuple[int, int], tuple[int, str]]


def _meets(code: str, wanted: str) -> int:
    """Cost of a turn standing for a letter of the target. Codes are the role's
    initial, `o` for others, in capitals where the turn is truncated, and `d` for
    turns that must go."""
    if code == "d":
        return NEVER
    extra = UNFINISHED if code.isupper() else 0
    if code.lower() == wanted:
        return extra
    return extra + REROLE if wanted in NAMES else NEVER


MEETS = {(c, t): _meets(c, t) for c in "suaoSUAOd" for t in "sua"}


def align(codes: str, target: str, bound: int) -> tuple[int, str] | None:
    """(cost, least audit) of turning `codes` into `target`, if it costs at most
    `bound`; the table holds the diagonals that such a path may touch."""
    n, m = len(codes), len(target)
    apart = lambda d: INSERT * d if d >= 0 else -DELETE * d
    inside = [d for d in range(-n, m + 1) if apart(d) + apart(m - n - d) <= bound]
    if not inside:
        return None
    low, high = inside[0], inside[-1]
    width = high - low + 3
    table = [[NEVER] * width for _ in range(n + 2)]
    for i in range(n, -1, -1):
        row, below = table[i], table[i + 1]
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            k = j - i - low + 1
            if i == n and j == m:
                row[k] = 0
                continue
            best = NEVER
            if i < n:
                best = DELETE + below[k - 1]
                if j < m:
                    best = min(best, MEETS[codes[i], target[j]] + below[k])
            if j < m and target[j] != "s":
                best = min(best, INSERT + row[k + 1])
            row[k] = min(best, NEVER)
    cost = table[0][1 - low]
    if cost > bound:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        k = j - i - low + 1
        here = table[i][k]
        if i < n and here == DELETE + table[i + 1][k - 1]:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and here == INSERT + table[i][k + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if codes[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def _least(codes: str, lead: str, first: str, wanted: set[int]) -> dict[int, tuple[int, str]]:
    """The best alignment with `lead` and then user and assistant in turn, starting
    with `first`, by what the alternating part's length is: 1 odd, 2 even, 0 none."""
    n, gone = len(codes), codes.count("d")
    body = first + ("a" if first == "u" else "u")
    best: dict[int, tuple[int, str]] = {}

    def lower(m: int) -> int:
        deleted = max(gone, n - m)
        return DELETE * deleted + INSERT * (m - n + deleted)

    lengths = sorted(range(2 * n + 4), key=lambda x: (lower(x + len(lead)), x))
    for x in lengths:
        kind = 0 if x == 0 else 2 - x % 2
        if kind not in wanted:
            continue
        m = x + len(lead)
        bound = min(best[kind][0] if kind in best else NEVER, DELETE * n + INSERT * m)
        if lower(m) > bound:
            continue
        found = align(codes, lead + (body * (x // 2 + 1))[:x], bound)
        if found:
            best[kind] = min(best.get(kind, found), found)
    return best


@functools.lru_cache(maxsize=KEPT)
def segment(codes: str, entry: int) -> tuple[tuple[int, int, str], ...]:
    """(state after, cost, audit) of a segment that begins in a state."""
    ends: dict[int, tuple[int, str]] = {entry: (DELETE * len(codes), "D" * len(codes))}

    def put(state: int, found: tuple[int, str]) -> None:
        ends[state] = min(ends.get(state, found), found)

    if entry == USER:
        found = _least(codes, "", "a", {1, 2})
        for kind, state in ((1, ASSISTANT), (2, USER)):
            if kind in found:
                put(state, found[kind])
    else:
        ways = [("", _least(codes, "", "u", {1, 2}))]
        if entry == START and "s" in codes.lower():
            ways.append(("s", _least(codes, "s", "u", {0, 1, 2})))
        for lead, found in ways:
            for kind, state in ((0, SYSTEM), (1, USER), (2, ASSISTANT)):
                if kind in found:
                    put(state, found[kind])
    return tuple((state, *found) for state, found in sorted(ends.items()))


def join(one: Matrix, two: Matrix) -> Matrix:
    """The best ways through two neighbours."""
    out: Matrix = {}
    for (e, p), (cost, audit) in one.items():
        for (q, x), (more, rest) in two.items():
            if p == q:
                total = cost + more
                if (e, x) not in out or total <= out[e, x][0]:
                    found = (total, audit + rest)
                    out[e, x] = min(out.get((e, x), found), found)
    return out


EMPTY: Matrix = {(e, e): (0, "") for e in STATES}


class Joined:
    """Matrices joined like the digits of a counter, so that every audit is copied
    a logarithmic number of times."""

    def __init__(self, entries=STATES):
        self.stack: list[tuple[int, Matrix]] = []
        self.entries = entries

    def add(self, found: Matrix) -> None:
        level = 0
        while self.stack and self.stack[-1][0] == level:
            found = join(self.stack.pop()[1], found)
            level += 1
        self.stack.append((level, found))

    def codes(self, codes: str) -> None:
        for at in range(0, len(codes), SEGMENT):
            part = codes[at : at + SEGMENT]
            entries = self.entries if at == 0 and not self.stack else STATES
            self.add({(e, x): (cost, audit) for e in entries for x, cost, audit in segment(part, e)})

    def all(self) -> Matrix:
        result = {(e, e): (0, "") for e in self.entries}
        for _, found in self.stack:
            result = join(result, found)
        return result


def repair_codes(codes: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a whole conversation."""
    joined = Joined((START,))
    joined.codes(codes)
    found = joined.all()
    return min(found[START, x] for x in (START, ASSISTANT) if (START, x) in found)


def apply(audit: str, turns: Iterator[tuple[str, str]], state: int = START) -> Iterator[tuple[str, str]]:
    """Turns (role, text) after the edits of an audit, from a state of the target."""
    for letter in audit:
        if letter == "I":
            made = GROWS[state]
            yield NAMES[made], ""
            state = NEXT[state, made]
            continue
        role, text = next(turns)
        if letter == "D":
            continue
        initial = role[:1] if letter == "K" else GROWS[state]
        yield (role if letter == "K" else NAMES[initial]), text
        state = NEXT[state, initial]


def code_of(role: str, text: str) -> str:
    """The code of a turn that isn't a repeated one; `d` where it is blank."""
    body = text.rstrip(BLANKS)
    if not body:
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial if body[-1] in ENDS else initial.upper()


class Counts:
    """What is counted over the turns of a conversation, in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.last_turn = self.first_turn = None
        self.distinct, self.first, self.last = 0, None, None

    def add(self, turn: int | None, role: str, code: str, repeated: bool, blank: bool) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = self.low = turn
            self.distinct += turn != self.last_turn
            self.high = self.last_turn = turn
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += not repeated and code.isupper()

    def follow(self, rest: dict) -> None:
        """Add the counts of the next range."""
        if self.last is None:
            self.first = rest["first"]
        elif rest["first"] is not None:
            self.illegal += self.last + rest["first"] not in LEGAL
        self.last = rest["last"] if rest["last"] is not None else self.last
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + rest[name])
        if rest["low"] is not None:
            self.distinct += rest["distinct_turns"] - (self.high == rest["low"])
            self.low = rest["low"] if self.low is None else self.low
            self.high = rest["high"]

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct

    def row(self) -> dict:
        names = ("blank", "duplicate", "truncated", "illegal", "low", "high", "first", "last")
        return {**{n: getattr(self, n) for n in names}, "distinct_turns": self.distinct}


FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURNS = "turns array<struct<role:string,text:string>>"


class Repaired(NamedTuple):
    """`conversations`: one row each, with `turns` where it was held whole. `turns`:
    the repaired ones of the others (key, range, place, role, text); None without any."""

    conversations: DataFrame
    turns: DataFrame | None


def _schema(key: T.StructField, ddl: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", key.dataType), *T.StructType.fromDDL(ddl).fields])


def _runs(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of a sorted stream in runs of equal first `by` columns."""
    rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
    ahead = next(rows, None)
    while ahead is not None:
        name = ahead[:by]

        def run(first=ahead):
            nonlocal ahead
            row = first
            while row is not None and row[:by] == name:
                yield row
                row = next(rows, None)
            ahead = row

        one = run()
        yield name, one
        for _ in one:
            pass


def _whole(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, turn, role, text, copies), sorted, to a row a conversation."""
    out, size = [], 0
    for (key,), run in _runs(batches, 1):
        counts, seen, codes, turns = Counts(), set(), [], []
        for _, turn, role, text, copies in run:
            for _ in range(copies):
                code = code_of(role, text)
                blank, repeated = code == "d", (role, text) in seen
                seen.add((role, text))
                counts.add(turn, role, code, repeated, blank)
                codes.append("d" if repeated else code)
                turns.append((role, text))
                size += len(text)
        cost, audit = repair_codes("".join(codes))
        fixed = [{"role": r, "text": t} for r, t in apply(audit, iter(turns))]
        out.append((key, counts.gaps, counts.blank, counts.duplicate, counts.truncated, counts.illegal, cost, audit, fixed))
        if len(out) >= 2000 or size > HOLD:
            yield _batch(out, schema)
            out, size = [], 0
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _repair_whole(rows: DataFrame) -> DataFrame:
    schema = _schema(rows.schema["conv_id"], f"{FOUND}, {TURNS}")
    laid = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return laid.mapInArrow(functools.partial(_whole, to_arrow_schema(schema)), schema)


# --- long conversations ------------------------------------------------------------


def _places(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each copy, numbered within its range."""
    context, place = TaskContext.get(), 0
    for batch in batches:
        out = []
        for key, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
            for _ in range(max(copies, 1)):  # a dropped turn stays as a mark of its conversation
                out.append((key, context.partitionId(), place, turn, role, text, code_of(role, text) if copies else "-"))
                place += 1
        if out:
            yield _batch(out, schema)


COUNTED = "blank long, duplicate long, truncated long, illegal long, low long, high long, first string, last string, distinct_turns long"


def _matrices(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, range, place, turn, role initial, code, is first) to a row a range."""
    for (key, part), run in _runs(batches, 2):
        counts, joined, codes = Counts(), Joined(), []
        for _, _, _, turn, initial, code, is_first in run:
            counts.add(turn, initial, code, not is_first, code == "d")
            codes.append(code if is_first else "d")
            if len(codes) == SEGMENT:
                joined.codes("".join(codes))
                codes = []
        if codes:
            joined.codes("".join(codes))
        ways = [{"entry": e, "exit": x, "cost": c, "audit": a} for (e, x), (c, a) in joined.all().items()]
        yield _batch([(key, part, *counts.row().values(), ways)], schema)


def _chosen(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `_matrices` in order to the way through each range, and what is
    counted of the conversation, on a row of range -1."""
    names = [f.split()[0] for f in COUNTED.split(", ")]
    for (key,), run in _runs(batches, 1):
        counts, parts = Counts(), []
        for row in run:
            if row[1] >= 0:
                counts.follow(dict(zip(names, row[2:-1])))
                parts.append((row[1], {(w["entry"], w["exit"]): (w["cost"], w["audit"]) for w in row[-1]}))
        # Costs and audits of all beginnings; the last state tells the way back.
        ways: dict[int, tuple[int, str, tuple]] = {START: (0, "", ())}
        for _, matrix in parts:
            after: dict[int, tuple[int, str, tuple]] = {}
            for (e, x), (cost, audit) in matrix.items():
                if e in ways:
                    found = (ways[e][0] + cost, ways[e][1] + audit, (*ways[e][2], (e, audit)))
                    if x not in after or found[:2] < after[x][:2]:
                        after[x] = found
            ways = after
        cost, audit, path = min((ways[x] for x in (START, ASSISTANT) if x in ways), key=lambda w: w[:2])
        out = [(key, part, e, own, None, None, None, None, None, None) for (part, _), (e, own) in zip(parts, path)]
        out.append((key, -1, None, audit, counts.gaps, counts.blank, counts.duplicate, counts.truncated, counts.illegal, cost))
        yield _batch(out, schema)


def _repair_ranges(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns (conv, range, place, role, text, state, audit) with the way through
    their range on the first row, of place -1, to repaired turns."""
    for (key, part), run in _runs(batches, 2):
        _, _, _, _, _, state, audit = next(run)
        out, size = [], 0
        turns = ((role, text) for _, _, _, role, text, _, _ in run)
        for place, (role, text) in enumerate(apply(audit, turns, state)):
            out.append((key, part, place, role, text))
            size += len(text)
            if size > HOLD:
                yield _batch(out, schema)
                out, size = [], 0
        if out:
            yield _batch(out, schema)


def _repair_long(rows: DataFrame) -> Repaired:
    spark, key = rows.sparkSession, rows.schema["conv_id"]
    kept = lambda df, name: settled(df, new_path(spark, name))
    run = lambda work, df, schema: df.mapInArrow(functools.partial(work, to_arrow_schema(schema)), schema)
    order = ["conv_id", F.asc_nulls_first("turn"), "role"]
    ranged = rows.repartitionByRange(*order, F.substring("text", 1, 16)).sortWithinPartitions(*order, "text")
    turns = kept(run(_places, ranged, _schema(key, "range int, place long, turn long, role string, text string, code string")), "turns")
    told = turns.filter("code <> '-'")
    # The first place of each role and text, found by aggregation, known by its place.
    one = F.min(F.struct("range", "place")).alias("x")
    firsts = told.groupBy("conv_id", F.sha2(F.concat("role", F.lit("\0"), "text"), 256).alias("same")).agg(one)
    firsts = firsts.select(F.col("x.range").alias("r"), F.col("x.place").alias("p"), F.lit(True).alias("is_first"))
    light = told.select("conv_id", "range", "place", "turn", F.substring("role", 1, 1).alias("initial"), "code")
    light = light.join(firsts, (F.col("range") == F.col("r")) & (F.col("place") == F.col("p")), "left")
    light = light.select("conv_id", "range", "place", "turn", "initial", "code", F.coalesce("is_first", F.lit(False)).alias("is_first"))
    ways = "array<struct<entry:int,exit:int,cost:long,audit:string>>"
    schema = _schema(key, f"range int, {COUNTED}, ways {ways}")
    matrices = run(_matrices, light.repartition("conv_id", "range").sortWithinPartitions("conv_id", "range", "place"), schema)
    # A conversation without a turn left has its mark only.
    fields = [f for f in schema.fields if f.name not in ("conv_id", "range")]
    marks = turns.select("conv_id").distinct().select("conv_id", F.lit(-1).alias("range"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    both = matrices.unionByName(marks).repartition("conv_id").sortWithinPartitions("conv_id", "range")
    schema = _schema(key, "range int, state int, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")
    chosen = kept(run(_chosen, both, schema), "ways")
    heads = chosen.filter("range >= 0").select("conv_id", "range", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("role"),
                                               F.lit(None).cast("string").alias("text"), "state", "audit")
    bodies = told.select("conv_id", "range", "place", "role", "text", F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("audit"))
    feed = heads.unionByName(bodies).repartition("conv_id", "range").sortWithinPartitions("conv_id", "range", "place")
    fixed = kept(run(_repair_ranges, feed, _schema(key, "range int, place long, role string, text string")), "repaired")
    names = [f.split()[0] for f in FOUND.split(", ")]
    found = chosen.filter("range < 0").select("conv_id", *names, F.lit(None).cast(TURNS.split(" ", 1)[1]).alias("turns"))
    return Repaired(found, fixed)


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): a test of damage that depends on key and
    turn only. Nulls of role and text count as one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(fate == 4, "user").otherwise(blank("role")).alias("role"),
        text.alias("text"), F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"),
    )


def repair(rows: DataFrame, hold: int = HOLD) -> Repaired:
    """Repaired conversations of `rows` (conv_id, turn, role, text, and copies, where a
    row counts several times or, with 0, only names its conversation).

    Turns stand in the order of turn (nulls first), role and text. A null key is a
    conversation of its own, null roles and texts count as one space, other columns
    are not read. Repeated rows are repeated turns. A conversation without turns has
    zeros and an empty audit; an empty table gives none. Results do not depend on `hold`.
    """
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1).alias("copies")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"), copies)
    size = F.sum((F.octet_length("text") + 64) * F.greatest("copies", F.lit(1)).cast("long")).alias("size")
    long = settled(rows.groupBy("conv_id").agg(size).filter(F.col("size") > hold).select(F.col("conv_id").alias("k")), new_path(rows.sparkSession, "long"))
    n = long.count()
    if not n:
        return Repaired(_repair_whole(rows), None)
    named = F.broadcast(long) if n <= SENT_LONG else long
    same = F.col("conv_id").eqNullSafe(F.col("k"))
    whole = _repair_whole(rows.join(named, same, "left_anti"))
    ranges = _repair_long(rows.join(named, same, "left_semi"))
    return Repaired(whole.unionByName(ranges.conversations), ranges.turns)


def _hashes(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (key,), run in _runs(batches, 1):
        digest = hashlib.sha256()
        for at, (_, _, _, role, text) in enumerate(run):
            digest.update(f"{chr(10) if at else ''}{role}:{text}".encode())
        yield _batch([(key, digest.hexdigest())], schema)


def digests(found: Repaired) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    The hash of a conversation's repaired text is one chain by definition: that of a
    long one streams through a task, which holds a batch of it."""
    names = [f.split()[0] for f in FOUND.split(", ")]
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    rows = found.conversations.select("conv_id", *names, F.sha2(text, 256).alias("repaired_sha256"))
    if found.turns is None:
        return rows
    key = found.turns.schema["conv_id"]
    schema = _schema(key, "h string")
    sorted_ = found.turns.repartition("conv_id").sortWithinPartitions("conv_id", "range", "place")
    hashes = sorted_.mapInArrow(functools.partial(_hashes, to_arrow_schema(schema)), schema).withColumnRenamed("conv_id", "k")
    empty = hashlib.sha256().hexdigest()
    short = found.conversations.filter("turns IS NOT NULL")
    rows = short.select("conv_id", *names, F.sha2(text, 256).alias("repaired_sha256"))
    long = found.conversations.filter("turns IS NULL").join(hashes, F.col("conv_id").eqNullSafe(F.col("k")), "left")
    return rows.unionByName(long.select("conv_id", *names, F.coalesce("h", F.lit(empty)).alias("repaired_sha256")))
