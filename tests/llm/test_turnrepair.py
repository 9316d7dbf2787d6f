import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tempolane.llm import turnrepair
from tempolane.llm.turnrepair import ASSISTANT, GROWS, MEETS, NEVER, NEXT, START, STATES

SF = "/root/testdata/sf0.01"


def search(codes):
    """All edits with at most three inserts in a row."""
    best = (NEVER, "")

    def walk(i, state, cost, audit, inserts):
        nonlocal best
        if i == len(codes) and state in (START, ASSISTANT):
            best = min(best, (cost, audit))
        if inserts < 3:
            walk(i, NEXT[state, GROWS[state]], cost + 3, audit + "I", inserts + 1)
        if i < len(codes):
            walk(i + 1, state, cost + 4, audit + "D", 0)
            for t in "sua":
                if (state, t) in NEXT and MEETS[codes[i], t] < NEVER:
                    walk(i + 1, NEXT[state, t], cost + MEETS[codes[i], t], audit + ("K" if codes[i].lower() == t else "R"), 0)

    walk(0, START, 0, "", 0)
    return best


def loop(codes):
    """The best (cost, audit) of each state, turn by turn."""
    best = {START: (0, "")}

    def grow():
        for _ in range(4):
            for s in STATES:
                if s in best:
                    x, found = NEXT[s, GROWS[s]], (best[s][0] + 3, best[s][1] + "I")
                    best[x] = min(best.get(x, found), found)

    grow()
    for c in codes:
        after = {}
        for s, (cost, audit) in best.items():
            ways = [(s, cost + 4, audit + "D")]
            ways += [(NEXT[s, t], cost + MEETS[c, t], audit + ("K" if c.lower() == t else "R")) for t in "sua" if (s, t) in NEXT and MEETS[c, t] < NEVER]
            for x, *found in ways:
                after[x] = min(after.get(x, tuple(found)), tuple(found))
        best = after
        grow()
    return min(best[s] for s in (START, ASSISTANT) if s in best)


def test_alignment_equals_a_search_of_all_edits():
    draw = random.Random(1)
    for _ in range(150):
        codes = "".join(draw.choice("suaoSUAOdua") for _ in range(draw.randint(0, 4)))
        assert turnrepair.repair_codes(codes) == search(codes) == loop(codes), codes


def test_alignment_of_long_conversations_equals_a_loop():
    draw = random.Random(2)
    for n in (5, 9, 24, 25, 48, 70, 300):
        for _ in range(20):
            codes = "".join(draw.choice("uauauauasUAod") for _ in range(n))
            assert turnrepair.repair_codes(codes) == loop(codes), codes


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        turns = out[conv]
        say = lambda x: " " if x is None else str(x)
        fate = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        turns += [(turn is not None, turn or 0, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {k: sorted(v) for k, v in out.items()}


def brute(rows):
    result = {}
    for conv, turns in damaged(rows).items():
        known = [t for has, t, _, _ in turns if has]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        seen, codes, faults = set(), "", [0, 0, 0]
        for _, _, role, text in turns:
            body = text.strip(" \t\n\x0b\x0c\r")
            kind = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if kind is not None:
                faults[kind] += 1
            first = role[0] if role and role[0] in "sua" else "o"
            codes += "d" if kind in (0, 1) else first.upper() if kind == 2 else first
        firsts = [r[:1] for _, _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        cost, audit = loop(codes)
        texts, left, state = [], list(turns), START
        for e in audit:
            if e == "I":
                made = GROWS[state]
                texts.append({"u": "user", "a": "assistant"}[made] + ":")
            else:
                _, _, role, text = left.pop(0)
                if e == "D":
                    continue
                made = role[0] if e == "K" else GROWS[state]
                texts.append((role if e == "K" else {"u": "user", "a": "assistant"}[made]) + ":" + text)
            state = NEXT[state, made]
        result[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest())
    return result


def rows_of(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def odd(spark):
    draw = random.Random(5)
    say = ["Yes.", "no", "What?", "", " \t", None, "Why! ", "x" * 5000 + "."]
    rows = [(c, draw.choice([None, *range(12)]), draw.choice(["user", "assistant", "system", "tool", "", None, "uno"]), draw.choice(say))
            for c in (1, 2, 3, 2**40, -5) for _ in range(draw.randint(1, 60))]
    rows += [(None, t, "user", "Same.") for t in range(30)] + [(77, 1, "user", "Twice."), (77, 1, "user", "Twice.")]
    rows += [(900, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(400)]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit(1))


@pytest.mark.parametrize("hold", [turnrepair.HOLD, 3000, 0])
def test_odd_conversations_equal_brute_force(spark, hold):
    rows, df = odd(spark)
    found = turnrepair.digests(turnrepair.repair(turnrepair.damage(df), hold))
    assert rows_of(found) == brute(rows)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(entry.queries()["op13_turn_repair"](spark, SF)) == brute(rows)


def test_dropped_conversations_and_empty_tables(spark):
    gone = next((c, 0) for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(*gone, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    for hold in (turnrepair.HOLD, 0):
        got = rows_of(turnrepair.digests(turnrepair.repair(turnrepair.damage(df), hold)))
        assert got == {gone[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert turnrepair.digests(turnrepair.repair(df.limit(0))).count() == 0
    # Turns themselves, and a key of another type.
    df = spark.createDataFrame([("k", 2, "user", "More?"), ("k", 1, "user", "Go.")], "conv_id string, turn int, role string, text string")
    got = turnrepair.repair(df).conversations.first()
    assert got["audit"] == "KR" and [tuple(t) for t in got["turns"]] == [("user", "Go."), ("assistant", "More?")]
