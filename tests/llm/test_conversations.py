"""Operator 11 against a plain forward fold over all states with every insert tried."""

import hashlib
import random
import re
import zlib

import pytest

from ingestry.llm import conversations as C
from ingestry.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, conv int, part int, copies int, h1 int, audit int"


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        by = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if by == 0:
            continue
        text = "" if by == 1 else re.sub("[.!?]", "", text) if by == 2 else text
        for _ in range(1 + (by == 3)):
            yield conv, turn, "user" if by == 4 else role, text


def cheapest(rows):
    """rows: (initial, gone, truncated) -> (cost, audit)."""
    letters = {0: ("su", {"s": 1, "u": 2}), 1: ("u", {"u": 2}), 2: ("a", {"a": 3}), 3: ("u", {"u": 2})}

    def inserted(best):
        for _ in range(4):
            for s, (cost, audit) in list(best.items()):
                (t,) = (t for x, t in letters[s][1].items() if x in "ua")
                best[t] = min(best.get(t, (cost + 2, audit + "I")), (cost + 2, audit + "I"))
        return best

    best = inserted({0: (0, "")})
    for initial, gone, truncated in rows:
        new = {}

        def put(s, cost, audit):
            new[s] = min(new.get(s, (cost, audit)), (cost, audit))

        for s, (cost, audit) in best.items():
            put(s, cost + 3, audit + "D")
            if gone:
                continue
            for x, t in letters[s][1].items():
                if x == initial:
                    put(t, cost + truncated, audit + "K")
                if x in "ua":
                    put(t, cost + truncated + 2, audit + "R")
        best = inserted(new)
    return min(best[s] for s in (0, 3) if s in best)


def brute(rows):
    """{conv_id: the operator's row}; conversations whose turns tie only between equal rows."""
    kept = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in damage(rows):
        kept[conv].append((turn, role, text))
    found = {}
    for conv, mine in kept.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        faults, seen = [], set()
        for _, role, text in mine:
            bare = text.rstrip(" \t\n\x0b\f\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        firsts = [role[:1] for _, role, _ in mine]
        cost, audit = cheapest([(x, f in ("blank", "duplicate"), f == "truncated") for x, f in zip(firsts, faults)])
        done, at, state = [], 0, ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else mine[at][1:]
            at += edit != "I"
            if edit == "D":
                continue
            role = role if edit == "K" else "assistant" if state == "u" else "user"
            state = role[:1]
            done.append(f"{role}:{text}")
        assert at == len(mine) and re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in done))
        turns = [t for t, _, _ in mine if t is not None]
        found[conv] = (
            conv,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(done).encode()).hexdigest(),
        )
    return found


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, 7, 7, 7) for r in rows], SCHEMA).repartition(6)


def made(rng, conv, n):
    rows = []
    for turn in range(n):
        if rng.random() < 0.1:
            continue
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "System"][: rng.choice([2, 4, 9])])
        text = rng.choice(["Yes.", "No", "Why?", "", "  ", None, "Ends. \n", "A tab\t", "ö!", "x" * rng.randint(1, 9) + "."])
        rows.append((conv, turn + 5, role, text))
    return rows or [(conv, 1, "user", "One.")]


def check(spark, rows, df=None):
    got = C.repair_damaged(frame(spark, rows) if df is None else df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = brute(rows)
    got = {r["conv_id"]: tuple(r) for r in got.collect()}
    for conv, row in want.items():
        assert got[conv] == row, (conv, got[conv], row)
    assert len(got) == len(want)


def test_against_fold(spark):
    rng = random.Random(4)
    rows = [r for conv in range(400) for r in made(rng, conv, rng.randint(1, 9))]
    rows += [(None, 3, "user", "Who."), (None, 4, None, "I."), (9000, None, "user", "When?"), (9000, 2, "assistant", "Now.")]
    rows += [(9001, None, "user", "a."), (9001, None, "user", "a."), (9001, -5, "assistant", "b."), (9001, 1 << 62, "user", "c")]
    check(spark, rows)


@pytest.mark.parametrize("partitions", [2, 40])
def test_one_conversation_holds_most_rows(spark, partitions):
    """Over many tasks and pieces; the same row stands there again and again."""
    rng = random.Random(5)
    rows = [r for conv in range(12) for r in made(rng, conv, 6)] + made(rng, 5000, 1500)
    rows += [(5000, 2000 + k, "user" if k % 2 else "assistant", f"Text {k}.") for k in range(900)]
    rows += [(5001, 7, "user", "Same.")] * 700 + [(5001, 8, "assistant", "So.")]
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def test_lost_and_empty(spark):
    lost = [c for c in range(10_000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0][:3]
    rows = [(c, 1, "user", "Gone.") for c in lost]
    check(spark, rows)
    assert all(r[-2:] == ("", hashlib.sha256(b"").hexdigest()) and not any(r[1:7]) for r in brute(rows).values())
    assert C.repair_damaged(frame(spark, [])).collect() == []


def test_long_text(spark):
    rows = [(1, 0, "user", "long " * 400_000 + "."), (1, 1, "assistant", "ü" * 700_000)]
    check(spark, rows)


def test_search_in_parts():
    """The whole search, the one in pieces and the fold agree, ties included."""
    rng = random.Random(6)
    for _ in range(300):
        kinds = "".join(rng.choice("xsuaoSUAO" if rng.random() < 0.5 else "uaUA") for _ in range(rng.randint(0, 24)))
        want = cheapest([(x.lower(), x == "x", x.isupper()) for x in kinds])
        assert C.whole(kinds) == want
        if kinds:
            size = rng.randint(1, 5)
            assert C.finished(C.joined([C.part(kinds[k : k + size]) for k in range(0, len(kinds), size)])) == want
    kinds = "".join(rng.choice("xsuaSUA") for _ in range(3 * C.PIECE))
    pieces = [C.part(kinds[k : k + 2]) for k in range(0, len(kinds), 2)]  # two levels of parts
    assert C.finished(C.joined(pieces)) == cheapest([(x.lower(), x == "x", x.isupper()) for x in kinds])


def test_undamaged(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "assistant", "Yes."), (2, 0, "assistant", "Yes.")]
    got = {r["conv"]: (r["cost"], r["audit"]) for r in C.repair(C.undamaged(frame(spark, rows))).collect()}
    assert got == {1: (0, "KK"), 2: (2, "IK")}


def test_registered(spark):
    sf = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r) for r in QUERIES["op11_conversation_repair"](spark, sf).collect()}
    assert got == brute(rows)
