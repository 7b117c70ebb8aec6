"""Operator 11, conversation structure repair: bidirectional Dijkstra over the edit lattice.

A conversation's rows, by turn, are to become (system? (user assistant)+)? by the cheapest
edits: Keep (0), Rerole to user or assistant (2), Delete (3; a must for blank rows and for
repeats of an earlier role and text) and Insert of an empty user or assistant row (2); a
truncated row that stays adds 1. Of equally cheap repairs the one whose audit, the initials
of its edits in order, is ASCII-least wins. A node of the lattice is a number of rows done and
a state of the grammar: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.

1. ``rows``: narrow rows with their faults; what repeats an earlier row is found by one
   aggregation over hashes (128 bits of conversation, role and text) and a join.
2. The narrow rows are sorted by ranges of (conversation, turn), so a conversation of any
   length is spread over tasks. A task solves the conversations that lie within it, and hands
   on of its first and last ones, which may go on elsewhere, the cheapest way from every state
   to every state. The search that finds these in pieces of ``PIECE`` rows runs over the
   pieces, and at last over the tasks' parts, as it runs over rows.
3. The texts, laid out by conversation, stream past the finished audit into the hash of the
   repaired text. That hash is sequential by its nature: one task reads a conversation's
   texts, batch by batch, and holds the audit.

``search`` grows one heap from the start and one from the ends; once their least costs add up
to more than the best crossing, every equally cheap repair has a node that both have labelled,
and the least concatenated audit of these is the answer. No audit of a cheapest way to a node
begins another one's, so the least part stays least in the whole.

Edge cases: a null role or text is one space, a null conversation is a conversation of its
own, null turns come first; rows of the same turn are ordered by hash, so that equal ones are
neighbours; a row that the table repeats is a duplicate; a role that begins with none of s, u
and a can only be reroled or deleted; other columns are ignored; a conversation that loses all
rows has zeros and an empty audit; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry.llm.common import stage

PIECE = 256  # rows, or parts, that one search takes
START, ENDS = 0, (0, 3)
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
# What an inserted or reroled row must be, and the state after it.
FILL = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
INSERTS = [(s, t, 2, "I") for s, (_, t) in FILL.items()]
# Inserts that lead from a state to an end once all rows are done.
TAIL = {0: "", 1: "II", 2: "I", 3: ""}
LEGAL = {"su", "ua", "au"}
GONE, OTHER = "x", "o"  # must be deleted; begins with another letter


def row_edges(kind: str) -> list[tuple[int, int, int, str]]:
    """Edges (state, state after, cost, edit) over a row of a kind: GONE, or its role's initial
    (or OTHER), in upper case if it is truncated."""
    edges = [(s, s, 3, "D") for s in FILL]
    if kind != GONE:
        more = int(kind.isupper())
        edges += [(s, t, 2 + more, "R") for s, (_, t) in FILL.items()]
        edges += [(s, t, more, "K") for (s, initial), t in AFTER.items() if initial == kind.lower()]
    return edges


def _both_ways(edges):
    out, into = ([[] for _ in FILL] for _ in range(2))
    for s, t, cost, edit in edges:
        out[s].append((t, cost, edit))
        into[t].append((s, cost, edit))
    return out, into


ROWS = {kind: _both_ways(row_edges(kind)) for kind in (GONE, *"sua", OTHER, *"SUA", OTHER.upper())}
INSERTED = _both_ways(INSERTS)
NOTHING = _both_ways([])


def search(steps: list, inserted, tail: bool, start: int, ends) -> tuple[int, str] | None:
    """(cost, audit) of the least way over all steps from state ``start`` to one of ``ends``.
    A step is the edges over one row, both ways; ``inserted`` are edges beside the rows, taken
    in front of any row and, with ``tail``, behind the last."""
    n, k = len(steps), len(FILL)
    fore = {start: (0, "")}
    back = {n * k + e: (0, "") for e in ends}
    heaps = [(0, 0, start)], [(0, 0, v) for v in back]
    done = set(), set()
    best = min((fore[v][0] + back[v][0] for v in fore.keys() & back.keys()), default=None)
    while True:
        for heap, seen in zip(heaps, done):
            while heap and heap[0][2] in seen:
                heapq.heappop(heap)
        if not heaps[0] or not heaps[1] or (best is not None and heaps[0][0][0] + heaps[1][0][0] > best):
            break
        reverse = heaps[1][0][0] < heaps[0][0][0] or (heaps[1][0][0] == heaps[0][0][0] and len(heaps[1]) < len(heaps[0]))
        mine, other = (back, fore) if reverse else (fore, back)
        # Keeping is free: of equal costs the node with fewer rows behind it comes first.
        _, _, v = heapq.heappop(heaps[reverse])
        done[reverse].add(v)
        i, s = divmod(v, k)
        cost, audit = mine[v]
        j = i - 1 if reverse else i + 1
        ways = [(j, w) for w in steps[j if reverse else i][reverse][s]] if 0 <= j <= n else []
        if i < n or tail:
            ways += [(i, w) for w in inserted[reverse][s]]
        for j, (t, more, edit) in ways:
            w = j * k + t
            label = (cost + more, edit + audit if reverse else audit + edit)
            known = mine.get(w)
            if known is not None and known <= label:
                continue
            mine[w] = label
            if known is None or label[0] < known[0]:
                heapq.heappush(heaps[reverse], (label[0], n - j if reverse else j, w))
            if w in other and (best is None or label[0] + other[w][0] < best):
                best = label[0] + other[w][0]
    if best is None:
        return None
    met = (fore[v][1] + back[v][1] for v in fore.keys() & back.keys() if fore[v][0] + back[v][0] == best)
    return best, min(met)


def whole(kinds: str) -> tuple[int, str]:
    return search([ROWS[x] for x in kinds], INSERTED, True, START, ENDS)


def part(kinds: str) -> dict:
    """{(state, state after): (cost, audit)} over some rows in the middle."""
    steps = [ROWS[x] for x in kinds]
    ways = {(s, t): search(steps, INSERTED, False, s, (t,)) for s in FILL for t in FILL}
    return {k: w for k, w in ways.items() if w}


def joined(parts: list[dict]) -> dict:
    """The same over neighbouring parts: the search runs over them as over rows, and a way's
    rank among those from its state stands for its audit."""
    while len(parts) > 1:
        parts = [_joined(parts[k : k + PIECE]) for k in range(0, len(parts), PIECE)]
    return parts[0]


def _joined(parts: list[dict]) -> dict:
    steps, ranked = [], []
    for ways in parts:
        edges, names = [], {}
        for s in FILL:
            mine = sorted((audit, t, cost) for (a, t), (cost, audit) in ways.items() if a == s)
            for rank, (audit, t, cost) in enumerate(mine):
                edges.append((s, t, cost, str(rank)))
                names[s, str(rank)] = (t, audit)
        steps.append(_both_ways(edges))
        ranked.append(names)
    found = {}
    for s in FILL:
        for t in FILL:
            if way := search(steps, NOTHING, False, s, (t,)):
                at, audits = s, []
                for names, rank in zip(ranked, way[1]):
                    at, audit = names[at, rank]
                    audits.append(audit)
                found[s, t] = (way[0], "".join(audits))
    return found


def finished(ways: dict) -> tuple[int, str]:
    return min((cost + 2 * len(TAIL[t]), audit + TAIL[t]) for (s, t), (cost, audit) in ways.items() if s == START)


class Run:
    """Neighbouring rows of one conversation: counts, borders and kinds."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}
        self.kinds: list[str] = []
        self.initials = ["", ""]  # of the first and the last row
        self.ends = [None, None]  # turns of the first and the last row that have one
        self.rows = 0

    def add(self, turn, initial: str, blank: bool, truncated: bool, again: bool, copies: int) -> None:
        for k in range(copies):
            repeat = again or k > 0
            fault = "blank" if blank else "duplicate" if repeat else "truncated" if truncated else None
            if fault:
                self.counts[fault] += 1
            kind = initial if initial in ("s", "u", "a") else OTHER
            self.kinds.append(GONE if fault in ("blank", "duplicate") else kind.upper() if fault else kind)
            if self.rows:
                self.counts["illegal"] += self.initials[1] + initial not in LEGAL
            else:
                self.initials[0] = initial
            self.initials[1] = initial
            self.rows += 1
        if copies and turn is not None:
            if self.ends[1] != turn:
                self.counts["turns"] += 1
            if self.ends[0] is None:
                self.ends[0] = turn
            self.ends[1] = turn

    def ways(self, part=part) -> dict:
        kinds = "".join(self.kinds)
        return joined([part(kinds[k : k + PIECE]) for k in range(0, len(kinds), PIECE)])

    def repair(self, whole=whole, part=part) -> tuple[int, str]:
        return whole("".join(self.kinds)) if len(self.kinds) <= PIECE else finished(self.ways(part))


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
BORDER = (
    "place int, n_rows long, turns long, initials array<string>, ends array<long>, ways array<struct<s int, t int, cost long, audit string>>"
)


def _gaps(ends, turns: int) -> int:
    return 0 if ends[0] is None else min(ends[1] - ends[0] + 1 - turns, (1 << 63) - 1)


def _solved(rows: DataFrame) -> DataFrame:
    """rows, sorted by ranges -> a row for each conversation that lies in one task, and the
    parts of those that may go on in the next task (``place`` is not null)."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = TaskContext.get().partitionId()
        # most conversations look like one another
        known = lru_cache(maxsize=1 << 16)(whole), lru_cache(maxsize=1 << 12)(part)
        target = pa.schema(
            [("conv", conv_type)]
            + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
            + [("audit", pa.string()), ("place", pa.int32()), ("n_rows", pa.int64()), ("turns", pa.int64())]
            + [("initials", pa.list_(pa.string())), ("ends", pa.list_(pa.int64()))]
            + [("ways", pa.list_(pa.struct([("s", pa.int32()), ("t", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]
        )

        def row(r: Run, border: bool) -> dict:
            found = {"conv": r.conv, **r.counts}
            if border:
                ways = [{"s": s, "t": t, "cost": c, "audit": a} for (s, t), (c, a) in r.ways(known[1]).items()] if r.rows else []
                return found | {"place": place, "n_rows": r.rows, "initials": r.initials, "ends": r.ends, "ways": ways}
            cost, audit = r.repair(*known)
            return found | {"gaps": _gaps(r.ends, r.counts["turns"]), "cost": cost, "audit": audit}

        now, first, out = None, True, []
        for batch in batches:
            for conv, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(row(now, first))
                        first = False
                    now = Run(conv)
                now.add(*values)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=target)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([row(now, True)], schema=target)

    from pyspark.sql.pandas.types import to_arrow_type

    conv_type = to_arrow_type(rows.schema["conv"].dataType)
    return rows.mapInArrow(run, f"conv {kind}, {COUNTS}, {BORDER}")


def _chained(parts: DataFrame) -> DataFrame:
    """One row for each conversation from its parts, one of a task at most."""
    conv_type = parts.schema["conv"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        found = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")}
        full = [r for r in rows if r["n_rows"]]
        found["illegal"] += sum(a["initials"][1] + b["initials"][0] not in LEGAL for a, b in zip(full, full[1:]))
        dated = [r for r in full if r["ends"][0] is not None]
        turns = sum(r["turns"] for r in dated) - sum(a["ends"][1] == b["ends"][0] for a, b in zip(dated, dated[1:]))
        found["gaps"] = _gaps((dated[0]["ends"][0], dated[-1]["ends"][1]), turns) if dated else 0
        ways = [{(w["s"], w["t"]): (w["cost"], w["audit"]) for w in r["ways"]} for r in full]
        found["cost"], found["audit"] = finished(joined(ways)) if ways else (0, "")
        conv = table.column("conv").slice(0, 1).combine_chunks()
        names = [c.split()[0] for c in COUNTS.split(", ")]
        kinds = [pa.string() if c == "audit" else pa.int64() for c in names]
        return pa.table([conv, *[pa.array([found[c]], k) for c, k in zip(names, kinds)]], names=["conv", *names])

    return parts.groupBy("conv").applyInArrow(run, f"conv {conv_type}, {COUNTS}")


def damaged(df: DataFrame) -> DataFrame:
    """conv, turn, role, text and how often the row stands there after the damage."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    by = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    rows = df.select(
        F.col("conv_id").alias("conv"),
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        by.alias("by"),
    )
    text = F.when(F.col("by") == 1, "").when(F.col("by") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv",
        "turn",
        F.when(F.col("by") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("by") == 0, 0).when(F.col("by") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def undamaged(df: DataFrame) -> DataFrame:
    """The same for conversations as they are."""
    return df.select(
        F.col("conv_id").alias("conv"),
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(1).cast("long").alias("copies"),
    )


def _hashed(rows: DataFrame) -> DataFrame:
    same = [F.col("conv").isNull(), "conv", "role", "text"]
    return rows.withColumns({"h1": F.xxhash64(*same), "h2": F.xxhash64(F.lit(1), *same)})


def _faults(hashed: DataFrame) -> DataFrame:
    """Narrow rows, each once: conv, turn, initial, blank, truncated, again, copies, in the
    order that the search takes them."""
    trimmed = F.rtrim("text", F.lit("\t\n\x0b\f\r "))
    narrow = hashed.select(
        "conv",
        "turn",
        "h1",
        "h2",
        F.left("role", F.lit(1)).alias("initial"),
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        "copies",
    )
    narrow = narrow.groupBy("conv", "turn", "h1", "h2", "initial", "blank", "truncated").agg(F.sum("copies").alias("copies"))
    told = narrow.filter("copies > 0").groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min("turn").alias("since"), F.max(F.col("turn").isNull()).alias("undated")
    )
    told = told.filter("n > 1").drop("n")
    later = F.when(F.col("undated"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("since"))
    marked = narrow.join(told, ["h1", "h2"], "left").withColumn("again", F.coalesce(later, F.lit(False)))
    order = ["conv", "turn", "h1", "h2"]
    return marked.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "turn", "initial", "blank", "truncated", "again", "copies"
    )


def _applied(laid: DataFrame) -> DataFrame:
    """Rows by conversation, its audit first -> the hash of its repaired text beside it."""
    conv = laid.schema["conv"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, at, state, begun = None, None, 0, START, False

        def put(role: str, text: str) -> None:
            nonlocal begun
            if begun:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
            begun = True

        def fill() -> None:
            nonlocal at, state
            while at < len(head[-1]) and head[-1][at] == "I":
                role, state = FILL[state]
                put(role, "")
                at += 1

        def end() -> tuple:
            fill()
            return (*head, digest.hexdigest())

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            out = []
            n = len(COLUMNS)
            for found in zip(*(c.to_pylist() for c in batch.columns)):
                if found[1] == 0:
                    if head is not None:
                        out.append(end())
                    head, digest, at, state, begun = (found[0], *found[2 : 2 + n]), hashlib.sha256(), 0, START, False
                    continue
                role, text, copies = found[2 + n :]
                for _ in range(copies):
                    fill()
                    edit = head[-1][at]
                    at += 1
                    if edit == "R":
                        role_now, state = FILL[state]
                        put(role_now, text)
                    elif edit == "K":
                        state = AFTER[state, role[:1]]
                        put(role, text)
            if out:
                yield table(out)
        if head is not None:
            yield table([end()])

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(conv), *[pa.string() if c == "audit" else pa.int64() for c in COLUMNS], pa.string()]
    names = ["conv", *COLUMNS, "repaired_sha256"]
    return laid.mapInArrow(run, f"conv {conv.simpleString()}, {COUNTS}, repaired_sha256 string")


COLUMNS = [c.split()[0] for c in COUNTS.split(", ")]


def repair(rows: DataFrame) -> DataFrame:
    """rows (conv, turn, role, text, copies) -> one row for each conversation: gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    hashed = _hashed(rows)
    solved = stage(_solved(_faults(hashed)), "conversation-repairs")
    names = ["conv", *COLUMNS]
    audits = solved.filter("place IS NULL").select(*names).unionByName(_chained(solved.filter("place IS NOT NULL")))
    heads = audits.select("conv", F.lit(0).alias("part"), *COLUMNS)
    texts = hashed.filter("copies > 0").select("conv", F.lit(1).alias("part"), "turn", "h1", "h2", "role", "text", "copies")
    laid = heads.unionByName(texts, allowMissingColumns=True).repartition("conv")
    laid = laid.sortWithinPartitions("conv", "part", "turn", "h1", "h2")
    return _applied(laid.select("conv", "part", *COLUMNS, "role", "text", "copies"))


def repair_damaged(df: DataFrame) -> DataFrame:
    return repair(damaged(df)).withColumnRenamed("conv", "conv_id")
