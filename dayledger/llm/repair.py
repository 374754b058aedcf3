"""Repair of the turns of conversations by a dynamic programme over persistent audits.

A repaired conversation has role initials ``(s?(ua)+)?``. Rows are kept, given
another role or deleted, and empty rows are inserted; an audit is the list of
edits, by their initials. For each row and each state of that pattern the
programme holds the cheapest audit so far. Audits share their prefixes as
linked nodes; each node knows its 2^k-th ancestors and a rolling hash of its
audit, so that audits of equal cost are compared at the end of their longest
common prefix, found by binary lifting. What the hashes call equal is verified
by its letters.

Conversations are sorted by ranges and cut into segments of bounded length. A
segment is worked out for each state it may begin in, and a conversation then
chooses among the outcomes of its segments, of which it needs costs and order
only. So a conversation of any length is spread over tasks. Audits of equal
cost over the same rows end with a row's edit and so none is a prefix of
another: the order of two outcomes is settled within the segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.session import materialize, parts_for, shuffle_parts

START, SYSTEM, USER, ASSISTANT = range(4)  # last role of the repaired rows so far
NEEDS = "uuau"  # initial that must follow each state; "s" may follow START
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {"u": "user", "a": "assistant"}
TAIL = ("", "II", "I", "")  # inserts that end a conversation from each state
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SEGMENT_ROWS = 4096
SLICE_ROWS = 200_000
FIELD = (1 << 61) - 1
BASE = 1_000_003


class Audits:
    """Audits as nodes linked to the audit without the last edit; node 0 is the empty one."""

    def __init__(self):
        self.last, self.depth, self.hash = [""], [0], [1]
        self.up: list[list[int]] = [[]]  # ancestors 1, 2, 4, ... edits before
        self.equal: set[tuple[int, int]] = set()  # nodes whose audits were compared letter by letter

    def add(self, node: int, edits: str) -> int:
        for e in edits:
            ups, a = [node], node
            for k in range(self.depth[node].bit_length()):
                if k >= len(self.up[a]):
                    break
                a = self.up[a][k]
                ups.append(a)
            self.last.append(e)
            self.depth.append(self.depth[node] + 1)
            self.hash.append((self.hash[node] * BASE + ord(e)) % FIELD)
            self.up.append(ups)
            node = len(self.last) - 1
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.last[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def ancestor(self, node: int, depth: int) -> int:
        above = self.depth[node] - depth
        while above:
            k = above.bit_length() - 1
            node = self.up[node][k]
            above -= 1 << k
        return node

    def verified(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth, equal by hash, hold the same letters; pairs seen before are not read again."""
        path = []
        while a != b and (a, b) not in self.equal:
            if self.last[a] != self.last[b]:
                return False
            path.append((a, b))
            a, b = self.up[a][0], self.up[b][0]
        self.equal.update(path)
        return True

    def compare(self, x: int, y: int) -> int:
        """Negative where the audit of x comes before that of y."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self.ancestor(x, depth), self.ancestor(y, depth)
        if self.hash[a] == self.hash[b]:
            if self.verified(a, b):
                return self.depth[x] - self.depth[y]
        else:
            for k in range(len(self.up[a]) - 1, -1, -1):
                if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                    a, b = self.up[a][k], self.up[b][k]
            if self.last[a] != self.last[b] and self.verified(self.up[a][0], self.up[b][0]):
                return -1 if self.last[a] < self.last[b] else 1
        # two different audits of one hash
        s, t = self.text(x), self.text(y)
        return (s > t) - (s < t)


def moves(state: int, initial: str, must_go: bool, truncated: bool) -> Iterator[tuple[str, int, int]]:
    """(edits, cost, next state) for one row. More than one insert before a row, or one before a deletion, is never among the best."""
    yield "D", DELETE, state
    if must_go:
        return
    extra = TRUNCATED * truncated
    for before, cost in (("", extra), ("I", extra + INSERT)):
        need = NEEDS[state]
        if initial == need or (initial == "s" and state == START):
            yield before + "K", cost, AFTER[initial]
        yield before + "R", cost + REROLE, AFTER[need]
        state = AFTER[need]


def outcomes(rows: list[tuple[str, bool, bool]], entries: tuple[int, ...]) -> tuple[list, list, list]:
    """Costs, audits and order by audit, of 16 each: entry state * 4 + exit state; null where there is none."""
    costs, texts, order = [None] * 16, [None] * 16, [None] * 16
    for entry in entries:
        audits = Audits()
        best: dict[int, tuple[int, int]] = {entry: (0, 0)}
        for initial, must_go, truncated in rows:
            # the cheapest ways to each state; equal ones are told apart by their audits
            ways: dict[int, tuple[int, list[tuple[int, str]]]] = {}
            for state, (spent, node) in best.items():
                for edits, cost, to in moves(state, initial, must_go, truncated):
                    cost += spent
                    if to not in ways or cost < ways[to][0]:
                        ways[to] = (cost, [(node, edits)])
                    elif cost == ways[to][0]:
                        ways[to][1].append((node, edits))
            best = {}
            for to, (cost, options) in ways.items():
                first, *others = [audits.add(node, edits) for node, edits in options]
                for other in others:
                    if audits.compare(other, first) < 0:
                        first = other
                best[to] = (cost, first)
        for place, to in enumerate(sorted(best, key=cmp_to_key(lambda a, b: audits.compare(best[a][1], best[b][1])))):  # noqa: B023
            at = entry * 4 + to
            costs[at], texts[at], order[at] = best[to][0], audits.text(best[to][1]), place
    return costs, texts, order


def chosen(segments: list[dict]) -> tuple[int, int, list[tuple[int, int, int, str]]]:
    """Cost, illegal pairs and (segment, entry, exit, last inserts) of a conversation from its segments in order."""
    ahead = [[INSERT * len(t) for t in TAIL]]
    inf = float("inf")
    for s in reversed(segments):
        cost = [c if c is not None else inf for c in s["costs"]]
        ahead.append([min(cost[e * 4 + t] + ahead[-1][t] for t in range(4)) for e in range(4)])
    ahead.reverse()
    state, picks = START, []
    for k, s in enumerate(segments):
        options = [t for t in range(4) if s["costs"][state * 4 + t] is not None and s["costs"][state * 4 + t] + ahead[k + 1][t] == ahead[k][state]]
        to = min(options, key=lambda t: s["ranks"][state * 4 + t])
        picks.append((s["seg"], state, to, TAIL[to] if k == len(segments) - 1 else ""))
        state = to
    between = sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(segments, segments[1:]))
    return ahead[0][START], sum(s["illegal"] for s in segments) + between, picks


def applied(audit: str, state: int, rows: list[tuple]) -> list[dict]:
    """Repaired rows of a segment: turn and say of the row kept, or nulls for an insert, and the new role, null where it stays."""
    out, at = [], iter(rows)
    for e in audit:
        row = None if e == "I" else next(at)
        if e == "D":
            continue
        if e == "K":
            initial = row["initial"]
            out.append({"role": None, "turn": row["turn"], "say": row["say"]})
        else:
            initial = NEEDS[state]
            out.append({"role": ROLES[initial], "turn": row["turn"] if row else None, "say": row["say"] if row else None})
        state = AFTER[initial]
    return out


def half_sha(c: Column) -> Column:
    """128 bits of the sha256 of a text."""
    return F.unhex(F.substring(F.sha2(c, 256), 1, 32))


def row_key() -> Column:
    return half_sha(F.concat(F.to_json(F.struct("conv", "turn")), F.lit(" "), F.hex("say")))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(reports, repaired rows) of conversations.

    Reports, one per conversation: conv, gaps (turns missing between the least and the greatest), blank, duplicate and
    truncated (first fault of each row: no character but spaces; role and text stood before; last character no ``.!?``),
    illegal (neighbours whose initials are not su, ua or au), cost, audit. Repaired rows: conv, seg and k (their order), role,
    text. Rows stand in the order of their turns, nulls first, and of a hash of role and text within a turn. Null roles and
    texts count as one space; null ids are one conversation; equal rows stand one after another. Roles count by their first
    letter. An audit is one cell, so a conversation may have up to 2^31 edits. Other columns do not take part. An empty table
    has no reports.
    """
    spark = rows.sparkSession
    said = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text")
    )
    said = said.withColumn("say", half_sha(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    told = F.expr("rtrim(' \t\n\u000b\f\r', text)")
    lines = said.select(
        "conv", "turn", "say", F.substring("role", 1, 1).alias("initial"), (told == "").alias("blank"),
        (~F.substring(told, -1, 1).isin(".", "!", "?")).alias("open"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("fresh"),
    )
    # equal rows become one with a count; the first turn of each role and text is marked by a row of no count
    line = ["conv", "turn", "say", "initial", "blank", "open"]
    once = lines.groupBy(*line).agg(F.sum("n").alias("n"), F.max("fresh").alias("fresh"))
    turns = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = lines.groupBy("conv", "say", "initial", "blank", "open").agg(F.min(turns).alias("t"))
    firsts = firsts.select("conv", F.col("t.turn").alias("turn"), *line[2:], F.lit(0).cast("long").alias("n"), F.lit(True).alias("fresh"))
    narrow = once.unionByName(firsts).groupBy(*line).agg(F.sum("n").alias("n"), F.max("fresh").alias("fresh"))
    narrow = materialize(narrow, "repair-rows")
    stay = F.when(F.col("blank") | ~F.col("fresh"), 0).otherwise(1)
    counts = narrow.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("n") - stay).otherwise(0)).alias("duplicate"),
        F.sum(F.when(F.col("open"), stay).otherwise(0)).alias("truncated"),
    )
    counts = counts.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )

    order = ["conv", "turn", "say"]
    n = max(shuffle_parts(spark), parts_for(narrow, SLICE_ROWS))
    sorted_rows = narrow.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("slice", F.spark_partition_id())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(conversation, whether it surely begins here, segment, rows) with rows as (turn, say, initial, must go, truncated)."""
        held, now, fresh, whole, seg = [], None, False, True, None
        for b in batches:
            for r in b.to_pylist():
                if seg is None:
                    seg, now = r["slice"] << 32, r["conv"]
                elif r["conv"] != now:
                    yield now, fresh, seg, held
                    held, now, fresh, seg = [], r["conv"], True, seg + 1
                for k in range(r["n"]):
                    if len(held) == SEGMENT_ROWS:
                        yield now, fresh, seg, held
                        held, fresh, seg = [], False, seg + 1
                    go = r["blank"] or not r["fresh"] or k > 0
                    held.append((r["turn"], r["say"], r["initial"], go, r["open"]))
        if held:
            yield now, fresh, seg, held

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for name, fresh, seg, held in cut(batches):
            costs, texts, ranks = outcomes([h[2:] for h in held], (START,) if fresh else (START, SYSTEM, USER, ASSISTANT))
            illegal = sum(a[2] + b[2] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
            out.append({
                "conv": name, "seg": seg, "costs": costs, "ranks": ranks, "audits": texts, "illegal": illegal,
                "first": held[0][2], "last": held[-1][2], "rows": [{"turn": h[0], "say": h[1], "initial": h[2]} for h in held],
            })
            if len(out) >= 500:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    kind, turn_kind = rows.schema[conv].dataType, rows.schema[turn].dataType
    row_type = f"struct<turn:{turn_kind.simpleString()},say:binary,initial:string>"
    ddl = f"conv {kind.simpleString()}, seg long, costs array<long>, ranks array<long>, audits array<string>, illegal long, first string, last string, rows array<{row_type}>"
    arrow = arrow_schema(ddl)
    segments = materialize(sorted_rows.mapInArrow(work, ddl), "repair-segments")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                cost, illegal, picks = chosen(r["segments"])
                out.append({"conv": r["conv"], "cost": cost, "illegal": illegal, "picks": [dict(zip(("seg", "entry", "exit", "tail"), p, strict=True)) for p in picks]})
            yield pa.RecordBatch.from_pylist(out, schema=pick_arrow)

    pick_ddl = f"conv {kind.simpleString()}, cost long, illegal long, picks array<struct<seg:long,entry:long,exit:long,tail:string>>"
    pick_arrow = arrow_schema(pick_ddl)
    parts = segments.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", "costs", "ranks", "illegal", "first", "last"))).alias("segments"))
    choices = materialize(parts.mapInArrow(choose, pick_ddl), "repair-choices")
    picks = choices.select(F.explode("picks").alias("p")).select("p.*")
    made = segments.join(picks, "seg").withColumn("audit", F.element_at("audits", (F.col("entry") * 4 + F.col("exit") + 1).cast("int")))
    made = made.withColumn("audit", F.concat("audit", "tail")).select("conv", "seg", "entry", "audit", "rows")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [{"conv": r["conv"], "seg": r["seg"], "audit": r["audit"], "kept": applied(r["audit"], r["entry"], r["rows"])} for r in b.to_pylist()]
            yield pa.RecordBatch.from_pylist(out, schema=made_arrow)

    kept_type = f"struct<role:string,turn:{turn_kind.simpleString()},say:binary>"
    made_ddl = f"conv {kind.simpleString()}, seg long, audit string, kept array<{kept_type}>"
    made_arrow = arrow_schema(made_ddl)
    made = materialize(made.mapInArrow(rebuild, made_ddl), "repair-audits")
    audits = made.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", "audit"))).alias("parts"))
    audits = audits.select("conv", F.array_join("parts.audit", "").alias("audit"))
    reports = one_row_each("conv", counts, choices.select("conv", "cost", "illegal"), audits)

    edits = made.select("conv", "seg", F.posexplode("kept").alias("k", "e")).select("conv", "seg", "k", F.col("e.role").alias("new"), "e.turn", "e.say")
    texts = said.select(row_key().alias("row"), "role", "text").groupBy("row").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    kept = edits.filter(F.col("say").isNotNull()).withColumn("row", row_key()).join(texts, "row")
    kept = kept.select("conv", "seg", "k", F.coalesce("new", "role").alias("role"), "text")
    added = edits.filter(F.col("say").isNull()).select("conv", "seg", "k", F.col("new").alias("role"), F.lit("").alias("text"))
    return reports, kept.unionByName(added)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


def one_row_each(key: str, *frames: DataFrame) -> DataFrame:
    """The columns of frames of one row per key beside each other; null is a key, and missing rows give nulls."""
    cols = [c for f in frames for c in f.columns if c != key]
    united = frames[0]
    for f in frames[1:]:
        united = united.unionByName(f, allowMissingColumns=True)
    return united.groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


def text_digests(rows: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): the rows of each conversation as ``role:text`` joined by line ends, hashed as they stream by."""
    n = shuffle_parts(rows.sparkSession)
    order = ["conv", "seg", "k"]
    lines = rows.select(*order, F.concat("role", F.lit(":"), "text").alias("line")).repartition(n, "conv").sortWithinPartitions(*order)
    kind = rows.schema["conv"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for b in batches:
            names, out = [], []
            for name, line in zip(b.column("conv").to_pylist(), b.column("line").to_pylist(), strict=True):
                if sha is not None and name == now:
                    sha.update(b"\n")
                else:
                    if sha is not None:
                        names.append(now)
                        out.append(sha.hexdigest())
                    now, sha = name, hashlib.sha256()
                sha.update(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, b.schema.field("conv").type), pa.array(out, pa.string())], names=["conv", "repaired_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], b.schema.field("conv").type), pa.array([sha.hexdigest()], pa.string())], names=["conv", "repaired_sha256"])

    return lines.mapInArrow(digest, f"conv {kind}, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults: by the crc32 of id and turn, rows go, lose their text or its sentence ends, come twice or become the user's."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    out = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), h.alias("h")).filter("h <> 0")
    out = out.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "h")
    return out.withColumn("copy", F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).select("conv_id", "turn", "role", "text")


def repair_report(rows: DataFrame) -> DataFrame:
    """Per conversation before the damage: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    reports, repaired = repair(damaged(rows.select("conv_id", "turn", "role", "text")))
    every = rows.select(F.col("conv_id").alias("conv")).distinct()
    out = one_row_each("conv", every, reports, text_digests(repaired))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        F.col("conv").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
