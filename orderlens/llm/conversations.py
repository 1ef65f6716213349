"""Conversation structure repair: rank-convergence parallel Viterbi.

A conversation's rows in order of turn are edited so that the initials of
its roles read ``(s?(ua)+)?``: rows are kept, given another role, deleted or
inserted, at the least cost (``Costs``), ties broken by the ASCII-least audit
(the edits' initials). The grammar has four states (nothing yet, system, user,
assistant said last); the cost to go of every state at a row follows from
that at the next row, a Viterbi pass from the end.

A conversation may hold a third of all rows, so no task owns one. Rows become
one byte each (role initial and fault) and are range-partitioned by
conversation and turn; the part of a conversation in one partition is a
*chunk*. Each chunk starts at its end from a speculative cost vector, right
where the conversation ends there. Fix-up passes rerun a chunk from what its
successor really begins with, until the vectors differ only by a constant
(from there on nothing changes); what a chunk made of a vector is kept,
so the passes are as many as vectors occur, not as chunks. Only the first and
last conversation of a partition can go on beyond it, so a pass works on at
most two chunks a partition. The stitched costs then drive the tracing: per
chunk for every state it may begin in, next with the state it does begin in.

Last, the texts meet their edits in one sorted stream, which writes the
repaired conversation into its hash. SHA-256 is sequential by definition: the
texts of one conversation pass through one task, row by row.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import stored

START, SYSTEM, USER, ASSISTANT = range(4)
AFTER_KEEP = {0: {START: SYSTEM}, 1: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, 3: {}}  # by initial: s u a other
AFTER_NEW = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # the role that may follow, inserted or re-roled
LEGAL = {(0, 1), (1, 2), (2, 1)}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
WHITE = " \t\n\v\f\r"
FAR = 1 << 60


class Costs(NamedTuple):
    rerole: int = 1
    delete: int = 2
    insert: int = 5  # at least 1
    truncated: int = 5  # for a truncated row that is not deleted


class Viterbi:
    """Cost vectors (cost to go of each state, least 0) and the edits they
    choose; both memoised, as few vectors occur."""

    def __init__(self, costs: Costs):
        self.costs, self.steps, self.choices = costs, {}, {}
        self.end = self.closed([0, FAR, FAR, 0])[0]

    def closed(self, raw: list[int]) -> tuple[tuple[int, ...], int]:
        """``raw`` with insertions allowed, and what was taken off to make the least 0."""
        for _ in range(3):
            raw = [min(raw[s], self.costs.insert + raw[AFTER_NEW[s]]) for s in range(4)]
        return tuple(x - min(raw) for x in raw), min(raw)

    def options(self, code: int, s: int):
        """(edit, cost, next state) of a row in state ``s``."""
        initial, fault = code >> 2, code & 3
        yield "D", self.costs.delete, s
        if fault in (SOUND, TRUNCATED):
            more = self.costs.truncated if fault == TRUNCATED else 0
            if s in AFTER_KEEP[initial]:
                yield "K", more, AFTER_KEEP[initial][s]
            yield "R", self.costs.rerole + more, AFTER_NEW[s]

    def step(self, after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int]:
        """The vector before a row, and the cost that every state has on top."""
        got = self.steps.get((after, code))
        if got is None:
            got = self.steps[after, code] = self.closed(
                [min(cost + after[t] for _, cost, t in self.options(code, s)) for s in range(4)])
        return got

    def begin(self, codes: bytes, end: tuple[int, ...], known: tuple | None = None) -> tuple[int, ...]:
        """The vector before a chunk. With ``known`` (another end vector and
        its begin), stops where the two differ only by a constant."""
        other = known and known[0]
        for code in reversed(codes):
            if other == end:
                return known[1]
            end = self.step(end, code)[0]
            other = other and self.step(other, code)[0]
        return end

    def choose(self, after: tuple[int, ...], code: int, s: int) -> tuple[str, int, int]:
        """(edits up to and with the row's own, cost, next state): of the
        cheapest the ASCII-least (D < I < K < R)."""
        got = self.choices.get((after, code, s))
        if got is None:
            before, top = self.step(after, code)
            edits, paid, t = "", 0, s
            while True:
                best = {e: (c, n) for e, c, n in self.options(code, t) if c + after[n] == before[t] + top}
                if "D" not in best and self.costs.insert + before[AFTER_NEW[t]] == before[t]:
                    edits, paid, t = edits + "I", paid + self.costs.insert, AFTER_NEW[t]
                    continue
                edit = min(best)
                got = self.choices[after, code, s] = edits + edit, paid + best[edit][0], best[edit][1]
                break
        return got

    def trace(self, codes: bytes, end: tuple[int, ...], s: int, last: bool) -> tuple[str, int, int]:
        """(audit, cost, state after) of a chunk that begins in state ``s``;
        the ``last`` one of a conversation also completes it."""
        after = [end]
        for code in reversed(codes[1:]):
            after.append(self.step(after[-1], code)[0])
        audit, cost = [], 0
        for code in codes:
            edits, paid, s = self.choose(after.pop(), code, s)
            audit.append(edits)
            cost += paid
        while last and s in (SYSTEM, USER):
            audit.append("I")
            cost, s = cost + self.costs.insert, AFTER_NEW[s]
        return "".join(audit), cost, s


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text and ``copies`` of every row (0: dropped, 2: said
    twice in a row), damaged by crc32 of ``conv_id:turn`` modulo 20: 0 drops the
    row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its
    role user. Null ids (in the crc), roles and texts are one space."""
    conv, at = F.col(f"`{conv_id}`"), F.col(f"`{turn}`")
    kind = F.crc32(F.concat(*(F.coalesce(c.cast("string"), F.lit(" ")) if c is not None else F.lit(":") for c in (conv, None, at)))) % 20
    spoken = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))
    return rows.select(
        conv.alias("conv"), at.cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(spoken, ".!?", "")).otherwise(spoken).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def as_rows(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Undamaged rows in the form that ``repair`` takes."""
    return rows.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                       *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(a) for c, a in ((role, "role"), (text, "text"))),
                       F.lit(1).alias("copies"))


def with_key(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``, a SHA-256 of conversation, role and text: equal
    keys are equal rows but for the turn, and order rows of one turn."""
    whole = F.concat(F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")), F.lit("\n"),
                     F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("key", F.unhex(F.sha2(whole, 256)))


def coded_rows(rows: DataFrame) -> DataFrame:
    """(conv, turn, key, code, n, fresh) of the distinct rows: ``code`` holds
    role initial and fault of the text alone, ``n`` counts equal rows of the
    turn, ``fresh`` says that no earlier turn has the same role and text."""
    initial = F.substring("role", 1, 1)
    said = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(said == "", BLANK).when(F.substring(said, -1, 1).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) * 4 + fault
    narrow = stored(with_key(rows.where("copies > 0")).select("conv", "turn", "key", code.cast("int").alias("code"), "copies"))
    first = narrow.groupBy("key").agg(F.min(F.struct("turn")).alias("first"))  # nulls first, as in the order of rows
    return narrow.join(first, "key").groupBy("key", "conv", "turn", "code").agg(
        F.sum("copies").alias("n"), F.max(F.col("first.turn").eqNullSafe(F.col("turn"))).alias("fresh"))


CHUNK = ("chunk long, edge boolean, turn long, key binary, codes binary, least_turn long, most_turn long, n_turns long, last_turn long")


def chunk_rows(rows: DataFrame, width: int | None) -> DataFrame:
    """One row per conversation and partition, in order of ``chunk`` within a
    conversation: where it begins (turn, key), its rows as bytes, its turns;
    ``edge``: the conversation may go on in another partition."""
    by = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("key")]
    dealt = rows.repartitionByRange(*([width] if width else []), *by).sortWithinPartitions(*by)
    schema = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *T.StructType.fromDDL(CHUNK).fields])

    def run(batches):
        base, made, open_chunk = TaskContext.get().partitionId() << 40, 0, None
        for b in batches:
            done = []
            for conv, turn, key, code, n, fresh in zip(*(b.column(k).to_pylist() for k in range(6))):
                if open_chunk is None or open_chunk["conv"] != conv:
                    if open_chunk is not None:
                        done.append(open_chunk)
                    open_chunk = {"conv": conv, "chunk": base + made, "edge": made == 0, "turn": turn, "key": key, "codes": bytearray(),
                                  "least_turn": turn, "most_turn": turn, "n_turns": 0, "last_turn": None}
                    made += 1
                again = code if code & 3 == BLANK else code & 12 | DUPLICATE
                open_chunk["codes"] += bytes([code if fresh else again]) + bytes([again]) * (n - 1)
                if turn is not None and turn != open_chunk["last_turn"]:
                    open_chunk["n_turns"] += 1
                    open_chunk["least_turn"] = turn if open_chunk["least_turn"] is None else open_chunk["least_turn"]
                    open_chunk["most_turn"] = open_chunk["last_turn"] = turn
            if done:
                yield _batch(done, arrow)
        if open_chunk is not None:
            yield _batch([open_chunk | {"edge": True}], arrow)

    arrow = _arrow(schema)
    return dealt.select("conv", "turn", "key", "code", "n", "fresh").mapInArrow(run, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[dict], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{k: bytes(v) if isinstance(v, bytearray) else v for k, v in r.items()} for r in rows], schema=arrow)


def settle(edges: DataFrame, costs: Costs) -> DataFrame:
    """(chunk, end, state, last) of the chunks in ``edges`` (conv, chunk,
    codes): the cost vector they end with, the state they begin in, whether
    their conversation ends there. The fix-up passes: each stitches a
    conversation's chunks from the last to the first by what is known, and
    reruns those that must start from a vector they were not yet run from."""
    viterbi = Viterbi(costs)
    spec = list(viterbi.end)

    def rerun(batches):
        v = Viterbi(costs)
        for b in batches:
            rows = b.to_pylist()
            yield pa.RecordBatch.from_pylist(
                [{"chunk": r["chunk"], "used": r["want"],
                  "begin": list(v.begin(r["codes"], tuple(r["want"]), r["begin"] and (tuple(spec), tuple(r["begin"]))))} for r in rows],
                schema=pa.schema([("chunk", pa.int64()), ("used", pa.list_(pa.int64())), ("begin", pa.list_(pa.int64()))]))

    def stitch(batches):
        for b in batches:
            out = []
            for row in b.column(0).to_pylist():
                known: dict[int, dict] = {}
                for r in row:
                    known.setdefault(r["chunk"], {})[tuple(r["used"])] = tuple(r["begin"])
                end = tuple(spec)
                for k, chunk in enumerate(sorted(known, reverse=True)):
                    out.append({"chunk": chunk, "want": list(end), "found": end in known[chunk], "last": k == 0})
                    end = known[chunk].get(end, known[chunk][tuple(spec)])
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("chunk", pa.int64()), ("want", pa.list_(pa.int64())), ("found", pa.bool_()), ("last", pa.bool_())]))

    vector = F.array(*(F.lit(x).cast("long") for x in spec))
    runs = "chunk long, used array<long>, begin array<long>"
    first = stored(edges.select("chunk", "codes", vector.alias("want"), F.lit(None).cast("array<long>").alias("begin"))
                   .mapInArrow(rerun, runs))
    known = first
    while True:
        plan = stored(known.join(edges.select("conv", "chunk"), "chunk").groupBy("conv")
                      .agg(F.collect_list(F.struct("chunk", "used", "begin")).alias("chunks"))  # two chunks a partition at most
                      .select("chunks").mapInArrow(stitch, "chunk long, want array<long>, found boolean, last boolean"))
        missing = plan.where("not found").select("chunk", "want")
        if missing.isEmpty():
            break
        known = stored(known.unionByName(missing.join(edges.select("chunk", "codes"), "chunk").join(first.select("chunk", "begin"), "chunk")
                                         .select("chunk", "codes", "want", "begin").mapInArrow(rerun, runs)))

    def exits(batches):
        v = Viterbi(costs)
        for b in batches:
            rows = b.to_pylist()
            yield pa.RecordBatch.from_pylist([{"chunk": r["chunk"], "exits": [v.trace(r["codes"], tuple(r["want"]), s, False)[2] for s in range(4)]}
                                              for r in rows], schema=pa.schema([("chunk", pa.int64()), ("exits", pa.list_(pa.int64()))]))

    def enter(batches):
        for b in batches:
            out = []
            for row in b.column(0).to_pylist():
                s = START
                for r in sorted(row, key=lambda r: r["chunk"]):
                    out.append({"chunk": r["chunk"], "state": s})
                    s = r["exits"][s]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("chunk", pa.int64()), ("state", pa.int64())]))

    through = (edges.select("chunk", "codes").join(plan, "chunk").select("chunk", "codes", "want")
               .mapInArrow(exits, "chunk long, exits array<long>"))
    states = (through.join(edges.select("conv", "chunk"), "chunk").groupBy("conv").agg(F.collect_list(F.struct("chunk", "exits")).alias("chunks"))
              .select("chunks").mapInArrow(enter, "chunk long, state long"))
    return plan.join(states, "chunk").select("chunk", F.col("want").alias("end"), "state", "last")


TRACED = ("audit string, cost long, n_blank long, n_duplicate long, n_truncated long, n_illegal long, first int, last int, "
          "least_turn long, most_turn long, n_turns long, first_turn long, last_turn long")


def traced_chunks(rows: DataFrame, costs: Costs, width: int | None) -> DataFrame:
    """(conv, turn, key, part struct): every chunk's audit, cost and counts,
    beside the place of its first row."""
    chunks = stored(chunk_rows(rows, width))
    settled = stored(settle(chunks.where("edge").select("conv", "chunk", "codes"), costs))
    schema = T.StructType([chunks.schema["conv"], chunks.schema["turn"], chunks.schema["key"],
                           T.StructField("part", T.StructType.fromDDL(TRACED))])
    arrow = _arrow(schema)

    def run(batches):
        v = Viterbi(costs)
        for b in batches:
            out = []
            for r in b.to_pylist():
                codes, alone = r["codes"], r["end"] is None
                audit, cost, _ = v.trace(codes, v.end if alone else tuple(r["end"]), START if alone else r["state"], alone or r["last"])
                pairs: dict[tuple, int] = {}
                for p in zip(codes, codes[1:]):
                    p = p[0] >> 2, p[1] >> 2
                    pairs[p] = pairs.get(p, 0) + 1
                faults = [0, 0, 0, 0]
                for c in codes:
                    faults[c & 3] += 1
                out.append({"conv": r["conv"], "turn": r["turn"], "key": r["key"], "part": {
                    "audit": audit, "cost": cost, "n_blank": faults[BLANK], "n_duplicate": faults[DUPLICATE], "n_truncated": faults[TRUNCATED],
                    "n_illegal": sum(n for p, n in pairs.items() if p not in LEGAL), "first": codes[0] >> 2, "last": codes[-1] >> 2,
                    "first_turn": r["turn"], **{k: r[k] for k in ("least_turn", "most_turn", "n_turns", "last_turn")}}})
            yield _batch(out, arrow)

    return chunks.join(settled, "chunk", "left").select(
        "conv", "turn", "key", "codes", "least_turn", "most_turn", "n_turns", "last_turn", "end", "state", "last").mapInArrow(run, schema)


class Repaired:
    """The repaired conversation as its chunks and texts come by, in order."""

    def __init__(self, conv):
        self.conv, self.state, self.hash, self.lines, self.rest = conv, START, hashlib.sha256(), 0, iter("")
        self.audit: list[str] = []
        self.cost = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.last_turn = self.last = None

    def part(self, p: dict) -> None:
        self.audit.append(p["audit"])
        self.rest = iter(p["audit"])
        self.cost += p["cost"]
        self.blank, self.duplicate, self.truncated = self.blank + p["n_blank"], self.duplicate + p["n_duplicate"], self.truncated + p["n_truncated"]
        self.illegal += p["n_illegal"] + (self.last is not None and (self.last, p["first"]) not in LEGAL)
        self.last = p["last"]
        self.turns += p["n_turns"] - (self.last_turn is not None and self.last_turn == p["first_turn"])
        if p["n_turns"]:
            self.least = p["least_turn"] if self.least is None else self.least
            self.most, self.last_turn = p["most_turn"], p["last_turn"]

    def line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def new_role(self) -> str:
        self.state = AFTER_NEW[self.state]
        return "user" if self.state == USER else "assistant"

    def text(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            while (edit := next(self.rest)) == "I":
                self.line(self.new_role(), "")
            if edit == "K":
                self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                self.line(role, text)
            elif edit == "R":
                self.line(self.new_role(), text)

    def row(self) -> dict:
        for _ in self.rest:  # what completes the conversation is inserted
            self.line(self.new_role(), "")
        gaps = self.most - self.least + 1 - self.turns if self.least is not None else 0
        return {"conv_id": self.conv, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


def repair(rows: DataFrame, costs: Costs = Costs(), width: int | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 of every conversation in ``rows`` (conv, turn, role, text,
    copies; see ``as_rows`` and ``damage``).

    Rows are ordered by turn, nulls first, rows of one turn by a hash of role
    and text (equal ones side by side). Each row's first fault counts: blank
    (no other than white space), duplicate (role and text of an earlier row of
    the conversation), truncated (the last character that is not white space
    is none of ``.!?``). Blank and duplicate rows are deleted; costs and ties
    see the head of the module. gaps: most - least turn + 1 - distinct turns,
    nulls left out (0 where all are null); illegal: neighbouring role initials
    other than su, ua, au. repaired_sha256: of the repaired rows as
    ``role:text``, joined by newlines; inserted rows have no text.

    A null id is a conversation of its own. A conversation of which no row has
    copies gives zeros, an empty audit and the hash of nothing. An empty table
    gives an empty result; ``width`` sets the number of partitions of the
    chunks (default: as the session shuffles)."""
    parts = traced_chunks(coded_rows(rows), costs, width)
    part = T.StructType.fromDDL(TRACED)
    nothing = F.lit(None)
    texts = with_key(rows.where("copies > 0")).select(
        "conv", "turn", "key", F.lit(1).alias("kind"), "role", "text", "copies", nothing.cast(part).alias("part"))
    heads = parts.select("conv", "turn", "key", F.lit(0).alias("kind"), nothing.cast("string").alias("role"), nothing.cast("string").alias("text"),
                         nothing.cast("int").alias("copies"), "part")
    silent = rows.where("copies = 0").select("conv").distinct().select(
        "conv", nothing.cast("long").alias("turn"), nothing.cast("binary").alias("key"), F.lit(2).alias("kind"),
        nothing.cast("string").alias("role"), nothing.cast("string").alias("text"), nothing.cast("int").alias("copies"), nothing.cast(part).alias("part"))
    order = ["conv", F.col("turn").asc_nulls_first(), "key", "kind"]
    stream = texts.unionByName(heads).unionByName(silent).repartition("conv").sortWithinPartitions(*order)
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv"].dataType),
                           *(T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    arrow = _arrow(schema)

    def run(batches):
        now = None
        for b in batches:
            done = []
            for conv, kind, role, text, copies, head in zip(*(b.column(k).to_pylist() for k in range(6))):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = Repaired(conv)
                if kind == 0:
                    now.part(head)
                elif kind == 1:
                    now.text(role, text, copies)
            if done:
                yield _batch(done, arrow)
        if now is not None:
            yield _batch([now.row()], arrow)

    return stream.select("conv", "kind", "role", "text", "copies", "part").mapInArrow(run, schema)
