"""Conversation repair against an enumeration of all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from orderlens.llm import conversations as C

GOOD = re.compile(r"(s?(ua)+)?")
EMPTY = hashlib.sha256(b"").hexdigest()


def plain_order(rows):
    """Rows (turn, role, text) in the order of the contract; rows of one turn
    as the operator orders them."""
    def key(r):
        return r[0] is not None, r[0] or 0
    return sorted(rows, key=key)


def cheapest(rows, faults, costs):
    """(cost, audit, lines) by trying every string of edits, shortest paths
    kept whole: for each (row, roles so far by their last) all cheapest audits."""
    layer = {"": {(0, "", ())}}  # last initial -> (cost, audit, lines), all of the least cost

    def keep(into, last, item):
        old = into.get(last)
        if old is None or item[0] < min(old)[0]:
            into[last] = {item}
        elif item[0] == min(old)[0]:
            old.add(item)

    def follow(last, initial):
        return {"": "su", "s": "u", "u": "a", "a": "u"}[last].find(initial) >= 0 if initial else False

    def insertions(layer):
        out = {k: set(v) for k, v in layer.items()}
        for _ in range(3):
            for last, items in list(out.items()):
                for cost, audit, lines in list(items):
                    role = "assistant" if last == "u" else "user"
                    keep(out, role[0], (cost + costs.insert, audit + "I", (*lines, role + ":")))
        return out

    for (_, role, text), fault in zip(rows, faults):
        nxt = {}
        for last, items in insertions(layer).items():
            for cost, audit, lines in items:
                keep(nxt, last, (cost + costs.delete, audit + "D", lines))
                if fault not in ("blank", "duplicate"):
                    more = costs.truncated if fault == "truncated" else 0
                    if follow(last, role[:1]):
                        keep(nxt, role[0], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                    for new in ("user", "assistant"):
                        if follow(last, new[0]):
                            keep(nxt, new[0], (cost + costs.rerole + more, audit + "R", (*lines, f"{new}:{text}")))
        layer = nxt
    ends = [i for last, items in insertions(layer).items() if last in ("", "a") for i in items]
    least = min(e[0] for e in ends)
    return min((e for e in ends if e[0] == least), key=lambda e: e[1])


def plain(rows, costs=C.Costs()):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, sha of rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1], b[1][:1]) not in (("s", "u"), ("u", "a"), ("a", "u")) for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(rows, faults, costs)
    assert GOOD.fullmatch("".join(line[0] for line in lines))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(conv, rows):
    out = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def made(seed, convs, longest):
    rnd, rows = random.Random(seed), []
    for conv in range(convs):
        for turn in sorted(rnd.sample(range(3 * longest), rnd.randint(0, longest))):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            text = rnd.choice(["", " \t", "One. ", "Two!", "three", "Four?", f"text {rnd.randint(0, 9)}.", f"cut {rnd.randint(0, 9)}", "日本."])
            rows.append((conv, turn, role, text))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("width", [None, 9])
def test_equals_enumeration(spark, width):
    rows = made(11, 120, 9)
    got = {r[0]: tuple(r[1:]) for r in C.repair(C.damage(table(spark, rows)), width=width).collect()}
    by = {}
    for conv, *rest in rows:
        by.setdefault(conv, []).append(tuple(rest))
    assert set(got) == set(by)
    for conv, given in by.items():
        assert got[conv] == plain(damaged(conv, given)), (conv, given)


@pytest.mark.parametrize("costs", [C.Costs(), C.Costs(1, 10, 3, 4), C.Costs(9, 4, 1, 1)])
def test_other_costs(spark, costs):
    rows = made(5, 60, 7)
    got = {r[0]: tuple(r[1:]) for r in C.repair(C.as_rows(table(spark, rows)), costs, width=5).collect()}
    for conv, r in got.items():
        assert r == plain([tuple(x[1:]) for x in rows if x[0] == conv], costs)


def test_one_conversation_over_many_partitions_equals_one_chunk(spark):
    """Chunks of a conversation settle to what one pass over it gives, also
    where costs never converge (user rows only, deletions only)."""
    rnd = random.Random(2)
    kinds = {0: lambda k: rnd.choice(["user", "assistant"]), 1: lambda k: "user", 2: lambda k: "user" if k % 2 else "assistant"}
    rows = [(c, k, role(k), f"{k if rnd.random() < 0.8 else rnd.randint(0, 9)}{rnd.choice(['.', '.', '!', '', ' '])}")
            for c, role in kinds.items() for k in range(700)]
    rows += [(3, k, "user", "again.") for k in range(500)] + [(4, k, "user", f"{k}.") for k in range(701)]
    whole = C.repair(C.as_rows(table(spark, rows)), width=1).collect()
    many = C.repair(C.as_rows(table(spark, rows)), width=23).collect()
    assert sorted(whole) == sorted(many) and len(whole) == 5
    assert {len(r["audit"]) for r in whole} == {700, 500, 701}


def test_fix_up_stops_where_vectors_differ_by_a_constant():
    v, rnd = C.Viterbi(C.Costs()), random.Random(4)
    for _ in range(200):
        codes = bytes(rnd.randrange(4) << 2 | rnd.choice([0, 0, 0, 1, 3]) for _ in range(rnd.randint(1, 40)))
        spec, other = v.end, v.begin(bytes(rnd.randrange(16) for _ in range(5)), v.end)
        assert v.begin(codes, other, (spec, v.begin(codes, spec))) == v.begin(codes, other)


def test_nulls_repeated_rows_dropped_conversations(spark):
    dropped = next(k for k in itertools.count() if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (dropped, 0, "user", "gone."),
            (7, None, "user", "a."), (7, None, "user", "a."), (7, 4, "assistant", "b"), (8, 3, "system", "Be good.")]
    got = {r[0]: tuple(r[1:]) for r in C.repair(C.damage(table(spark, rows))).collect()}
    assert set(got) == {None, dropped, 7, 8}
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    for conv in (None, 7, 8):
        assert got[conv] == plain(plain_order(damaged(conv, [tuple(r[1:]) for r in rows if r[0] == conv])))


def test_clashing_columns_text_ids_empty_table(spark):
    rows = table(spark, made(3, 20, 6))
    want = sorted(C.repair(C.damage(rows)).collect())
    for name in ("conv", "key", "code", "n", "chunk", "part", "copies", "kind", "end", "state"):
        rows = rows.withColumn(name, F.lit("clash"))
    assert sorted(C.repair(C.damage(rows)).collect()) == want
    texts = C.repair(C.damage(rows.withColumn("conv_id", F.col("conv_id").cast("string"))))
    assert texts.schema["conv_id"].dataType.simpleString() == "string"
    assert sorted(tuple(r[1:]) for r in texts.collect()) == sorted(tuple(r[1:]) for r in want)
    assert C.repair(C.damage(rows.where("1 = 0"))).count() == 0


def test_long_text(spark):
    long = "word " * 400_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", "ok."), (1, 2, "user", long)]
    (got,) = C.repair(C.as_rows(table(spark, rows))).collect()
    assert tuple(got[1:]) == plain([tuple(r[1:]) for r in rows])
