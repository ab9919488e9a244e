"""Conversation repair against an exhaustive search, with conversations over many blocks and partitions."""

import functools
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from readloom.llm import turns

SCHEMA = "role string, conv_id long, text string, turn long, `a.b` int, codes string"


def edits(rows):
    """(cost, audit, repaired) of rows (role, text, fault): all edits, cheapest first, then ASCII-least."""

    @functools.cache
    def best(i, state, added):
        out = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        after = lambda s, c, l, line, j, more=0: [(c + x, l + y, (line,) * (line is not None) + z) for x, y, z in best(j, s, more)]  # noqa: E731, E741
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        name = {"u": "user", "a": "assistant"}
        if added < 3:
            for r in legal.replace("s", ""):
                out += after(r, 3, "I", f"{name[r]}:", i, added + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            out += after(state, 4, "D", None, i + 1)
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if role[:1] and role[0] in legal:
                    out += after(role[0], extra, "K", f"{role}:{text}", i + 1)
                for r in legal.replace("s", ""):
                    out += after(r, 3 + extra, "R", f"{name[r]}:{text}", i + 1)
        return [min(out, key=lambda x: x[:2])] if out else []

    return best(0, "", 0)[0]


def expected(table):
    convs, ids = defaultdict(list), set()
    for role, conv, text, turn, *_ in table:
        ids.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        convs[conv] += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv in ids:
        rows = sorted(convs[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rows:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
            if fault:
                counts[fault] += 1
        numbers = [t for t, *_ in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, kept = edits(tuple(marked))
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def made(n, seed, length):
    r = random.Random(seed)
    table = []
    for conv in [None, *range(n)]:
        for turn in range(r.randint(1, length)):
            role = r.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "Users", "ua"])
            text = r.choice(["Yes.", "No!", "so", "", " \n", None, "é?", "漢", "x.\t", f"t{r.random()}."])
            table.append((role, conv, text, None if r.random() < 0.05 else turn + r.choice([0, 0, 0, 1, 40]), 1, "clash"))
    return table


@pytest.mark.parametrize("block_rows", [1, 3, turns.BLOCK_ROWS])
def test_against_exhaustive_search(spark, block_rows):
    table = made(60, 4, 14) + [("user", 99, "Twice.", 3, 1, "")] * 5 + [("user", 7 << 40, "a" * 100_000 + ".", 2, 1, "")]
    got = turns.damaged_and_repaired(spark.createDataFrame(table, SCHEMA).repartition(5), block_rows)
    want = expected(table)
    found = {r.conv_id: tuple(r)[1:] for r in got.collect()}
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found == want
    assert any(len(a[6]) > 6 for a in want.values())


def test_dropped_whole_and_empty(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([("user", lost, "Hi.", 0, 1, "")], SCHEMA)
    assert [tuple(r) for r in turns.damaged_and_repaired(df).collect()] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert turns.damaged_and_repaired(df.where("turn < 0")).count() == 0


def test_one_conversation_over_all_partitions(spark):
    """A conversation of 20,000 rows lies in every partition; its blocks stay near the square root of its rows, and its repaired rows are real."""
    r = random.Random(3)
    table = [(r.choice(["user", "assistant"]), 5, r.choice(["Yes.", f"{i}.", f"{i}", ""]), i, 1, "") for i in range(20_000)]
    df = spark.createDataFrame(table, SCHEMA).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = turns.repair(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert pieces.agg({"part": "max"}).first()[0] >= 3 and 20 < pieces.count() < 200
    row = turns.summary(pieces, df).first()
    codes = "".join(p.codes for p in sorted(pieces.collect(), key=lambda p: (p.part, p.seq)))
    audit, end = turns.walk(codes, 0, turns.END, True)
    assert row.audit == audit and end in (0, 3) and row.cost == turns.vector(codes, turns.END)[0] and len(codes) == 40_000
    lines = [f"{a}:{t}" for p in sorted(pieces.collect(), key=lambda p: (p.part, p.seq)) for a, t in zip(p.roles, p.texts)]
    assert row.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert [x[0] for x in lines] == ["u", "a"] * (len(lines) // 2)


def test_walk_is_ascii_least():
    r = random.Random(8)
    for _ in range(400):
        rows = tuple((r.choice(["system", "user", "assistant", "tool"]), f"{i}", r.choice(["", "", "truncated", "blank"])) for i in range(r.randint(0, 9)))
        codes = "".join((a[0] if a[0] in "sua" else "-") + {"": "0", "truncated": "1", "blank": "2"}[f] for a, _, f in rows)
        cost, audit, _ = edits(rows)
        assert (turns.vector(codes, turns.END)[0], turns.walk(codes, 0, turns.END, True)[0]) == (cost, audit)
