"""Conversation repair: the automaton against a search of all edits, and whole tables against brute force."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tarmac.llm import conversation_repair as repair

DUE = {"0": "u", "s": "u", "u": "a", "a": "u"}
KEPT = {("0", "s"), ("0", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def cheapest(rows):
    """(cost, audit, lines) of the best edits of (role, text, fault) rows, by states reached row by row."""
    ways = {"0": (0, "", ())}
    for role, text, fault in rows:
        wide = {}
        for state, (cost, audit, lines) in ways.items():
            for n in range(3):
                wide[state] = min(wide.get(state, (1 << 60,)), (cost, audit, lines))
                state = DUE[state]
                cost, audit, lines = cost + 5, audit + "I", lines + ({"u": "user", "a": "assistant"}[state] + ":",)
        ways = {}
        for state, (cost, audit, lines) in wide.items():
            options = [(state, cost + 2, "D", lines)]
            if fault not in ("blank", "duplicate"):
                late = 5 * (fault == "truncated")
                due = DUE[state]
                options.append((due, cost + 1 + late, "R", lines + ({"u": "user", "a": "assistant"}[due] + ":" + text,)))
                if (state, role[:1]) in KEPT:
                    options.append((role[0], cost + late, "K", lines + (f"{role}:{text}",)))
            for to, price, letter, kept in options:
                ways[to] = min(ways.get(to, (1 << 60,)), (price, audit + letter, kept))
    ends = []
    for state, (cost, audit, lines) in ways.items():
        while state in "us":
            state = DUE[state]
            cost, audit, lines = cost + 5, audit + "I", lines + ({"u": "user", "a": "assistant"}[state] + ":",)
        ends.append((cost, audit, lines))
    return min(ends)


def damaged(conv, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    if kind == 0:
        return []
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    if kind == 4:
        role = "user"
    return [(turn, role, text)] * (2 if kind == 3 else 1)


def key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(table):
    out = []
    for conv in {row[0] for row in table}:
        rows = [x for row in table if row[0] == conv for x in damaged(*row)]
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, key(x[1], x[2])))
        seen, marked = set(), []
        for turn, role, text in rows:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = None
            if not last:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif last[0] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = cheapest(marked)
        faults = [sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, count, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", None, "End. ", "ok. ", "Ünï?\r\n", "…", "long. " * 30_000]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "Agent"]
    table = []
    for conv in range(count):
        for turn in range(rng.randint(1, longest)):
            table.append((conv, turn if rng.random() > 0.1 else rng.choice([None, 0, 7, -3]), rng.choice(roles), rng.choice(texts)))
    table += [(None, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(9)]
    table += [table[3], table[3], table[3]]
    rng.shuffle(table)
    return table


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(spark, table, folder):
    made = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    made.withColumns({"conv": F.lit(1), "key": F.lit("k"), "audit": F.lit(2), "uid": F.lit(0)}).repartition(5).write.parquet(f"{folder}/conversations.parquet")
    return sorted((tuple(r) for r in repair.query(spark, folder).select(COLUMNS).collect()), key=str)


@pytest.mark.parametrize("chunk", [3, 16])
def test_whole_tables_against_brute_force(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    table = conversations(chunk, 40, 12) + [(1000, i, ["user", "assistant"][i % 2], f"Turn {i}.") for i in range(300)]
    assert got(spark, table, str(tmp_path)) == brute(table)


def test_conversation_with_nothing_left(spark, tmp_path):
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = [(conv, 0, "user", "Gone.")]
    assert got(spark, table, str(tmp_path)) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv long, turn long, role string, text string")
    plans, turns = repair.repair(empty)
    assert plans.isEmpty() and turns.isEmpty()


def test_repaired_turns_alternate(spark):
    rows = [("x", 1, "user", "Hi."), ("x", 2, "user", "Hi."), ("x", 3, "user", "Again."), ("y", 1, "system", "Be kind."), ("z", None, "tool", "7.")]
    plans, turns = repair.repair(spark.createDataFrame(rows, "conv string, turn long, role string, text string"))
    assert {(r.conv, r.audit, r.cost) for r in plans.collect()} == {("x", "KDR", 3), ("y", "D", 2), ("z", "D", 2)}
    assert sorted(tuple(r) for r in turns.collect()) == [("x", 1, "K", "user", "Hi."), ("x", 2, "R", "assistant", "Again.")]
