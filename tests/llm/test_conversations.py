"""Conversation repair against a plain search over all edits, on whole tables and on random rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

import compare
from shopmonth.llm import conversations, lattice, queries

SOLID = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(roles, faults):
    """Least (cost, letters) of all edits, from the last row back."""
    none = (1 << 40, "")
    behind = None
    for row in range(len(roles), -1, -1):
        best = [none] * 4
        for _ in range(4):
            for state in range(4):
                turn = 3 if state == 2 else 2
                ways = [(best[turn][0] + 5, "I" + best[turn][1])]
                if row == len(roles) and state in (0, 3):
                    ways.append((0, ""))
                if row < len(roles):
                    ways.append((behind[state][0] + 2, "D" + behind[state][1]))
                    if faults[row] not in ("blank", "duplicate"):
                        stays = 5 if faults[row] == "truncated" else 0
                        ways.append((behind[turn][0] + 1 + stays, "R" + behind[turn][1]))
                        own = "?sua".find(roles[row][:1] or "!")
                        if (state, own) in {(0, 1), (0, 2), (1, 2), (2, 3), (3, 2)}:
                            ways.append((behind[own][0] + stays, "K" + behind[own][1]))
                best[state] = min(ways)
        behind = best
    return behind[0]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute(rows, broken=True):
    after = defaultdict(list)
    for row in damage(rows) if broken else rows:
        after[row[0]].append(row[1:])
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(after[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in mine:
            solid = SOLID.findall(text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = {r[0] for r in mine} - {None}
        roles = [r[1] for r in mine]
        cost, letters = cheapest(roles, faults)
        kept, row, last = [], 0, None
        for letter in letters:
            if letter == "K":
                kept.append((roles[row], mine[row][2]))
            elif letter in "RI":
                kept.append(("assistant" if last == "u" else "user", "" if letter == "I" else mine[row][2]))
            last = kept[-1][0][0] if kept else None
            row += letter != "I"
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                    faults.count("truncated"), illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force_on_whole_tables(spark):
    sf = f"{compare.TESTDATA}/sf0.01"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in queries.table(spark, sf, "conversations").collect()]
    assert found(queries.op11_conversation_repair(spark, sf)) == brute(rows)


SCHEMA = "conv_id long, turn long, role string, text string, key string, copies int"


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in (None, *range(25)):
        for _ in range(rng.choice([1, 2, 3, 9, 30])):
            rows.append((conv, rng.choice([None, *range(40)]), rng.choice(["system", "user", "assistant", "sage", "", None, "User", "tool"]),
                         rng.choice(["Yes.", "yes", "", " \t", None, "é!", "a. ", "Well? \n", "no. no"])))
    rows += [(50, t, "user" if t % 2 else "assistant", f"Text {t % 40}.") for t in range(300)]
    rows += [(51, None, "user", "x" * 300_000 + "."), (51, 3, "assistant", "Fine.")] + [(52, 5, "user", "Same.")] * 7
    return rows


@pytest.mark.parametrize("long_rows, block", [(20_000, 4096), (5, 4), (0, 3)])
def test_edges_short_and_long(spark, long_rows, block):
    rows = random_rows(long_rows)
    table = spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA).repartition(3)
    df = conversations.judged(conversations.damaged(conversations.prepared(table)), long_rows, block)
    assert found(df) == brute(rows)


def test_repaired_rows_and_empty_table(spark):
    rows = random_rows(7)
    table = spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA)
    for long_rows in (20_000, 6):
        turns = conversations.repaired(conversations.prepared(table), long_rows, 5)
        texts = defaultdict(list)
        for r in sorted(turns.collect(), key=lambda r: r.position):
            texts[r.conv].append(f"{r.role}:{r.text}")
        plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
        wanted = {r[0]: r[-1] for r in brute(plain, broken=False)}
        assert {c: hashlib.sha256("\n".join(texts[c]).encode()).hexdigest() for c in wanted} == wanted
        for lines in texts.values():
            assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
    assert found(conversations.judged(conversations.prepared(table.limit(0)))) == []


@pytest.mark.parametrize("piece", [1, 3, 32])
def test_auction_on_random_lattices(piece):
    rng = random.Random(piece)
    names = {0: "tool", 1: "system", 2: "user", 3: "assistant"}
    marks = {0: None, 4: "blank", 8: "truncated"}
    for _ in range(1500):
        codes = bytes(rng.choice([0, 1, 2, 2, 3, 3]) + rng.choice([0, 0, 0, 4, 8]) for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 20])))
        prices = lattice.settle(codes, piece=piece)
        letters = lattice.trace(codes, prices)[0]
        assert (prices[0][0], letters) == cheapest([names[c & 3] for c in codes], [marks[c & 12] for c in codes])


def test_work_is_in_proportion_to_the_rows():
    rng = random.Random(2)
    codes = bytes(rng.choice([2, 3, 3]) + rng.choice([0, 0, 8]) for _ in range(100_000))
    assert len(lattice.trace(codes, lattice.settle(codes))[0]) >= 100_000
