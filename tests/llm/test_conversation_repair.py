"""Repairs against a plain programme over suffixes, and against all edit sequences of short conversations."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from hourweave.llm import conversation_repair as cr
from hourweave.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
WANTED = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit) by costs of what is left, then the least letter first."""
    memo = {}

    def left(i, state, inserts):
        if (i, state, inserts) not in memo:
            best = (0, "") if i == len(rows) and state in ("", "a") else (10**9, "")
            options = [best] if best[0] == 0 else []
            if inserts < 2:
                cost, audit = left(i, WANTED[state][0], inserts + 1)
                options.append((cost + 3, "I" + audit))
            if i < len(rows):
                fault, role = rows[i]
                cost, audit = left(i + 1, state, 0)
                options.append((cost + 4, "D" + audit))
                if fault not in ("blank", "duplicate"):
                    extra = 3 if fault == "truncated" else 0
                    if (state, role[:1]) in NEXT:
                        cost, audit = left(i + 1, NEXT[state, role[:1]], 0)
                        options.append((cost + extra, "K" + audit))
                    cost, audit = left(i + 1, WANTED[state][0], 0)
                    options.append((cost + extra + 3, "R" + audit))
            memo[i, state, inserts] = min(options) if options else best
        return memo[i, state, inserts]

    return left(0, "", 0)


def expected(rows):
    found = {}
    convs = defaultdict(list)
    for conv in {r[0] for r in rows}:
        convs[conv] = []
    for row in damage(rows):
        convs[row[0]].append(row[1:])
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for turn, role, text in own:
            letters = WORD.findall(text)
            fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        turns = {r[0] for r in own} - {None}
        cost, audit = cheapest([(f, r[1]) for f, r in zip(faults, own)])
        lines, state, at = [], "", 0
        for letter in audit:
            role = own[at][1] if letter == "K" else WANTED[state]
            if letter != "D":
                lines.append(f"{role}:{'' if letter == 'I' else own[at][2]}")
                state = NEXT[state, role[0]]
            at += letter != "I"
        assert GOOD.fullmatch("".join(line[0] for line in lines))
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


def got(df):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    out = {r.conv_id: tuple(r[c] for c in columns) for r in rows}
    assert len(out) == len(rows)
    return out


def odd_rows(seed, n_convs, most):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "cut", "", "  \n", None, "Why?  ", "end. x", "déjà vu.", "ends. ", "."]
    rows = []
    for conv in [None, *range(n_convs)]:
        for t in range(r.randint(1, most)):
            turn = None if r.random() < 0.1 else t if r.random() < 0.9 else r.randint(0, most)
            rows.append((conv, turn, r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"]), r.choice(texts) if r.random() < 0.6 else f"text {r.random()}."))
    return rows + rows[:5]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("piece_rows", [cr.PIECE, 1, 3])
def test_equals_plain_programme(spark, piece_rows):
    rows = odd_rows(1, 120, 14)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(cr.repair_conversations(cr.damaged(df), piece_rows)) == expected(rows)


def test_one_long_conversation(spark):
    rows = odd_rows(2, 3, 400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(16)
    assert got(cr.repair_conversations(cr.damaged(df), 50)) == expected(rows)


def test_plain_programme_equals_all_edits():
    """The cheapest of all edit sequences with up to two inserts at each place."""
    costs = {"K": 0, "R": 3, "D": 4, "I": 3}
    for rows in itertools.chain(itertools.product([("", "user"), ("", "assistant"), ("", "system"), ("truncated", "user"), ("blank", "user"), ("", "tool")], repeat=3)):
        best = None
        for letters in itertools.product("KRD", repeat=3):
            for inserts in itertools.product(range(3), repeat=4):
                audit = "".join("I" * k + letter for k, letter in zip(inserts, letters)) + "I" * inserts[3]
                state, at, cost = "", 0, 0
                for letter in audit:
                    cost += costs[letter]
                    if letter != "D":
                        role = rows[at][1] if letter == "K" else WANTED[state]
                        state = NEXT.get((state, role[0]))
                        if state is None or letter != "I" and rows[at][0] == "blank":
                            state = None
                            break
                        cost += 3 * (letter != "I" and rows[at][0] == "truncated")
                    at += letter != "I"
                if state in ("", "a") and (best is None or (cost, audit) < best):
                    best = (cost, audit)
        assert cheapest(list(rows)) == best
        kinds = "".join("-" if f == "blank" else (r[0] if r[0] in "sua" else "x").upper() if f else r[0] if r[0] in "sua" else "x" for f, r in rows)
        states = {s: (c, cr.Trail(cr.Trail(), a)) for s, c, a in cr.piece_audits(kinds, 0)}
        cost, trail = cr.finished(states)
        assert (cost, "".join(trail.pieces())) == best


def test_order_of_trails():
    r = random.Random(5)
    for _ in range(300):
        a, b = cr.Trail(), cr.Trail()
        for _ in range(r.randint(0, 12)):
            piece = "".join(r.choice("KD") for _ in range(r.randint(1, 3)))
            a = cr.Trail(a, piece)
            b = a if r.random() < 0.3 else cr.Trail(b, piece if r.random() < 0.8 else "K")
        assert cr.less(a, b) == ("".join(a.pieces()) < "".join(b.pieces()))


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(cr, "_append", lambda value, piece: 0)
    a, b = cr.Trail(cr.Trail(cr.Trail(), "KK"), "D"), cr.Trail(cr.Trail(cr.Trail(), "KD"), "K")
    assert cr.less(b, a) and not cr.less(a, b)


def test_empty_table_and_further_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 3)], f"{SCHEMA}, audit string, copies long")
    assert got(cr.repair_conversations(cr.damaged(df.limit(0)))) == {}
    assert got(cr.repair_conversations(cr.damaged(df))) == expected([(1, 0, "user", "Hi.")])


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_conversation_repair"](spark, sf_dir)) == expected(rows)
