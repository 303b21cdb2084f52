import hashlib
import random
import re
import zlib

import duckdb
import pytest

from lakepipe.llm import conversations
from lakepipe.llm.conversations import DUPLICATE, KEPT, WANTED, code_of, repair

BLANKS = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """Cheapest and then ASCII-least edits, by carrying the best string of every state forwards."""
    best = {0: (0, "")}
    for code in rows:
        initial, fault = "sua."[code >> 2], code & 3
        extra, after = int(fault == 3), {}
        for state, (cost, letters) in best.items():
            for _ in range(3):
                ways = [(cost + 3, letters + "D", state)]
                if fault not in (1, 2):
                    if initial in KEPT[state]:
                        ways.append((cost + extra, letters + "K", KEPT[state][initial]))
                    ways.append((cost + 2 + extra, letters + "R", WANTED[state]))
                for c, w, to in ways:
                    after[to] = min(after.get(to, (c, w)), (c, w))
                state, cost, letters = WANTED[state], cost + 2, letters + "I"
        best = after
    end = {0: (0, ""), 1: (4, "II"), 2: (2, "I"), 3: (0, "")}
    return min((cost + end[q][0], letters + end[q][1]) for q, (cost, letters) in best.items())


def plain_conversation(rows):
    """The whole result for the rows (turn, role, text) of one conversation."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest())
    rows = sorted(rows, key=key)
    codes, seen, counts = [], set(), [0, 0, 0]
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        fault = 1 if not bare else 2 if (role, text) in seen else 0 if bare[-1] in ".!?" else 3
        seen.add((role, text))
        if fault:
            counts[fault - 1] += 1
        codes.append(code_of(role[:1], fault))
    pairs = zip([r[1][:1] for r in rows], [r[1][:1] for r in rows[1:]])
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit = plain_repair(codes)
    out, state, left = [], 0, iter(rows)
    for letter in audit:
        row = None if letter == "I" else next(left)
        if letter == "D":
            continue
        state = KEPT[state][row[1][:1]] if letter == "K" else WANTED[state]
        role = row[1] if letter == "K" else {2: "user", 3: "assistant"}[state]
        out.append(f"{role}:{row[2] if row else ''}")
    assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in out))
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        choice = zlib.crc32(name.encode()) % 20
        kept = out.setdefault(conv, [])
        if choice:
            text = "" if choice == 1 else re.sub("[.!?]", "", text) if choice == 2 else text
            kept += [(turn, "user" if choice == 4 else role, text)] * (2 if choice == 3 else 1)
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def turns():
    draw = random.Random(4)
    rows = []
    for conv in range(60):
        for turn in range(draw.randint(1, 9)):
            role = draw.choice(["user", "assistant"] * 4 + ["system", "tool", "User", ""])
            text = draw.choice(["Yes.", "Well, no", "é?", " ", "Tell me!  \n", f"no {draw.random()}."])
            rows.append((conv, turn if draw.random() < 0.9 else draw.choice([None, 0, turn + 3]), role, text))
    rows += [(None, 1, "user", "Hello."), (None, None, None, None), (None, 2, "assistant", None), (100, None, "user", "a.")]
    rows += [(101, t, "user" if t % 2 == 0 else "assistant", f"This is {t % 50}.") for t in range(400)]
    rows += [(102, 0, "user", "x " * 200_000), (102, 1, "assistant", "Yes.")]
    return rows


def test_the_cheapest_repair():
    draw = random.Random(1)
    for _ in range(600):
        rows = bytes(code_of(draw.choice("suuaa."), draw.choice([0, 0, 0, 1, 2, 3])) for _ in range(draw.randint(0, 12)))
        for stretch in (1, 3, 64):
            assert repair(rows, stretch) == plain_repair(rows)


def test_a_long_conversation_takes_steps_in_proportion():
    draw = random.Random(2)
    rows = bytes(code_of(draw.choice("suuaa."), draw.choice([0, 0, 0, 1, 2, 3])) for _ in range(3000))
    assert repair(rows) == plain_repair(rows)


@pytest.mark.parametrize("stretch", [conversations.STRETCH, 2])
def test_repairs(spark, turns, stretch):
    given = {}
    for conv, turn, role, text in turns:
        given.setdefault(conv, []).append((turn, *(" " if v is None else v for v in (role, text))))
    names = ["key", "part", "same", "first", "audit", "a.b"]
    schema = "conv_id bigint, turn bigint, role string, text string, " + ", ".join(f"`{c}` string" for c in names)
    df = spark.createDataFrame([(*r, *["x"] * len(names)) for r in turns], schema).repartition(5)
    got = conversations.repair_conversations(df, stretch=stretch)
    assert got.columns == ["conv", *conversations.COUNTS, "audit", "repaired_sha256"]
    assert ordered(got.collect()) == ordered((c, *plain_conversation(rows)) for c, rows in given.items())


def test_damage_and_repair(spark, turns, tmp_path):
    more = [(200, 0, "user", "a.")] + [(c, 0, "user", f"Hello {c}.") for c in range(300, 400)]
    schema = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame(turns + more, schema).write.parquet(str(tmp_path / "conversations.parquet"))
    got = conversations.op12_conversation_repair(spark, str(tmp_path)).collect()
    want = [(c, *plain_conversation(rows)) for c, rows in plain_damage(turns + more).items()]
    assert ordered(got) == ordered(want)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet' WHERE conv_id IS DISTINCT FROM 101")
    fewer = [r for r in want if r[0] != 101]
    assert ordered(db.sql(conversations.ORACLE["op12_conversation_repair"]).fetchall()) == ordered(fewer)
    assert any(r.audit == "" and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in got)


def test_a_duplicate_comes_after_its_first_copy(spark):
    rows = [(1, None, "user", "Hi."), (1, 5, "user", "Hi."), (1, 6, "assistant", "Hi."), (1, 6, "assistant", "Hi.")]
    got = conversations.repair_conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    assert [r.duplicate for r in got.collect()] == [2]
    assert DUPLICATE == 2


def test_nothing(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert conversations.repair_conversations(df).count() == 0
