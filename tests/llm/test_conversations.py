"""Conversation repair against a plain dynamic program over strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from civiclake.llm import conversations
from civiclake.llm.queries import QUERIES

_LEGAL = re.compile(r"(s?(ua)+)?\Z")
_BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    """{conv_id: [(turn, role, text)]} by the rules of the contract."""
    out = {}
    for conv_id, turn, role, text in rows:
        mine = out.setdefault(conv_id, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub(r"[.!?]", "", text) if fate == 2 else text
        mine += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(_BLANK)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    made = lambda s: ("a", "assistant") if s == "u" else ("u", "user")
    best = {"": (0, "", ())}

    def put(to, state, value):
        to[state] = min(to.get(state, value), value)

    for k in range(len(rows) + 1):
        for _ in range(4):
            for s, (c, audit, kept) in list(best.items()):
                put(best, made(s)[0], (c + 2, audit + "I", kept + ((made(s)[1], ""),)))
        if k == len(rows):
            break
        after, (_, role, text) = {}, rows[k]
        for s, (c, audit, kept) in best.items():
            put(after, s, (c + 3, audit + "D", kept))
            if faults[k] not in ("b", "d"):
                more = faults[k] == "t"
                if initials[k] in step[s]:
                    put(after, step[s][initials[k]], (c + more, audit + "K", kept + ((role, text),)))
                put(after, made(s)[0], (c + 2 + more, audit + "R", kept + ((made(s)[1], text),)))
        best = after
    cost, audit, kept = min(best[s] for s in ("", "a") if s in best)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, sha


def table(made):
    return {r.conv_id: tuple(r)[1:] for r in made.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert table(QUERIES["op13_conversation_repair"](spark, folder)) == {k: brute(v) for k, v in damaged(rows).items()}


def odd_rows(seed, convs, most):
    pick = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "cut", "", " \n", None, "ü.", "a\tb. ", "two\nlines"]
    return [(conv, pick.choice([None, *range(n + 1)]), pick.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), pick.choice(texts))
            for conv in convs for n in [pick.randint(1, most)] for _ in range(n)]


@pytest.mark.parametrize("block", [4096, 5])
def test_odd_rows_and_blocks(spark, block):
    rows = odd_rows(block, [None, *range(60)], 25) + odd_rows(1, [77], 300)  # one conversation holds a third of all rows
    rows += [(78, None, "user", "same.")] * 40 + [(79, 1, "system", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, place string").repartition(7)
    plain = {}
    for conv_id, turn, role, text in rows:
        plain.setdefault(conv_id, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert table(conversations.repair(df, block)) == {k: brute(v) for k, v in plain.items()}
    whole = {k: brute(v) for k, v in damaged(rows).items() if v}
    assert table(conversations.repair(conversations.damaged(df), block)) == whole


def test_empty_and_extreme_turns(spark):
    df = spark.createDataFrame([(1, -(1 << 63), "user", "a."), (1, 5, "assistant", "b " * 200_000 + ".")], "conv_id long, turn long, role string, text string")
    assert conversations.repair(df.limit(0)).count() == 0
    made = conversations.repair(df.where("turn = 5")).first()
    assert (made.audit, made.cost, made.gaps) == ("IK", 2, 0)
    assert conversations.repair(df).first().audit == "KK"


def test_audits_are_the_least_of_all_cheapest():
    for n in range(5):
        for roles in itertools.product("sua", repeat=n):
            rows = [(k, {"s": "system", "u": "user", "a": "assistant"}[r], f"t{k}.") for k, r in enumerate(roles)]
            cost, audit, sha = brute(rows)[-3:]
            steps = conversations.steps_of([(r[1], False, False, 1) for r in rows])
            assert min(v for s, v in conversations.solve(steps).items() if s in (0, 3)) == (cost, audit)


def test_colliding_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(conversations, "_BASE", 0)  # a hash is its last letter
    pick = random.Random(3)
    for _ in range(300):
        rows = [(k, pick.choice(["user", "assistant", "system"]), pick.choice(["a.", "b", f"c{k}."])) for k in range(pick.randint(0, 14))]
        expected = brute(rows)
        held, seen = [], set()
        for _, role, text in rows:
            held.append((role, (role, text) in seen, text[-1] != ".", 1))
            seen.add((role, text))
        made = conversations.solve(conversations.steps_of(held))
        assert min(v for s, v in made.items() if s in (0, 3)) == expected[5:7]
