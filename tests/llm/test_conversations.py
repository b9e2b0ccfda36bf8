"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib

import pytest

from cardlens.llm import conversations

TURNS = "conv_id long, turn long, role string, text string, fault int, place string"
FOLLOW = {"": "su", "s": "u", "u": "a", "a": "u"}
SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """The contract row by row; the least (cost, audit) in each state."""
    every = {r[0] for r in rows}
    hurt = []
    for conv, turn, role, text, *_ in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        hurt += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = []
    for conv in every:
        own = sorted((r[1:] for r in hurt if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, best, n = set(), {"": (0, "", ())}, dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            fault = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if text.strip(SPACE)[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            grown = opened(best)
            new = {}
            for q, (cost, audit, lines) in grown.items():
                ways = [("D", 2, q, ())]
                if fault in (None, "truncated"):
                    extra = 5 if fault else 0
                    if role[:1] and role[:1] in FOLLOW[q]:
                        ways.append(("K", extra, role[:1], (f"{role}:{text}",)))
                    to = FOLLOW[q][-1]
                    ways.append(("R", 1 + extra, to, ({"u": "user", "a": "assistant"}[to] + ":" + text,)))
                for letter, price, to, line in ways:
                    way = (cost + price, audit + letter, lines + line)
                    if to not in new or way[:2] < new[to][:2]:
                        new[to] = way
            best = new
        cost, audit, lines = min((w for q, w in opened(best).items() if q in ("", "a")), key=lambda w: w[:2])
        turns = {r[0] for r in own if r[0] is not None}
        initials = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *n.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def opened(best):
    """States after any insertions."""
    grown = dict(best)
    for _ in range(2):
        for q, (cost, audit, lines) in list(grown.items()):
            to = FOLLOW[q][-1]
            way = (cost + 5, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[to]))
            if to not in grown or way[:2] < grown[to][:2]:
                grown[to] = way
    return grown


def check(spark, rows, parts=4):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS).repartition(parts)
    assert sorted(map(tuple, conversations.repair(frame).collect()), key=str) == plain(rows)


def some_rows(rng, conv, n):
    texts = ["Yes.", "No!", "cut short", "", " \n", "What?", "cut  ", "\u00e9t\u00e9.\n\t", "a. b", "x" * 50 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "User", None]
    return [(conv, rng.choice([i, i, i, i // 2, None if i % 7 == 0 else i]), rng.choice(roles), rng.choice([*texts, f"turn {i}.", f"turn {i}.", None])) for i in range(n)]


def test_repair_is_the_plain_one(spark):
    rng = random.Random(8)
    rows = [r for conv in range(60) for r in some_rows(rng, conv, rng.randrange(1, 14))] + some_rows(rng, None, 9)
    check(spark, rows + rows[:40])


def test_a_conversation_over_many_parts(spark):
    rng = random.Random(9)
    rows = some_rows(rng, 7, 700) + [(7, i, "user", "the same again.") for i in range(300)] + [r for conv in range(20) for r in some_rows(rng, conv + 20, 4)]
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        hot = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
        parts = conversations.sorted_parts(conversations.faulty(conversations.damaged(hot)))
        assert len(conversations.handed_over(parts)) >= 4  # parts that one conversation spans
        check(spark, rows)
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)


def test_pieces_of_long_repaired_texts(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i} of many.") for i in range(40)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    assert [tuple(r) for r in conversations.repair(frame, piece=10).collect()] == plain(rows)


@pytest.mark.parametrize("seed", range(3))
def test_auction_prices_are_dual_feasible_and_paths_tight(seed):
    rng = random.Random(seed)
    codes, exits = tuple(rng.randrange(8) for _ in range(12)), (3, conversations.NEVER, 0, 7)
    solved = conversations.solve_block(codes, exits)
    for q, (price, letters, to) in enumerate(solved):
        paid, state = 0, q
        for code, row in zip(codes, letters):
            for letter in row:
                cost, state = (5, conversations.next_of(state)) if letter == "I" else next((c, t) for a, c, t in conversations.ARCS[code][state] if a == letter)
                paid += cost
        assert state == to and paid + exits[to] == price


def test_no_rows(spark):
    assert conversations.repair(spark.createDataFrame([], TURNS)).count() == 0
