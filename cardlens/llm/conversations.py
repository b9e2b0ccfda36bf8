"""Repair of conversations: the cheapest edits to well-formed turns, by auctions for shortest paths over a lattice."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import SALTS, bound_batches, durable

#: States: nothing kept yet, after a system turn, after a user's, after an assistant's.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: What each state may go on with, by role initials.
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
NEW_ROLE = ("user", "user", "assistant", "user")  # of a turn inserted or given another role in a state
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
#: What a conversation's end costs in each state: the insertions that close it.
END = (0, 2 * INSERT, INSERT, 0)
CLOSING = ("", "II", "I", "")
INITIALS = "sua"
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
BLOCK = 16  # rows of one lattice
SPACES = " \t\n\x0b\x0c\r"
NEVER = 1 << 40
PIECE = 1 << 20  # characters of repaired text that are passed on at a time


def next_of(state: int) -> int:
    return FOLLOWS[state][NEW_ROLE[state][0]]


def arcs_of(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row that need no insertion, in ASCII order. The code says the role's
    initial, and if the text is cut short."""
    initial, extra = "suax"[code // 2], CUT_SHORT * (code % 2)
    keep = [("K", extra, FOLLOWS[state][initial])] if initial in FOLLOWS[state] else []
    return [("D", DELETE, state), *keep, ("R", REROLE + extra, next_of(state))]


ARCS = [[arcs_of(code, q) for q in STATES] for code in range(8)]


def auction(arcs: list[list[tuple[str, int, int]]], prices: list[int], origin: int, first_exit: int) -> tuple[int, list[tuple[str, int]]]:
    """The cheapest path from the origin to an exit: (price of the origin, its arcs as (letter, node)).

    Prices are lower bounds of what is left to pay and stay dual feasible: none exceeds an arc's cost plus the price behind
    it. The path's last node goes on by its cheapest arc, ties to the least letter, if its price pays for that; otherwise its
    price rises to that and the path draws back by one node. All arcs of the final path are tight, and a smaller letter's arc
    that wasn't tight when the path went by can't be tight later, as prices only rise: it is the least of the shortest paths.
    """
    path: list[tuple[str, int]] = [("", origin)]
    while True:
        node = path[-1][1]
        if node >= first_exit:
            return prices[origin], path[1:]
        least, choice = NEVER, None
        for letter, cost, to in arcs[node]:
            if cost + prices[to] < least:
                least, choice = cost + prices[to], (letter, to)
        if prices[node] < least:
            prices[node] = least
            if len(path) > 1:
                path.pop()
        elif choice is None:  # no exit can be reached from here
            if len(path) == 1:
                return NEVER, []
            path.pop()
        else:
            path.append(choice)


@lru_cache(200_000)
def solve_block(codes: tuple[int, ...], exits: tuple[int, ...]) -> tuple[tuple[int, tuple[str, ...], int], ...]:
    """For each state before the rows: (price, letters of each row, state behind them), given the price of each state behind.

    A node is a row, the insertions made before it (two at most, as a third would undo the first) and a state.
    """
    n, size = len(codes), 12
    arcs: list[list[tuple[str, int, int]]] = []
    for i, code in enumerate(codes):
        for layer in range(3):
            for q in STATES:
                out = [(letter, cost, (i + 1) * size + to) for letter, cost, to in ARCS[code][q]]
                if layer < 2:
                    out.insert(1, ("I", INSERT, i * size + (layer + 1) * 4 + next_of(q)))
                arcs.append(out)
    prices = [min(exits)] * (n * size) + list(exits)
    solved = []
    for q in STATES:
        price, path = auction(arcs, prices, q, n * size)
        rows: list[list[str]] = [[] for _ in codes]
        for (letter, _), (_, at) in zip(path, [("", q), *path]):
            rows[at // size].append(letter)
        solved.append((price, tuple("".join(r) for r in rows), path[-1][1] - n * size if path else -1))
    return tuple(solved)


def solve(codes: list[int], exits: tuple[int, ...]) -> tuple[list[tuple], list[int]]:
    """(blocks' solutions, prices of the states before the rows) from the prices of the states behind, last block first."""
    solved = []
    for start in reversed(range(0, len(codes), BLOCK)):
        floor = min(exits)
        block = solve_block(tuple(codes[start : start + BLOCK]), tuple(min(e - floor, NEVER) for e in exits))
        solved.append(block)
        exits = tuple(min(s[0] + floor, NEVER) for s in block)
    return solved[::-1], list(exits)


def letters_of(codes: list[int], exits: tuple[int, ...], state: int) -> tuple[list[str], int]:
    """Each row's letters on the least shortest path from the state, and the state behind."""
    out: list[str] = []
    for block in solve(codes, exits)[0]:
        _, letters, to = block[state]
        out += letters
        state = to
    return out, state


@dataclass
class Run:
    """Rows of one conversation in one part of the sorted rows."""

    part: int
    key: str
    rows: list[dict]
    first: bool = False
    last: bool = False
    codes: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.codes = [2 * (INITIALS + "x").index(r["initial"] if r["initial"] and r["initial"] in INITIALS else "x") + r["fault"] for r in self.rows if r["fault"] <= TRUNCATED]


def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[Run]:
    """The runs of a task's parts, which come in order; one is held at a time."""
    rows = (r for b in batches for r in b.to_pylist())
    before = None
    for (part, key), held in groupby(rows, lambda r: (r["part"], r["key"])):
        run = Run(part, key, list(held), first=before is None or before.part != part)
        if before:
            before.last = before.part != part
            yield before
        before = run
    if before:
        before.last = True
        yield before


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (key, conv_id, turn, role, text, n) after the damage that follows from crc32 of `conv_id:turn`; equal rows are
    counted. A null in a row, also in the number's text, is one space; a null turn stays null and comes first."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = (F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20).cast("int")
    rows = conversations.select(
        F.concat(F.when(F.col("conv_id").isNull(), "n").otherwise("v"), or_space("conv_id")).alias("key"), "conv_id", F.col("turn").cast("long").alias("turn"), or_space("role").alias("role"), or_space("text").alias("text"), fate.alias("fate")
    ).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    hurt = rows.select("key", "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("fate") == 3, 2).otherwise(1).alias("copies"))
    return hurt.groupBy("key", "conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))


def faulty(rows: DataFrame) -> DataFrame:
    """rows with the fault of the first of each row's n copies; the others are blank or duplicates.

    The first turn of a role and text is looked up only for those that come at several turns, dealt over salts.
    """
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    marked = rows.withColumns({"said": said, "at": at, "salt": F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int")})
    again = marked.groupBy("key", "said").agg(F.count(F.lit(1)).alias("turns"), F.min("at").alias("since")).where("turns > 1")
    salted = again.select("key", "said", "since", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    body = F.rtrim("text", F.lit(SPACES))
    fault = F.when(body == "", BLANK).when(F.col("at") > F.col("since"), DUPLICATE).when(F.right(body, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    return marked.join(salted, ["key", "said", "salt"], "left").select(*rows.columns, fault.alias("fault"))


def sorted_parts(rows: DataFrame) -> DataFrame:
    """rows by conversation, turn, role and text over parts of ranges, written with their place; a very long conversation goes
    over many parts. The ranges are cut by beginnings of role and text, so that samples of them stay small."""
    order = ["key", F.asc_nulls_first("turn")]
    ranged = rows.repartitionByRange(*order, F.substring("role", 1, 64), F.substring("text", 1, 256)).sortWithinPartitions(*order, "role", "text")
    return durable(ranged.withColumn("initial", F.substring("role", 1, 1)).withColumn("place", F.monotonically_increasing_id()), "turns")


def by_part(rows: DataFrame, *columns: str) -> DataFrame:
    placed = rows.select(F.shiftright("place", 33).cast("int").alias("part"), "place", "key", "initial", "fault", "n", *columns)
    return placed.repartition("part").sortWithinPartitions("part", "place")


def border_solutions(rows: DataFrame, exits: dict | None = None) -> list:
    """Of each part's first and last run: without exits, the prices of the states before it for each single exit; with the
    exits of spanning runs, the state that each state before leads to. At most two rows a part come to the driver."""

    def border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            if not (run.first or run.last) or (exits is not None and (run.part, run.key) not in exits):
                continue
            if exits is None:
                forced = DELETE * (sum(r["n"] for r in run.rows) - len(run.codes))
                table = [min(p + forced, NEVER) for e in STATES for p in solve(run.codes, tuple(0 if q == e else NEVER for q in STATES))[1]]
            else:
                table = [letters_of(run.codes, exits[run.part, run.key], q)[1] for q in STATES]
            yield pa.RecordBatch.from_pylist([{"part": run.part, "key": run.key, "first": run.first, "last": run.last, "table": table}], schema)

    schema = pa.schema([("part", pa.int32()), ("key", pa.string()), ("first", pa.bool_()), ("last", pa.bool_()), ("table", pa.list_(pa.int64()))])
    found = by_part(rows).mapInArrow(border, "part int, key string, first boolean, last boolean, table array<long>").collect()
    return sorted(found, key=lambda r: (r["part"], r["last"]))


def spans(borders: list) -> list[list]:
    """Runs of conversations that go on from part to part."""
    out: list[list] = []
    for r in borders:
        if out and out[-1][-1]["last"] and r["first"] and out[-1][-1]["key"] == r["key"]:
            out[-1].append(r)
        else:
            out.append([r])
    return [chain for chain in out if len(chain) > 1]


def handed_over(rows: DataFrame) -> dict[tuple[int, str], tuple[int, tuple[int, ...]]]:
    """(part, key) of runs of spanning conversations to (state before it, prices of the states behind it)."""
    exits: dict[tuple[int, str], tuple[int, ...]] = {}
    chains = spans(border_solutions(rows))
    for chain in chains:
        behind = END
        for r in reversed(chain):
            exits[r["part"], r["key"]] = behind
            behind = tuple(min(r["table"][4 * e + q] + behind[e] for e in STATES) for q in STATES)
    if not exits:
        return {}
    leads = {(r["part"], r["key"]): r["table"] for r in border_solutions(rows, exits)}
    out = {}
    for chain in chains:
        state = NONE
        for r in chain:
            at = (r["part"], r["key"])
            out[at] = (state, exits[at])
            state = leads[at][state]
    return out


PIECES = pa.schema(
    [("key", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("audit", pa.string()), ("repaired", pa.string())]
    + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost", "turns", "least", "most")]
    + [("head", pa.string()), ("tail", pa.string())]
)
PIECES_SQL = "key string, part int, seq long, audit string, repaired string, blank long, duplicate long, truncated long, illegal long, cost long, turns long, least long, most long, head string, tail string"


def pieces_of(run: Run, state: int, exits: tuple[int, ...], ends: bool, size: int) -> Iterator[dict]:
    """The run's edits and repaired text, in pieces; the last one has its counts."""
    letters, behind = letters_of(run.codes, exits, state)
    edits = iter(letters)
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
    audit: list[str] = []
    lines: list[str] = []
    held, seq, before, turn = 0, 0, None, None

    def piece(**more) -> dict:
        return {"key": run.key, "part": run.part, "seq": seq, "audit": "".join(audit), "repaired": "".join(lines), **more}

    def inserted(q: int) -> int:
        audit.append("I")
        lines.append(f"\n{NEW_ROLE[q]}:")
        counts["cost"] += INSERT
        return next_of(q)

    for r in run.rows:
        fault, copies = r["fault"], r["n"]
        if fault <= TRUNCATED:
            extra = CUT_SHORT if fault == TRUNCATED else 0
            for letter in next(edits):
                if letter == "I":
                    state = inserted(state)
                    continue
                audit.append(letter)
                if letter == "D":
                    counts["cost"] += DELETE
                    continue
                role = r["role"] if letter == "K" else NEW_ROLE[state]
                counts["cost"] += extra + (letter == "R")
                state = FOLLOWS[state][role[0]]
                lines.append(f"\n{role}:{r['text']}")
                held += len(r["text"])
        forced = copies - (fault <= TRUNCATED)
        audit.append("D" * forced)
        counts["cost"] += DELETE * forced
        counts["truncated"] += fault == TRUNCATED
        counts["blank"] += copies if fault == BLANK else 0
        counts["duplicate"] += 0 if fault == BLANK else forced
        if before is not None:
            counts["illegal"] += before + r["initial"] not in ("su", "ua", "au")
        counts["illegal"] += copies - 1  # a role beside itself
        before = r["initial"]
        if r["turn"] is not None and r["turn"] != turn:
            counts["turns"], turn = counts["turns"] + 1, r["turn"]
        held += forced
        if held >= size:
            yield piece()
            audit, lines, held, seq = [], [], 0, seq + 1
    if ends:
        for _ in CLOSING[behind]:
            state = inserted(state)
    known = next((r["turn"] for r in run.rows if r["turn"] is not None), None)
    yield piece(**counts, least=known, most=turn, head=run.rows[0]["initial"], tail=before)


def edited(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """Pieces of about `size` characters of the repaired conversations, part by part."""
    given = handed_over(rows)
    going_on = {at for at, (_, exits) in given.items() if exits is not END}

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            state, exits = given.get((run.part, run.key), (NONE, END))
            for piece in pieces_of(run, state, exits, (run.part, run.key) not in going_on, size):
                yield pa.RecordBatch.from_pylist([piece], PIECES)

    return by_part(rows, "turn", "role", "text").mapInArrow(edit, PIECES_SQL)


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digested(pieces: DataFrame) -> DataFrame:
    """One row a conversation from its pieces in order; the hash runs along, and no text is held."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in b.to_pylist())
        for key, held in groupby(rows, lambda r: r["key"]):
            total, turns, least, most, tail = dict.fromkeys(RESULT, 0), 0, None, None, None
            sha, any_text, audit = hashlib.sha256(), False, []
            for r in held:
                audit.append(r["audit"])
                text = r["repaired"].encode()
                sha.update(text if any_text else text[1:])
                any_text = any_text or bool(text)
                if r["head"] is None:
                    continue
                for c in RESULT[1:]:
                    total[c] += r[c]
                if tail is not None:
                    total["illegal"] += tail + r["head"] not in ("su", "ua", "au")
                tail = r["tail"]
                turns += r["turns"] - (r["least"] is not None and r["least"] == most)
                least = r["least"] if least is None else least
                most = most if r["most"] is None else r["most"]
            total["gaps"] = 0 if least is None else most - least + 1 - turns
            yield pa.RecordBatch.from_pylist([{"key": key, **total, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], schema)

    schema = pa.schema([("key", pa.string()), *[(c, pa.int64()) for c in RESULT], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    kinds = ", ".join(f"{c} long" for c in RESULT)
    return pieces.repartition("key").sortWithinPartitions("key", "part", "seq").mapInArrow(digest, f"key string, {kinds}, audit string, repaired_sha256 string")


def repair(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation: its rows are
    damaged, then repaired by the cheapest edits whose role initials read `(s?(ua)+)?`, ties to the ASCII-least audit.

    Rows are taken by turn (nulls first), then role and text, which only matters for ties. A null role or text is one space, so
    that text is blank; a null conv_id is a conversation of its own; columns besides the four are not read. A conversation
    without rows after damage has zeros, an empty audit and the hash of nothing. An empty table gives no rows.
    """
    bound_batches(conversations.sparkSession)
    found = digested(edited(sorted_parts(faulty(damaged(conversations))), piece))
    key = F.concat(F.when(F.col("conv_id").isNull(), "n").otherwise("v"), F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    every = conversations.select("conv_id").distinct().select("conv_id", key.alias("key"))

    def given(c: str, default) -> Column:
        return F.coalesce(F.col(c), F.lit(default)).alias(c)

    return every.join(found, "key", "left").select("conv_id", *[given(c, 0).cast("long").alias(c) for c in RESULT], given("audit", ""), given("repaired_sha256", hashlib.sha256().hexdigest()))
