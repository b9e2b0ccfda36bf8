"""Velocity features of each key as a stream: the state before a transaction gives its features, then takes it in."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import chain
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

HOUR = 3_600_000_000
DAY = 24 * HOUR
#: Members are kept in slices of this length; an hour and a day are whole numbers of them.
SLICE = 300_000_000
#: Sums between two slices that a batch keeps for its next rows.
MOST_BETWEEN = 16
#: Keys of a stream are dealt over so many groups where their states are packed, see PackedVelocity.
GROUPS = 4096
#: Rows of a task that are packed by group before their shuffle, and rows of a group that come out as one.
PACKED_IN, PACKED_OUT = 500_000, 10_000
#: Members of a key that a group's pack holds; a key with more has slices of its own.
MOST_PACKED = 64
#: Members and rows of a batch of a packed key that plain lists take; a key with more goes through slices.
FEW = 1024
TOTALS = "n long, total double, squares double, last_us long, slices array<long>, counts array<long>, amounts array<double>, declines array<long>"
MEMBERS = "at array<long>, amount array<double>, declined array<boolean>, id array<string>"
PACK = "{key} array<{kind}>, n array<long>, total array<double>, squares array<double>, last_us array<long>, large array<boolean>, of array<int>, at array<long>, amount array<double>, declined array<boolean>, id array<string>, features array<string>"
OUT = "{key} {kind}, id string, tx_count_1h int, tx_count_24h int, amount_sum_24h double, declines_24h int, seconds_since_last_tx double, amount_zscore double, tx_seq long, late boolean"
OUT_PACKED = "{key} array<{kind}>, id array<string>, tx_count_1h array<int>, tx_count_24h array<int>, amount_sum_24h array<double>, declines_24h array<int>, seconds_since_last_tx array<double>, amount_zscore array<double>, tx_seq array<long>, late array<boolean>"
INPUT = ("id", "amount", "at", "declined", "kind")
FIELDS = ("tx_count_1h", "tx_count_24h", "amount_sum_24h", "declines_24h", "seconds_since_last_tx", "amount_zscore", "tx_seq", "late")
#: What each of them is read with from the text that the state keeps.
KINDS = (int, int, float, int, float, float, int, "True".__eq__)


Moments = tuple[int, float, float, "int | None"]
Members = list[tuple[int, float, bool, str, "str | None"]]


class Slice:
    """A slice's members in order of time, with running sums of amounts and declines."""

    def __init__(self, at=(), amount=(), declined=(), ids=()):
        self.at, self.amount, self.declined, self.ids = list(at), list(amount), list(declined), list(ids)
        self.run(0)

    def run(self, start: int) -> None:
        """Run the sums up again from a place on."""
        if start == 0:
            self.sums, self.declines = [0.0], [0]
        del self.sums[start + 1 :], self.declines[start + 1 :]
        for x, d in zip(self.amount[start:], self.declined[start:]):
            self.sums.append(self.sums[-1] + x)
            self.declines.append(self.declines[-1] + bool(d))

    def add(self, at: int, amount: float, declined: bool, member: str) -> None:
        i = bisect_right(self.at, at)
        for held, x in ((self.at, at), (self.amount, amount), (self.declined, declined), (self.ids, member)):
            held.insert(i, x)
        self.run(i)

    def until(self, at: int) -> tuple[int, float, int]:
        i = bisect_right(self.at, at)
        return i, self.sums[i], self.declines[i]

    def since(self, at: int) -> tuple[int, float, int]:
        i = bisect_left(self.at, at)
        return len(self.at) - i, self.sums[-1] - self.sums[i], self.declines[-1] - self.declines[i]

    def mark(self, at: int, member: str, declined: bool) -> int:
        """Set a member's decline flag; returns the change of the slice's declines."""
        for i in range(bisect_left(self.at, at), bisect_right(self.at, at)):
            if self.ids[i] == member:
                change = int(declined) - int(self.declined[i])
                self.declined[i] = declined
                if change:
                    self.run(i)
                return change
        return 0


def encoded(features: tuple | str | None) -> str | None:
    """Features as the state keeps them."""
    return "|".join(["" if f is None else repr(f) for f in features]) if isinstance(features, tuple) else features


def decoded(text: str) -> tuple:
    return tuple([kind(x) if x else None for kind, x in zip(KINDS, text.split("|"))])


class History:
    """One key's state during a batch. Slices' totals are read and written as one value, the members of a slice and the ids
    only where rows touch them: those of the row's own slice and of the slices in which its windows begin. What a batch both
    brings and drops never reaches the state. Where a batch has as many rows as the state has slices, the slices tell which
    ids are there; otherwise each id is looked up. Maps that hold other keys too (alone false) are never cleared."""

    def __init__(self, totals, members, seen, rows: int = 0, alone: bool = True):
        self.totals, self.members, self.seen, self.alone = totals, members, seen, alone
        self.n, self.total, self.squares, self.last = 0, 0.0, 0.0, None
        self.sums: dict[int, list] = {}
        if totals.exists():
            self.n, self.total, self.squares, self.last, slices, *sums = totals.get()
            self.sums = {b: list(x) for b, *x in zip(slices, *sums)}
        self.oldest = min(self.sums, default=None)
        self.stored = set(self.sums)
        self.dropped: set[int] = set()
        self.gone: set[str] = set()
        self.held: dict[int, Slice] = {}
        self.changed: set[int] = set()
        self.ids: dict[str, tuple[int, tuple | str | None]] = {}
        self.new_ids: set[str] = set()
        self.between: dict[tuple[int, int], tuple[int, float, int]] = {}
        #: Ids that the state holds; None where they are looked up.
        self.there: set[str] | None = None
        if len(self.stored) <= rows:
            self.there = {member for b in self.stored for member in self.slice(b).ids}

    def slice(self, b: int) -> Slice:
        if b not in self.held:
            stored = self.members.getValue((b,)) if b in self.sums else None
            self.held[b] = Slice(*stored) if stored else Slice()
        return self.held[b]

    def known(self, member: str) -> tuple[int, tuple | str | None] | None:
        """(time, features of its first time) of a member of the retention."""
        if member not in self.ids and member not in self.gone and (self.there is None or member in self.there) and self.seen.containsKey((member,)):
            self.ids[member] = tuple(self.seen.getValue((member,)))
        return self.ids.get(member)

    def window(self, at: int, span: int) -> tuple[int, float, int]:
        """(count, sum, declines) of members from at - span to at, both included."""
        b = at // SLICE
        first = b - span // SLICE
        if (b, first) not in self.between:
            inner = [x for s, x in self.sums.items() if first < s < b] if len(self.sums) < b - first else [self.sums[x] for x in range(first + 1, b) if x in self.sums]
            if len(self.between) > MOST_BETWEEN:
                self.between.clear()
            self.between[b, first] = tuple(map(sum, zip(*inner))) if inner else (0, 0.0, 0)
        parts = [self.between[b, first]]
        if b in self.sums:
            parts.append(self.slice(b).until(at))
        if first in self.sums:
            parts.append(self.slice(first).since(at - span))
        return tuple(map(sum, zip(*parts)))

    def count(self, at: int, span: int) -> int:
        return self.window(at, span)[0]

    def _sum_up(self, b: int, n: int, amount: float, declines: int) -> None:
        self.changed.add(b)
        sums = self.sums.setdefault(b, [0, 0.0, 0])
        sums[0], sums[1], sums[2] = sums[0] + n, sums[1] + amount, sums[2] + declines
        self.oldest = b if self.oldest is None else min(self.oldest, b)
        self.between = {k: v for k, v in self.between.items() if not k[1] < b < k[0]}

    def remember(self, member: str, at: int, features: tuple | str | None) -> None:
        self.ids[member] = (at, features)
        self.new_ids.add(member)

    def append(self, at: int, amount: float, declined: bool, member: str, features: tuple | str | None) -> None:
        self.slice(at // SLICE).add(at, amount, declined, member)
        self._sum_up(at // SLICE, 1, amount, int(declined))
        self.remember(member, at, features)

    def mark(self, member: str, declined: bool) -> None:
        if found := self.known(member):
            b = found[0] // SLICE
            change = self.slice(b).mark(found[0], member, declined)
            self._sum_up(b, 0, 0.0, change)

    def evict(self, before: int) -> None:
        """Drop slices that end before a time, with their ids; each member once."""
        while self.oldest is not None and (self.oldest + 1) * SLICE <= before:
            b = self.oldest
            members = self.slice(b).ids
            for member in members:
                self.ids.pop(member, None)
                self.new_ids.discard(member)
            if b in self.stored:
                self.dropped.add(b)
                self.gone.update(members)
            del self.held[b], self.sums[b]
            self.changed.discard(b)
            self.oldest = min(self.sums, default=None)

    def store(self) -> None:
        if self.alone and self.dropped and self.dropped == self.stored:
            self.members.clear()
            self.seen.clear()
        else:
            for b in self.dropped:
                self.members.removeKey((b,))
            for member in self.gone:
                self.seen.removeKey((member,))
        order = sorted(self.sums)
        columns = [list(x) for x in zip(*(self.sums[b] for b in order))] or [[], [], []]
        self.totals.update((self.n, self.total, self.squares, self.last, order, *columns))
        for b in self.changed:
            s = self.held[b]
            self.members.updateValue((b,), (s.at, s.amount, s.declined, s.ids))
        for member in self.new_ids:
            at, features = self.ids[member]
            self.seen.updateValue((member,), (at, encoded(features)))


class Few:
    """History's calls on the members of a key that has few in a batch: plain lists in order of time and sums of stretches of them."""

    def __init__(self, moments: Moments | None, members: Members):
        self.n, self.total, self.squares, self.last = moments or (0, 0.0, 0.0, None)
        self.at, self.amount, self.declined, self.members, features = map(list, zip(*members)) if members else ([], [], [], [], [])
        self.ids = {member: known for member, *known in zip(self.members, self.at, features)}

    def slice(self, _: int) -> Few:
        return self

    def known(self, member: str) -> list | tuple | None:
        return self.ids.get(member)

    def count(self, at: int, span: int) -> int:
        return bisect_right(self.at, at) - bisect_left(self.at, at - span)

    def window(self, at: int, span: int) -> tuple[int, float, int]:
        i, j = bisect_left(self.at, at - span), bisect_right(self.at, at)
        return j - i, sum(self.amount[i:j]), sum(self.declined[i:j])

    def remember(self, member: str, at: int, features: tuple | str | None) -> None:
        self.ids[member] = (at, features)

    def append(self, at: int, amount: float, declined: bool, member: str, features: tuple | str | None) -> None:
        i = bisect_right(self.at, at)
        self.at.insert(i, at)
        self.amount.insert(i, amount)
        self.declined.insert(i, declined)
        self.members.insert(i, member)
        self.ids[member] = (at, features)

    def mark(self, member: str, declined: bool) -> None:
        if member in self.ids:
            self.declined[self.members.index(member)] = declined

    def evict(self, before: int) -> None:
        """Drop members of slices that end before a time."""
        before = before // SLICE * SLICE
        if self.at and self.at[0] < before:
            i = bisect_left(self.at, before)
            for member in self.members[:i]:
                self.ids.pop(member, None)
            for held in (self.at, self.amount, self.declined, self.members):
                del held[:i]

    def stored(self) -> tuple[Moments, Members]:
        features = [encoded(self.ids[member][1]) for member in self.members]
        return (self.n, self.total, self.squares, self.last), list(zip(self.at, self.amount, self.declined, self.members, features))


class Velocity(StatefulProcessor):
    """Members of the last `retention` are kept in slices of five minutes, with a map of their ids; lifetime moments and the
    slices' totals are one value. Times are whole microseconds. A batch reads and writes the slices that its rows touch and
    looks each id up once, so its cost follows its rows and not the key's day.

    A transaction seen before gives the features of its first time. A status event (kind 'status') marks a member as
    declined. Rows of a batch are taken in order of (time, id); a row behind the last one seen is marked late, and one
    behind the retention counts in the moments only. With event-time timers, members of a key that falls silent leave when
    the watermark passes their retention.
    """

    def __init__(self, key: str, retention_us: int, ttl_ms: int | None, timers: bool = False):
        self.key, self.retention, self.ttl, self.timers = key, retention_us, ttl_ms, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", TOTALS, ttlDurationMs=self.ttl)
        self.members = handle.getMapState("members", "slice long", MEMBERS, ttlDurationMs=self.ttl)
        self.seen = handle.getMapState("seen", "id string", "at long, features string", ttlDurationMs=self.ttl)

    def _history(self, rows: int = 0) -> History:
        return History(self.totals, self.members, self.seen, rows)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        past = self._history()
        self._seed(past, initialState.asDict())
        past.store()

    @staticmethod
    def _seed(past: History, row: dict) -> None:
        if row["members"] is None:
            past.n, past.total, past.squares, past.last = row["n"], row["total"], row["squares"], row["last_us"]
        else:
            for m in row["members"]:
                past.append(m["at"], m["amount"], m["declined"], m["id"], None)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        batch = sorted(((r.id, float("nan") if r.amount is None else r.amount, r.at, r.declined, r.kind) for r in rows), key=lambda r: (r[2], r[0]))
        past = self._history(len(batch))
        out = self.taken(past, batch)
        past.store()
        if self.timers and past.sums:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((past.last + self.retention) // 1000 + SLICE // 1000)
        named = Row(self.key, "id", *FIELDS)
        for found in out:
            yield named(key[0], *found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        past = self._history()
        past.evict(expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.retention)
        past.store()
        return iter(())

    def features(self, past: History | Few, batch: pd.DataFrame) -> list[tuple]:
        return self.taken(past, zip(*(batch[c].tolist() for c in INPUT)))

    def taken(self, past: History | Few, batch: Iterable[tuple]) -> list[tuple]:
        """Rows (INPUT) in order into the state; returns id and features of each transaction."""
        out = []
        for member, amount, at, declined, kind in batch:
            if kind == "status":
                past.mark(member, bool(declined))
                continue
            known = past.known(member)
            if known and known[1]:
                out.append((member, *(decoded(known[1]) if isinstance(known[1], str) else known[1])))
                continue
            found = self._features(past, at, amount, known)
            out.append((member, *found))
            if known:
                past.remember(member, known[0], found)
                continue
            past.n, past.total, past.squares = past.n + 1, past.total + amount, past.squares + amount * amount
            past.last = at if past.last is None else max(past.last, at)
            if at >= past.last - self.retention:
                past.append(at, float(amount), bool(declined), member, found)
            past.evict(past.last - self.retention)
        return out

    @staticmethod
    def _features(past: History | Few, at: int, amount: float, known: list | tuple | None) -> tuple:
        """A seeded member (known, without features) is in the state already and is left out of its own past."""
        hour = past.count(at, HOUR)
        day, total, declines = past.window(at, DAY)
        n, sums, squares = past.n, past.total, past.squares
        if known and at - DAY <= known[0] <= at:
            s = past.slice(known[0] // SLICE)
            i = next(i for i in range(bisect_left(s.at, known[0]), len(s.at)) if s.amount[i] == amount or s.at[i] > known[0])
            hour, day, total, declines = hour - (known[0] >= at - HOUR), day - 1, total - amount, declines - bool(s.declined[i])
        return (
            1 + hour,
            1 + day,
            amount + total,
            declines,
            None if past.last is None else (at - past.last) / 1e6,
            zscore_of(amount, n, sums, squares),
            n + 1,
            past.last is not None and at < past.last,
        )

    def close(self) -> None:
        pass


class Memory(dict):
    """A state variable's calls on values that a pack holds."""

    def exists(self) -> bool:
        return () in self

    def get(self) -> tuple:
        return self[()]

    def update(self, value: tuple) -> None:
        self[()] = value

    def containsKey(self, key: tuple) -> bool:
        return key in self

    def getValue(self, key: tuple) -> tuple:
        return self[key]

    def updateValue(self, key: tuple, value: tuple) -> None:
        self[key] = value

    def removeKey(self, key: tuple) -> None:
        self.pop(key, None)


class Part:
    """One key's part of a map state of many keys: a map of its own, or its one value under the key alone."""

    def __init__(self, state, key):
        self.state, self.key = state, key

    def exists(self) -> bool:
        return self.containsKey(())

    def get(self) -> tuple:
        return self.getValue(())

    def update(self, value: tuple) -> None:
        self.updateValue((), value)

    def containsKey(self, key: tuple) -> bool:
        return self.state.containsKey((self.key, *key))

    def getValue(self, key: tuple) -> tuple:
        return self.state.getValue((self.key, *key))

    def updateValue(self, key: tuple, value: tuple) -> None:
        self.state.updateValue((self.key, *key), value)

    def removeKey(self, key: tuple) -> None:
        self.state.removeKey((self.key, *key))


class Columns(Row):
    """A row of arrays of plain values: none of them is looked into on the way to Arrow."""

    def asDict(self, recursive: bool = False) -> dict:
        return super().asDict()


class PackedVelocity(Velocity):
    """Velocity over groups of keys, of rows packed as arrays. A call of the state costs far more than a row, so the states of
    a group's keys are one value, read and written once a batch: calls follow the groups and not the keys. A key of more than MOST_PACKED members has
    its slices and ids in maps, as Velocity's; the pack keeps its moments only. A batch's rows of one group are held at once.
    """

    def __init__(self, key: str, kind: str, retention_us: int, ttl_ms: int | None, timers: bool = False):
        super().__init__(key, retention_us, ttl_ms, timers)
        self.kind = kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pack = handle.getValueState("pack", PACK.format(key=self.key, kind=self.kind), ttlDurationMs=self.ttl)
        self.totals = handle.getMapState("totals", f"{self.key} {self.kind}", TOTALS, ttlDurationMs=self.ttl)
        self.members = handle.getMapState("members", f"{self.key} {self.kind}, slice long", MEMBERS, ttlDurationMs=self.ttl)
        self.seen = handle.getMapState("seen", f"{self.key} {self.kind}, id string", "at long, features string", ttlDurationMs=self.ttl)

    def _unpacked(self) -> dict[object, tuple[Moments, Members | None]]:
        """Moments and members of each key of the group; members are None where they are in the maps."""
        value = self.pack.get()
        if value is None:
            return {}
        keys, n, total, squares, last, large, of, *columns = value
        members: list[Members] = [[] for _ in keys]
        for i, *member in zip(of, *columns):
            members[i].append(tuple(member))
        return {k: (moments, None if apart else m) for k, moments, apart, m in zip(keys, zip(n, total, squares, last), large, members)}

    def _pack(self, keys: dict) -> None:
        moments = [list(x) for x in zip(*(m for m, _ in keys.values()))]
        flat = [(i, *member) for i, (_, members) in enumerate(keys.values()) for member in members or ()]
        columns = [list(x) for x in zip(*flat)] or [[] for _ in range(6)]
        self.pack.update((list(keys), *moments, [m is None for _, m in keys.values()], *columns))

    def _past(self, keys: dict, key, rows: int = 0) -> History | Few:
        moments, members = keys.get(key, (None, []))
        if members is None:
            return History(Part(self.totals, key), Part(self.members, key), Part(self.seen, key), rows, alone=False)
        return Few(moments, members) if len(members) + rows <= FEW else self._sliced(moments, members, rows)

    @staticmethod
    def _sliced(moments: Moments | None, members: Members, rows: int = 0) -> History:
        totals, slices, seen = Memory(), Memory(), Memory()
        if moments:
            by_slice: dict[int, Members] = {}
            for member in members:
                by_slice.setdefault(member[0] // SLICE, []).append(member)
                seen[member[3],] = (member[0], member[4])
            for b, m in by_slice.items():
                slices[b,] = tuple(zip(*m))[:4]
            sums = [(len(m), sum(x[1] for x in m), sum(bool(x[2]) for x in m)) for m in by_slice.values()]
            totals.update((*moments, list(by_slice), *([list(x) for x in zip(*sums)] or [[], [], []])))
        return History(totals, slices, seen, rows)

    def _keep(self, keys: dict, key, past: History | Few) -> None:
        if isinstance(past, Few):
            keys[key] = past.stored()
            if len(past.at) <= MOST_PACKED:
                return
            past = self._sliced(*keys[key])
        past.store()
        moments = (past.n, past.total, past.squares, past.last)
        if isinstance(past.totals, Part):
            if not past.sums:
                past.totals.removeKey(())
            keys[key] = (moments, None if past.sums else [])
        elif sum(n for n, *_ in past.sums.values()) > MOST_PACKED:
            self.totals.updateValue((key,), past.totals.get())
            for own, name in ((past.members, "members"), (past.seen, "seen")):
                for k, value in own.items():
                    getattr(self, name).updateValue((key, *k), value)
            keys[key] = (moments, None)
        else:
            features = lambda member: dict.get(past.seen, (member,), (0, None))[1]
            keys[key] = (moments, [(at, x, d, m, features(m)) for b in sorted(past.members) for at, x, d, m in zip(*past.members[b])])

    def _due(self, moments: Moments) -> int:
        return (moments[3] + self.retention) // 1000 + SLICE // 1000

    def _set_timer(self, keys: dict) -> None:
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        due = [self._due(moments) for moments, members in keys.values() if members is None or members]
        if due:
            self.handle.registerTimer(min(due))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        keys = self._unpacked()
        rows: dict[object, list] = {}
        for row in initialState.past:
            rows.setdefault(row[self.key], []).append(row)
        for k, own in rows.items():
            past = self._past(keys, k, sum(len(row["members"] or ()) for row in own))
            for row in own:
                self._seed(past, row)
            self._keep(keys, k, past)
        self._pack(keys)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        batches: dict[object, list[tuple]] = {}
        take = None
        for row in rows:
            take = take or itemgetter(*(row.__fields__.index(c) for c in (self.key, *INPUT)))
            for k, member, amount, at, declined, kind in zip(*take(row)):
                batches.setdefault(k, []).append((member, float("nan") if amount is None else amount, at, declined, kind))
        keys = self._unpacked()
        out = []
        for k, batch in batches.items():
            batch.sort(key=lambda r: (r[2], r[0]))
            past = self._past(keys, k, len(batch))
            out += [(k, *found) for found in self.taken(past, batch)]
            self._keep(keys, k, past)
        self._pack(keys)
        if self.timers:
            self._set_timer(keys)
        names = (self.key, "id", *FIELDS)
        for i in range(0, len(out), PACKED_OUT):
            yield Columns(**dict(zip(names, map(list, zip(*out[i : i + PACKED_OUT])))))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        keys = self._unpacked()
        for k, (moments, members) in list(keys.items()):
            if (members is None or members) and self._due(moments) <= expiredTimerInfo.getExpiryTimeInMs():
                past = self._past(keys, k)
                past.evict(self._due(moments) * 1000 - self.retention)
                self._keep(keys, k, past)
        self._pack(keys)
        self._set_timer(keys)
        return iter(())


def zscore_of(x: float, n: int, total: float, squares: float) -> float | None:
    """scalar.zscore for one row."""
    if n < 2:
        return None
    variance = (squares - total * total / n) / (n - 1)
    return (x - total / n) / variance**0.5 if variance > 1e-12 * squares else None


def events(tx: DataFrame, key: str) -> DataFrame:
    """Transactions in the form that the state takes."""
    return tx.select(
        key,
        F.col("id").cast("string").alias("id"),
        F.col("amount_usd").cast("double").alias("amount"),
        F.unix_micros(F.col("created_at").cast("timestamp")).alias("at"),
        F.coalesce(F.col("status") == "declined", F.lit(False)).alias("declined"),
        F.lit("transaction").alias("kind"),
    )


def status_events(status: DataFrame, key: str) -> DataFrame:
    """(key, id, created_at, status) rows that come after their transaction, for union with events()."""
    return status.select(
        key, F.col("id").cast("string").alias("id"), F.lit(0.0).alias("amount"), F.unix_micros(F.col("created_at").cast("timestamp")).alias("at"), (F.col("status") == "declined").alias("declined"), F.lit("status").alias("kind")
    )


def velocity_stream(stream: DataFrame, key: str, initial: DataFrame | None = None, retention_hours: int = 25, ttl_days: int | None = None, delay: str | None = None, groups: int | None = None) -> DataFrame:
    """Velocity features of a stream of events() rows. `initial` comes from training.initial_state(). The state store
    must be RocksDB's, see with_rocksdb. ttl_days drops state so long after its last write, by processing time. With a
    delay, rows are taken up to so much behind the newest of the stream, and timers evict the members of silent keys. With
    groups, keys are dealt over so many and a group's states are packed (PackedVelocity), for streams of many keys; the number
    must not change while a stream lives. Without, each key has its own state."""
    kind, out = dict(stream.dtypes)[key], OUT if groups is None else OUT_PACKED
    settings = retention_hours * HOUR, None if ttl_days is None else ttl_days * 86_400_000, delay is not None
    processor, by = (Velocity(key, *settings), key) if groups is None else (PackedVelocity(key, kind, *settings), "_group")
    if groups is not None:
        group = F.pmod(F.xxhash64(key), F.lit(groups))
        stream = stream.select(group.alias(by), key, *INPUT)
        stream = packed_rows(stream, by) if delay is None else stream.withColumn("event_time", F.timestamp_micros("at")).select(by, "event_time", *[F.array(c).alias(c) for c in (key, *INPUT)])
        if initial is not None:  # a row a group; slices of very busy keys come by the hour
            chunk = F.when(F.size("members") > MOST_PACKED, F.floor(F.col("members")[0]["at"] / HOUR))
            past = F.collect_list(F.struct(*initial.columns)).alias("past")
            initial = initial.groupBy(group.alias(by), chunk.alias("_chunk")).agg(past).drop("_chunk")
    if delay is not None:
        stream = (stream if groups else stream.withColumn("event_time", F.timestamp_micros("at"))).withWatermark("event_time", delay)
    found = stream.groupBy(by).transformWithState(
        statefulProcessor=processor,
        outputStructType=out.format(key=key, kind=kind),
        outputMode="Append",
        timeMode="EventTime" if delay is not None else "None" if ttl_days is None else "ProcessingTime",
        initialState=None if initial is None else initial.groupBy(by),
    )
    return found if groups is None else found.select(F.inline(F.arrays_zip(*found.columns)).alias(*found.columns))


def packed_rows(stream: DataFrame, by: str) -> DataFrame:
    """A row for each value of `by` in a stretch of a task's rows, its other columns as arrays: a row costs more on its way to
    the state and back than an element does."""
    names = [c for c in stream.columns if c != by]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in chain(batches, [None]):
            if held and (batch is None or n >= PACKED_IN):
                grouped = pa.Table.from_batches(held).group_by(by, use_threads=False).aggregate([(c, "list") for c in names])
                yield from grouped.select([by, *(f"{c}_list" for c in names)]).rename_columns([by, *names]).to_batches()
                held, n = [], 0
            if batch is not None and batch.num_rows:
                held, n = [*held, batch], n + batch.num_rows

    kinds = dict(stream.dtypes)
    return stream.mapInArrow(pack, ", ".join(f"{c} {kinds[c]}" if c == by else f"{c} array<{kinds[c]}>" for c in stream.columns))


def packed_moments(pack: DataFrame, key: str) -> DataFrame:
    """(key, n, total, squares, last_us) from rows of the state variable `pack`, as Spark's reader of state gives them."""
    names = (key, "n", "total", "squares", "last_us")
    return pack.select(F.inline(F.arrays_zip(*[F.col(f"value.{c}").alias(c) for c in names])).alias(*names))


def packed_ids(pack: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """(key, id) of all members in the state, from rows of the state variables `pack` and `seen`."""
    inside = pack.select(F.col(f"value.{key}").alias("keys"), F.explode(F.arrays_zip(F.col("value.of").alias("of"), F.col("value.id").alias("id"))).alias("m"))
    return inside.select(F.col("keys")[F.col("m.of")].alias(key), "m.id").unionByName(seen.select(f"user_map_key.{key}", "user_map_key.id"))


@contextmanager
def with_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that start within keep their state in RocksDB; the session's own setting comes back after."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def replay(parts: list[DataFrame], transform: Callable[[DataFrame], DataFrame], folder: str) -> DataFrame:
    """Send rows through a stream part by part, each time going on from the checkpoint, and read what it has written."""
    spark = parts[0].sparkSession
    schema = parts[0].schema
    for part in parts:
        part.select(*schema.names).write.mode("append").parquet(f"{folder}/in")
        with with_rocksdb(spark):
            out = transform(spark.readStream.schema(schema).parquet(f"{folder}/in"))
            query = out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
            query.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


class Welford(StatefulProcessor):
    """Running count, mean and deviation of a key's values."""

    def __init__(self, key: str, value: str):
        self.key, self.value = key, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("welford", "n long, mean double, m2 double")

    def handleInputRows(self, key, rows, timerValues):
        n, mean, m2 = self.state.get() if self.state.exists() else (0, 0.0, 0.0)
        for frame in rows:
            for x in frame[self.value]:
                n += 1
                d = x - mean
                mean += d / n
                m2 += d * (x - mean)
        self.state.update((n, mean, m2))
        yield pd.DataFrame({self.key: [key[0]], "n": [n], "mean": [mean], "std": [(m2 / (n - 1)) ** 0.5 if n > 1 else None]})

    def close(self) -> None:
        pass


def welford_stream(stream: DataFrame, key: str, value: str) -> DataFrame:
    out = f"{key} {dict(stream.dtypes)[key]}, n long, mean double, std double"
    return stream.groupBy(key).transformWithStateInPandas(statefulProcessor=Welford(key, value), outputStructType=out, outputMode="Update", timeMode="None")


def windowed_counts(stream: DataFrame, key: str, spans: dict[str, str], delay: str = "1 hour") -> dict[str, DataFrame]:
    """Count, sum and largest amount per key over tumbling windows of several lengths, behind one watermark."""
    marked = stream.withColumn("created_at", F.col("created_at").cast("timestamp")).withWatermark("created_at", delay)
    return {
        name: marked.groupBy(F.window("created_at", span).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum("amount_usd").alias("total"), F.max("amount_usd").alias("largest")).select(F.col("w.start").alias("start"), key, "n", "total", "largest")
        for name, span in spans.items()
    }
