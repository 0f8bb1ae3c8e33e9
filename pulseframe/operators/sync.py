"""The synchroniser of modules, read share by share (AGG-8, AGG-9 in their exact form).

A synchroniser holds one notice of each module. While they differ it moves: every module discards what is older than the
newest, and where it then stands may be newer again. What it holds between two pulses that all modules have is a state; a
share of a detector's pulses takes one state to another.

A share's effect on any state can be told without the state. Until its first move the share only adds notices; that move
comes at the pulse where the last module that the state lacks shows up, so at one of at most n_modules pulses; and what
happens after a move depends on its pulse only. So a summary holds what follows each of these pulses, and a share with a
pulse of all modules has the same end whatever was before. Summaries are made in parallel, states are carried over them (one
row for each share), and then every share is read from its own state, in parallel again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SYNC_OFFSET, SYNC_ROUNDS

#: Pulses of a share.
SHARE = 50_000
#: Modules that a pulse's set of them has room for.
MOST_MODULES = 62


@dataclass
class State:
    """first, seen: of each module that has a notice, its pulse and how many pulses it has had since the last move. lost,
    moves: what was discarded and how often, since the last pulse of all modules. wrong: what went wrong since then."""

    first: dict[int, int] = field(default_factory=dict)
    seen: dict[int, int] = field(default_factory=dict)
    lost: int = 0
    moves: int = 0
    wrong: str | None = None


@dataclass
class Rules:
    n_modules: int
    limit: int
    rounds: int

    def modules(self, held: int) -> list[int]:
        return [m for m in range(self.n_modules) if held >> m & 1]

    def fresh(self, s: State) -> State:
        """s, or where it stands at a pulse of all modules, the state after that."""
        return State() if len(s.first) == self.n_modules and len(set(s.first.values())) == 1 else s

    def hold(self, s: State, pulse: int, modules: list[int]) -> None:
        for m in modules:
            s.first.setdefault(m, pulse)
            s.seen[m] = s.seen.get(m, 0) + 1

    def moves(self, s: State, pulse: int) -> bool:
        """Whether the synchroniser moves up to this pulse: all modules have a notice, some an older one."""
        return len(s.first) == self.n_modules and min(s.first.values()) < pulse

    def move(self, s: State, pulse: int, modules: list[int]) -> str | None:
        """Moves; what goes wrong with it if nothing did before."""
        s.moves += 1
        kind = "rounds" if s.moves > self.rounds else "offset" if pulse - min(s.first.values()) > self.limit else None
        new = kind if kind and not s.wrong else None
        s.wrong = s.wrong or kind
        s.lost += max(n - (m in modules) for m, n in s.seen.items())
        s.first, s.seen = dict.fromkeys(modules, pulse), dict.fromkeys(modules, 1)
        return new

    def take(self, s: State, pulse: int, modules: list[int]) -> str | None:
        """The next pulse. Afterwards s is that of a pulse of all modules if it has all of them."""
        self.hold(s, pulse, modules)
        return self.move(s, pulse, modules) if self.moves(s, pulse) else None


@dataclass
class Entry:
    """What follows a share's first move if it is at `pulse`: n pulses of each module come before it. moves, lost, and at
    which of these moves modules were too far apart first, do not count the first one; then the state at the end."""

    pulse: int
    before: dict[int, int]
    modules: list[int]
    after: State
    far: int | None


@dataclass
class Summary:
    """end: the state after the share if it has a pulse of all modules. Else first, seen: of each module its first pulse and
    number of pulses; entries: by pulse."""

    end: State | None
    first: dict[int, int]
    seen: dict[int, int]
    entries: dict[int, Entry]


def summarise(rules: Rules, pulses: list[int], held: list[int]) -> Summary:
    """Of a share's pulses in ascending order, and the modules of each as bits."""
    every = (1 << rules.n_modules) - 1
    common = [i for i, h in enumerate(held) if h == every]
    if common:
        s = State()
        for p, h in zip(pulses[common[-1] + 1 :], held[common[-1] + 1 :], strict=True):
            rules.take(s, p, rules.modules(h))
        return Summary(s, {}, {}, {})
    bits, at = np.array(held, np.int64), np.array(pulses, np.int64)
    of = {m: own for m in range(rules.n_modules) if len(own := at[(bits >> m & 1) == 1])}
    first, seen = {m: int(own[0]) for m, own in of.items()}, {m: len(own) for m, own in of.items()}
    # from a move at a pulse to the next one: its pulse, what it discards
    after: dict[int, tuple[int, int] | None] = {}

    def following(pulse: int) -> tuple[int, int] | None:
        if pulse not in after:
            since = {m: int(np.searchsorted(own, pulse)) for m, own in of.items()}
            if len(of) < rules.n_modules or any(k == len(of[m]) for m, k in since.items()):
                after[pulse] = None
            else:
                to = max(int(of[m][k]) for m, k in since.items())
                after[pulse] = to, max(int(np.searchsorted(own, to)) - since[m] for m, own in of.items())
        return after[pulse]

    entries = {}
    for begin in set(first.values()):
        pulse, moves, lost, far = begin, 0, 0, None
        while (to := following(pulse)) is not None:
            moves, lost = moves + 1, lost + to[1]
            far = moves if far is None and to[0] - pulse > rules.limit else far
            pulse = to[0]
        rest = {m: own[np.searchsorted(own, pulse) :] for m, own in of.items()}
        end = State({m: int(own[0]) for m, own in rest.items() if len(own)}, {m: len(own) for m, own in rest.items() if len(own)}, lost, moves)
        before = {m: int(np.searchsorted(own, begin)) for m, own in of.items()}
        entries[begin] = Entry(begin, before, rules.modules(held[int(np.searchsorted(at, begin))]), end, far)
    return Summary(None, first, seen, entries)


def carry(rules: Rules, s: State, share: Summary) -> State:
    """The state after a share."""
    if share.end is not None:
        return share.end
    s = rules.fresh(s)
    lacking = [m for m in range(rules.n_modules) if m not in s.first]
    add = lambda a, b: {m: a.get(m, 0) + b.get(m, 0) for m in a.keys() | b.keys()}
    at = max((share.first.get(m, -1) for m in lacking), default=min(share.entries, default=-1)) if all(m in share.first for m in lacking) else -1
    if at < 0 or not share.entries:
        return State(share.first | s.first, add(s.seen, share.seen), s.lost, s.moves, s.wrong)
    e = share.entries[at]
    now = State(dict(s.first), add(s.seen, e.before), s.lost, s.moves, s.wrong)
    for m, p in share.first.items():
        if p < at:
            now.first.setdefault(m, p)
    rules.hold(now, at, e.modules)
    rules.move(now, at, e.modules)
    wrong = now.wrong
    if not wrong:
        rest = rules.rounds - now.moves  # so many more moves are allowed
        if e.far is not None and e.far <= rest:
            wrong = "offset"
        elif e.after.moves > rest:
            wrong = "rounds"
    return State(dict(e.after.first), dict(e.after.seen), now.lost + e.after.lost, now.moves + e.after.moves, wrong)


_STATE = "struct<first: map<int, bigint>, seen: map<int, bigint>, lost: bigint, moves: bigint, wrong: string>"
_ENTRY = f"struct<pulse: bigint, before: map<int, bigint>, modules: array<int>, after: {_STATE}, far: bigint>"
_SUMMARY = f"struct<end: {_STATE}, first: map<int, bigint>, seen: map<int, bigint>, entries: array<{_ENTRY}>>"
_ARROW_MAP = pa.map_(pa.int32(), pa.int64())
_ARROW_STATE = pa.struct([("first", _ARROW_MAP), ("seen", _ARROW_MAP), ("lost", pa.int64()), ("moves", pa.int64()), ("wrong", pa.string())])
_ARROW_ENTRY = pa.struct([("pulse", pa.int64()), ("before", _ARROW_MAP), ("modules", pa.list_(pa.int32())), ("after", _ARROW_STATE), ("far", pa.int64())])
_ARROW_SUMMARY = pa.struct([("end", _ARROW_STATE), ("first", _ARROW_MAP), ("seen", _ARROW_MAP), ("entries", pa.list_(_ARROW_ENTRY))])


def _state_row(s: State | None) -> dict | None:
    return s and {"first": list(s.first.items()), "seen": list(s.seen.items()), "lost": s.lost, "moves": s.moves, "wrong": s.wrong}


def _state(row: dict | None) -> State | None:
    return row and State(dict(row["first"]), dict(row["seen"]), row["lost"], row["moves"], row["wrong"])


def _summary_row(x: Summary) -> dict:
    entries = [{"pulse": e.pulse, "before": list(e.before.items()), "modules": e.modules, "after": _state_row(e.after), "far": e.far} for e in x.entries.values()]
    return {"end": _state_row(x.end), "first": list(x.first.items()), "seen": list(x.seen.items()), "entries": entries}


def _summary(row: dict) -> Summary:
    entries = {e["pulse"]: Entry(e["pulse"], dict(e["before"]), e["modules"], _state(e["after"]), e["far"]) for e in row["entries"]}
    return Summary(_state(row["end"]), dict(row["first"]), dict(row["seen"]), entries)


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (detector, share), which come one after the other."""
    held: list[pa.RecordBatch] = []
    key = None
    for b in batches:
        names, shares = b.column(0).to_pylist(), b.column(1).to_pylist()
        cuts = [0, *[i for i in range(1, b.num_rows) if shares[i] != shares[i - 1] or names[i] != names[i - 1]], b.num_rows]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if a == z:
                continue
            if held and key != (names[a], shares[a]):
                yield pa.Table.from_batches(held)
                held = []
            key = (names[a], shares[a])
            held.append(b.slice(a, z - a))
    if held:
        yield pa.Table.from_batches(held)


def read_share(rules: Rules, s: State, pulses: np.ndarray, held: np.ndarray) -> tuple[list[tuple[int, str, int | None, str | None]], State]:
    """(pulse, event, lost, what went wrong) of a share from the state before it, and the state after: 'aligned' for each
    pulse of all modules, 'offset' or 'rounds' where something goes wrong first after one. Pulses of all modules that follow
    one another, nearly all of them as a rule, are not looked at one by one."""
    every = (1 << rules.n_modules) - 1
    full = held == every
    plain = full.copy()
    plain[1:] &= full[:-1]
    if len(full):
        plain[0] &= not rules.fresh(s).first
    out = [(p, "aligned", 0, None) for p in pulses[plain].tolist()]
    at = -1
    for i in np.nonzero(~plain)[0].tolist():
        s = rules.fresh(s) if i == at + 1 else State()
        p, modules, at = int(pulses[i]), rules.modules(int(held[i])), i
        if (kind := rules.take(s, p, modules)) is not None:
            out.append((p, kind, None, kind))
        if full[i]:
            out.append((p, "aligned", s.lost, s.wrong))
    return out, State() if len(full) and plain[-1] else rules.fresh(s)


def sync_events(frames: DataFrame, n_modules: int, detector: str = "detector_name", limit: int = SYNC_OFFSET, rounds: int = SYNC_ROUNDS, share: int = SHARE) -> DataFrame:
    """(detector, pulse_id, event, n_lost_pulses, violation): what the synchroniser gives for each detector's notices, in its
    exact form. Event 'aligned': a pulse that all modules have, how much was discarded to come there from the one before, and
    what went wrong on the way. Events 'offset' (modules more than `limit` pulses apart) and 'rounds' (more than `rounds`
    moves): the pulse at which the first such thing after an aligned pulse was seen, whether or not another one followed.

    Modules beyond the last, null modules and null pulses are no notices; a notice that came twice is one; a null detector is
    one of its own."""
    if n_modules > MOST_MODULES:
        raise ValueError(f"at most {MOST_MODULES} modules, not {n_modules}")
    rules = Rules(n_modules, limit, rounds)
    held = frames.where(F.col("module_id").between(0, n_modules - 1) & F.col("pulse_id").isNotNull())
    bit = F.lit(0).cast("bigint")
    for m in range(n_modules):
        bit = F.when(F.col("module_id") == m, F.lit(1 << m).cast("bigint")).otherwise(bit)
    each = held.groupBy(F.col(detector).alias("_name"), F.col("pulse_id").cast("bigint").alias("_pulse")).agg(F.bit_or(bit).alias("_held"))
    each = each.select("_name", F.floor(F.col("_pulse") / share).alias("_share"), "_pulse", "_held")

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _shares(batches):
            got = summarise(rules, t.column(2).to_pylist(), t.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([t.column(0)[0].as_py()], pa.string()), pa.array([t.column(1)[0].as_py()], pa.int64()), pa.array([_summary_row(got)], _ARROW_SUMMARY)], ["_name", "_share", "_summary"])

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, s = (), State()
        for b in batches:
            out = []
            for n, x in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if name != (n,):
                    name, s = (n,), State()
                out.append(_state_row(s))
                s = carry(rules, s, _summary(x))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, _ARROW_STATE)], ["_name", "_share", "_before"])

    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _shares(batches):
            name, s = t.column(0)[0].as_py(), _state(t.column(4)[0].as_py()) or State()
            rows = t.slice(1)  # the state's own row comes first
            got, _ = read_share(rules, s, rows.column(2).to_numpy(), rows.column(3).to_numpy())
            columns = [pa.array([name] * len(got), pa.string()), *[pa.array([r[i] for r in got], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.int64(), pa.string()))]]
            yield pa.RecordBatch.from_arrays(columns, ["_name", "pulse_id", "event", "n_lost_pulses", "violation"])

    each = each.withColumn("_name", F.col("_name").cast("string"))
    made = each.repartition("_name", "_share").sortWithinPartitions("_name", "_share", "_pulse").mapInArrow(summaries, f"_name string, _share bigint, _summary {_SUMMARY}")
    states = made.repartition("_name").sortWithinPartitions("_name", "_share").mapInArrow(carried, f"_name string, _share bigint, _before {_STATE}")
    none = F.lit(None)
    rows = each.withColumn("_before", none.cast(_STATE)).union(states.select("_name", "_share", none.cast("bigint"), none.cast("bigint"), "_before"))
    dealt = rows.repartition("_name", "_share").sortWithinPartitions("_name", "_share", F.asc_nulls_first("_pulse"))
    return dealt.mapInArrow(events, "_name string, pulse_id bigint, event string, n_lost_pulses bigint, violation string").withColumnRenamed("_name", detector)


def sync_pulses(frames: DataFrame, n_modules: int, detector: str = "detector_name", **rules: int) -> DataFrame:
    """(detector, pulse_id, n_lost_pulses, violation): the aligned pulses of sync_events."""
    return sync_events(frames, n_modules, detector, **rules).where("event = 'aligned'").drop("event")


def sync_violations(frames: DataFrame, n_modules: int, detector: str = "detector_name", strict: bool = False, **rules: int) -> DataFrame:
    """(detector, pulse_id, violation): where modules went out of sync, first after each aligned pulse, also if they never
    align again. In strict mode the first is an error, as the synchroniser stops there."""
    bad = sync_events(frames, n_modules, detector, **rules).where("event <> 'aligned'").select(detector, "pulse_id", "violation")
    if not strict:
        return bad
    said = F.concat(F.lit("modules out of sync at pulse "), F.col("pulse_id").cast("string"))
    return bad.withColumn("violation", F.raise_error(said).cast("string"))
