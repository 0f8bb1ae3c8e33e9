"""The assembler on a stream of frames: aligned images in order, each with what was lost on the way to it (AGG-8, AGG-9, JN-1).

Two stateful steps. The first holds the slots of pulses that the watermark has not passed yet and folds images from them, as
stream_images() does, spread over all tasks by pulse; frames may come in any order and any split within the skew, those behind
the watermark are dropped. What it gives, one row a pulse, is final and comes in ascending batches. The second is the
synchroniser: a detector's pulses in their order, slice by slice, from the few numbers that it holds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.images import fold, slots
from ..operators.sync import MOST_MODULES, Rules, State, read_share
from ..schemas import PACKETS, PULSE_MS, SYNC_OFFSET, SYNC_ROUNDS
from .images import SKEW, with_event_time

#: Pulses that are read at a time; the first pulse whose time has no place in a column of nanoseconds.
SLICE, NO_TIME = 50_000, 900_000_000_000
_SLOT = ("pulse_id", "module_id", "seq", "n_recv_packets", "frame_index", "daq_rec")
_PULSE = np.dtype([(c, "<i8") for c in ("pulse_id", "held", "frame_index", "daq_rec", "is_good_image")])


class _Sync(StatefulProcessor):
    def __init__(self, rules: Rules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sync = handle.getValueState("sync", "state string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        parts = []
        for pdf in rows:
            part = np.zeros(len(pdf), _PULSE)
            for c in _PULSE.names:
                part[c] = pdf[c].to_numpy()
            parts.append(part)
        got = np.concatenate(parts) if parts else np.zeros(0, _PULSE)
        del parts
        order = np.argsort(got["pulse_id"])
        s = _loaded(self.sync.get()[0]) if self.sync.exists() else State()
        for at in range(0, len(got), SLICE):
            out, s = self._events(key[0], s, got[order[at : at + SLICE]])
            if len(out):
                yield out
        self.sync.update((_dumped(s),))

    def _events(self, name: str | None, s: State, rows: np.ndarray) -> tuple[pd.DataFrame, State]:
        events, s = read_share(self.rules, s, rows["pulse_id"], rows["held"])
        out = pd.DataFrame(sorted(events, key=lambda e: (e[0], e[1] == "aligned")), columns=["pulse_id", "event", "n_lost_pulses", "violation"])
        image = rows[np.searchsorted(rows["pulse_id"], out.pulse_id.to_numpy(np.int64))]
        kinds = {"frame_index": "Int64", "daq_rec": "Int64", "is_good_image": "boolean"}
        for c, kind in kinds.items():
            out[c] = pd.array(image[c].astype(bool) if kind == "boolean" else image[c], kind)
        out.loc[out.event != "aligned", list(kinds)] = pd.NA
        out["n_lost_pulses"] = out.n_lost_pulses.astype("Int64")
        out.insert(0, "detector_name", name)
        out["event_time"] = pd.to_datetime(out.pulse_id * PULSE_MS, unit="ms")
        return out[["detector_name", "pulse_id", "event_time", "event", "n_lost_pulses", "violation", "frame_index", "daq_rec", "is_good_image"]], s

    def close(self) -> None:
        pass


def _dumped(s: State) -> str:
    return json.dumps([list(s.first.items()), list(s.seen.items()), s.lost, s.moves, s.wrong])


def _loaded(text: str) -> State:
    first, seen, *rest = json.loads(text)
    return State(dict(first), dict(seen), *rest)


_EVENTS = "detector_name string, pulse_id bigint, event_time timestamp, event string, n_lost_pulses bigint, violation string, frame_index bigint, daq_rec bigint, is_good_image boolean"


def stream_sync(frames: DataFrame, n_modules: int, expected: int = PACKETS[1], check_daq_rec: bool = True, limit: int = SYNC_OFFSET, rounds: int = SYNC_ROUNDS, delay: str = SKEW) -> DataFrame:
    """(detector_name, pulse_id, event_time, event, n_lost_pulses, violation, frame_index, daq_rec, is_good_image) from a
    stream of accepted frames with detector_name: the events of sync_events(), and with each aligned one its image, in the
    order of pulses for each detector. Of several frames of a module's slot the last written counts; modules beyond the last,
    null pulses and those from NO_TIME on are dropped."""
    if n_modules > MOST_MODULES:
        raise ValueError(f"at most {MOST_MODULES} modules, not {n_modules}")
    rows = frames.where(F.col("module_id").between(0, n_modules - 1) & (F.col("pulse_id") < NO_TIME))
    rows = with_event_time(rows.select("detector_name", *[F.col(c).cast("bigint").alias(c) for c in _SLOT]), delay)
    keys = ("event_time", "detector_name", "pulse_id")
    held = F.lit(0).cast("bigint")
    for m in range(n_modules):
        held = held + F.when(F.col(f"_m{m}").isNotNull(), F.lit(1 << m).cast("bigint")).otherwise(0)
    pulses = fold(slots(rows, n_modules, keys).withColumn("held", held), n_modules, (*keys, "held"), expected, check_daq_rec)
    pulses = pulses.select("detector_name", "pulse_id", "held", "frame_index", "daq_rec", F.col("is_good_image").cast("bigint").alias("is_good_image"))
    return pulses.groupBy("detector_name").transformWithStateInPandas(_Sync(Rules(n_modules, limit, rounds)), _EVENTS, "Append", "None")


def stream_assembler(frames: DataFrame, n_modules: int, strict: bool = False, **options: object) -> DataFrame:
    """(detector_name, pulse_id, event_time, frame_index, daq_rec, is_good_image, n_lost_pulses): the aligned images of
    stream_sync(), as an assembler sends them on. In strict mode it stops where modules go out of sync."""
    events = stream_sync(frames, n_modules, **options)
    if strict:
        said = F.concat(F.lit("modules out of sync at pulse "), F.col("pulse_id").cast("string"))
        events = events.withColumn("event", F.when(F.col("event") == "aligned", F.col("event")).otherwise(F.raise_error(said).cast("string")))
    return events.where("event = 'aligned'").select("detector_name", "pulse_id", "event_time", "frame_index", "daq_rec", "is_good_image", "n_lost_pulses")
