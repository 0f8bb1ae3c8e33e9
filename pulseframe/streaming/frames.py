"""Packets to guarded frames in one stateful pass, and count windows (ST-1, ST-2, ST-7).

State per module is what is known of the open frame, the frame before it, and, if bytes are asked for, a map from packet
number to bytes for the open frame alone: a batch writes the packets that it leaves open, not the frame that they belong to.
A micro-batch is sorted by arrival and gone through in slices, so any split of the input gives the same frames as the batch
form, and what is held beside a module's rows of the batch, which are numbers in arrays, does not grow with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.pixels import placed
from ..schemas import MAX_PULSE_GAP, PACKETS, STATS_COUNT

_OPEN = "framenum bigint, last int, pulse bigint, rec bigint, n bigint, first bigint, frame_no bigint, seen binary"
_LAST = "pulse bigint, frame bigint"


#: Rows of a key's batch that are looked at together.
SLICE = 100_000


def _sorted(rows: Iterator[pd.DataFrame], by: str) -> Iterator[pd.DataFrame]:
    """A key's rows of a batch along `by`, in slices. They are held as arrays, bytes in Arrow's form."""
    parts: dict[str, list] = {}
    for pdf in rows:
        for c in pdf.columns:
            x = pdf[c]
            parts.setdefault(c, []).append(pa.array(x) if x.dtype == object else x.to_numpy(copy=True))
    held = {}
    for c in list(parts):
        own = parts.pop(c)
        held[c] = pa.chunked_array(own).combine_chunks() if isinstance(own[0], pa.Array) else np.concatenate(own)
        del own
    if not held:
        return
    order = np.argsort(held[by], kind="stable")
    for at in range(0, len(order), SLICE):
        own = order[at : at + SLICE]
        yield pd.DataFrame({c: x.take(pa.array(own)).to_pandas() if isinstance(x, pa.Array | pa.ChunkedArray) else x[own] for c, x in held.items()})


def _flagged(frames: pd.DataFrame, last, max_gap: int, allow_repeat: bool) -> pd.Series:  # noqa: ANN001
    """Which of a module's frames (pulse, framenum) are out of sequence; last: the state of the frame before, which is set."""
    pulse, frame = last.get() if last.exists() else (0, 0)
    step = frames.pulse - frames.pulse.shift(1, fill_value=pulse)
    low = step < 0 if allow_repeat else step <= 0
    last.update((int(frames.pulse.iloc[-1]), int(frames.framenum.iloc[-1])))
    return (frames.framenum != frames.framenum.shift(1, fill_value=frame) + 1) | low | (step > max_gap)


class _Frames(StatefulProcessor):
    """Puts packets together and flags frames out of sequence."""

    def __init__(self, keys: tuple[str, ...], expected: int, dialect: int, max_gap: int, allow_repeat: bool, packet_bytes: int, silent_ms: int, emit_open: bool):
        self.keys, self.expected, self.dialect, self.max_gap, self.allow_repeat, self.packet_bytes = keys, expected, dialect, max_gap, allow_repeat, packet_bytes
        self.silent_ms, self.emit_open = silent_ms, emit_open

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open, self.last = handle.getValueState("open", _OPEN), handle.getValueState("last", _LAST)
        self.parts = handle.getMapState("parts", "packetnum int", "data binary") if self.packet_bytes else None

    def _bytes(self, own: pd.DataFrame | None, with_held: bool) -> bytes | None:
        """A frame's packets, each in its place of a zeroed buffer: those in state, and over them a batch's."""
        if not self.packet_bytes:
            return None
        out = bytearray(self.expected * self.packet_bytes)
        held = [(k[0], v[0]) for k, v in self.parts.iterator()] if with_held else []
        for n, x in [*held, *(zip(own.packetnum, own.data, strict=True) if own is not None else ())]:
            out[n * self.packet_bytes : n * self.packet_bytes + len(x)] = x
        return bytes(out)

    def _seen(self, own: pd.DataFrame, before: bytes | None) -> bytes:
        """Which packet numbers a frame has, a byte for each."""
        at = np.frombuffer(before or bytes(self.expected), np.uint8).copy()
        at[own.packetnum.to_numpy(np.int64)] = 1
        return at.tobytes()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        for pdf in _sorted(rows, "seq"):
            yield from self._slice(key, pdf[(pdf.packetnum >= 0) & (pdf.packetnum < self.expected)], timerValues)

    def _slice(self, key, pdf: pd.DataFrame, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N803
        if not len(pdf):
            return
        pdf = pdf.reset_index(drop=True)
        held = self.open.get() if self.open.exists() else None
        no, num, end = (held[6], held[0], held[1]) if held else (0, None, None)
        # where a frame starts: as in the batch form, with what came before the batch in front
        before_num, before_end = pdf.framenum.shift(1), pdf.packetnum.shift(1)
        if num is not None:
            before_num.iloc[0], before_end.iloc[0] = num, end
        new = before_num.isna() | (before_num != pdf.framenum) | (before_end == self.expected - 1)
        pdf["frame_no"] = no + new.cumsum()
        by = pdf.groupby("frame_no", sort=True)
        meta = by.first() if self.dialect == 1 else by.last()
        frames = pd.DataFrame({"framenum": meta.framenum, "last": by.packetnum.last(), "pulse": meta.pulse_id, "rec": meta.debug, "n": by.size(), "first": by.seq.first(), "distinct": by.packetnum.nunique()})
        goes_on = held is not None and frames.index[0] == no
        tail_no, is_open = frames.index[-1], frames["last"].iloc[-1] != self.expected - 1
        tail = by.get_group(tail_no)
        if self.packet_bytes:
            # the open one's bytes are not put together before it is closed
            whole = pdf[pdf.frame_no < tail_no] if is_open else pdf
            made = frames.index[:-1] if is_open else frames.index
            flat = placed(np.searchsorted(made, whole.frame_no), whole.packetnum.to_numpy(np.int64), pa.array(whole.data, pa.binary()), len(made), self.expected, self.packet_bytes)
            each = [x.tobytes() for x in flat.reshape(len(made), self.expected * self.packet_bytes)]
            if made.size and goes_on:  # it has packets in state
                each[0] = self._bytes(by.get_group(no), True)
            frames["payload"] = [*each, None] if is_open else each
        else:
            frames["payload"] = None
        if goes_on:
            frames.loc[no, "distinct"] = sum(self._seen(by.get_group(no), held[7]))
            frames.loc[no, "n"] += held[4]
            frames.loc[no, "first"] = held[5]
            if self.dialect == 1:
                frames.loc[no, ["framenum", "pulse", "rec"]] = [held[0], held[2], held[3]]
        elif held and held[1] != self.expected - 1:  # else it was closed, and given, before
            before = [*held[:6], sum(held[7]), self._bytes(None, True)]
            frames = pd.concat([pd.DataFrame([before], index=[no], columns=["framenum", "last", "pulse", "rec", "n", "first", "distinct", "payload"]), frames])
        if self.packet_bytes:
            if not (goes_on and tail_no == no and is_open):
                self.parts.clear()
            if is_open:
                for n, x in zip(tail.packetnum, tail.data, strict=True):
                    self.parts.updateValue((int(n),), (bytes(x),))
        t = frames.loc[tail_no]
        seen = self._seen(tail, held[7] if goes_on and tail_no == no else None)
        self.open.update((int(pdf.framenum.iloc[-1]) if self.dialect == 2 else int(t.framenum), int(t["last"]), int(t.pulse), int(t.rec), int(t.n), int(t["first"]), int(tail_no), seen))
        if self.silent_ms:
            for at in self.handle.listTimers():
                self.handle.deleteTimer(at)
            if is_open:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silent_ms)
        yield from self._given(key, frames.iloc[:-1] if is_open else frames)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        """The module has been silent: its open frame is given as it is, or dropped; a packet that still comes starts another."""
        held = self.open.get()
        frame = pd.DataFrame([[*held[:6], sum(held[7]), self._bytes(None, True)]], columns=["framenum", "last", "pulse", "rec", "n", "first", "distinct", "payload"])
        self.open.update((held[0], self.expected - 1, *held[2:]))
        if self.packet_bytes:
            self.parts.clear()
        if self.emit_open:
            yield from self._given(key, frame)

    def _given(self, key: tuple, frames: pd.DataFrame) -> Iterator[pd.DataFrame]:
        done = frames[frames.pulse > 0]
        if not len(done):
            return
        bad = _flagged(done, self.last, self.max_gap, self.allow_repeat)
        out = pd.DataFrame({**dict(zip(self.keys, key, strict=True)), "seq": done["first"], "pulse_id": done.pulse, "frame_index": done.framenum, "daq_rec": done.rec, "n_recv_packets": done.n, "n_distinct_packets": done.distinct, "bad": bad})
        out = out.astype({c: "int64" for c in ("seq", "pulse_id", "frame_index", "daq_rec", "n_recv_packets", "n_distinct_packets")})
        yield out.assign(payload=done.payload) if self.packet_bytes else out

    def close(self) -> None:
        pass


_FRAME = "seq bigint, pulse_id bigint, frame_index bigint, daq_rec bigint, n_recv_packets bigint"


def _keyed(df: DataFrame, keys: tuple[str, ...]) -> tuple[list, str]:
    """The key columns, module numbers as int, and their part of a schema."""
    columns = [F.col(k).cast("int") if k == "module_id" else F.col(k) for k in keys]
    return columns, "".join(f"{f.name} {f.dataType.simpleString()}, " for f in df.select(*columns).schema.fields)


def stream_frames(packets: DataFrame, expected: int = PACKETS[1], dialect: int = 1, max_gap: int = MAX_PULSE_GAP, allow_repeat: bool = False, packet_bytes: int = 0, keys: tuple[str, ...] = ("module_id",), silent_ms: int = 0, emit_open: bool = False) -> DataFrame:
    """Frames with `bad` from a stream of packets (keys, seq, pulse_id, framenum, debug, packetnum). A frame comes out once
    something closes it; the open one stays in state. Both steps share the key, so there is one shuffle. With packet_bytes
    the packets' `data` travels along, and frames have a `payload`: each packet's bytes in its slot of a zeroed buffer, the
    last of duplicates.

    keys: what a module is told by, with a detector's name where a stream has several. silent_ms: a module that has sent
    nothing for so long (processing time, looked at when a batch runs) loses its open frame, or with emit_open gives it as
    it is."""
    key, kind = _keyed(packets, keys)
    rows = packets.select(*key, *[F.col(c).cast("bigint") for c in ("seq", "pulse_id", "framenum", "debug")], F.col("packetnum").cast("int"), *(["data"] if packet_bytes else []))
    schema = kind + _FRAME + ", n_distinct_packets bigint, bad boolean" + (", payload binary" if packet_bytes else "")
    made = _Frames(keys, expected, dialect, max_gap, allow_repeat, packet_bytes, silent_ms, emit_open)
    return rows.groupBy(*keys).transformWithStateInPandas(made, schema, "Append", "ProcessingTime" if silent_ms else "None")


class _Guard(StatefulProcessor):
    def __init__(self, keys: tuple[str, ...], max_gap: int, allow_repeat: bool):
        self.keys, self.max_gap, self.allow_repeat = keys, max_gap, allow_repeat

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _LAST)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        for pdf in _sorted(rows, "seq"):
            pdf["bad"] = _flagged(pdf.rename(columns={"pulse_id": "pulse", "frame_index": "framenum"}), self.last, self.max_gap, self.allow_repeat)
            yield pdf[[*self.keys, "seq", "pulse_id", "frame_index", "daq_rec", "n_recv_packets", "bad"]]

    def close(self) -> None:
        pass


def stream_guard(frames: DataFrame, max_gap: int = MAX_PULSE_GAP, allow_repeat: bool = False, keys: tuple[str, ...] = ("module_id",)) -> DataFrame:
    """The sequence guard alone, for a stream of frames."""
    key, kind = _keyed(frames, keys)
    rows = frames.select(*key, *[F.col(c).cast("bigint") for c in ("seq", "pulse_id", "frame_index", "daq_rec", "n_recv_packets")])
    return rows.groupBy(*keys).transformWithStateInPandas(_Guard(keys, max_gap, allow_repeat), kind + _FRAME + ", bad boolean", "Append", "None")


class _Counter(StatefulProcessor):
    def __init__(self, modulo: int):
        self.modulo = modulo

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "bucket bigint, n bigint, bad bigint, lost bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        for pdf in _sorted(rows, "pulse_id"):
            yield from self._slice(key, pdf)

    def _slice(self, key, pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        bucket, n, bad, lost = self.held.get() if self.held.exists() else (0, 0, 0, 0)
        at = (n + pdf.index) // self.modulo + bucket
        sums = pd.DataFrame({"n": 1, "bad": (~pdf.is_good_image).astype("int64"), "lost": pdf.n_lost_pulses}).groupby(at).sum()
        sums.loc[bucket, ["n", "bad", "lost"]] = sums.reindex([bucket], fill_value=0).loc[bucket] + [n, bad, lost]
        sums = sums.sort_index().astype("int64")
        open_ = sums.iloc[-1]
        self.held.update((int(sums.index[-1]), int(open_.n), int(open_.bad), int(open_.lost)) if open_.n < self.modulo else (int(sums.index[-1]) + 1, 0, 0, 0))
        full = sums[sums.n == self.modulo]
        if len(full):
            yield pd.DataFrame({"detector_name": key[0], "bucket": full.index.astype("int64"), "n_images": full.n, "n_corrupted_images": full.bad, "n_lost_pulses": full.lost})

    def close(self) -> None:
        pass


def stream_count_stats(images: DataFrame, modulo: int = STATS_COUNT) -> DataFrame:
    """Statistics of each full run of `modulo` images of a detector, for a stream with detector_name, pulse_id,
    is_good_image and n_lost_pulses whose pulses ascend from batch to batch."""
    rows = images.select("detector_name", F.col("pulse_id").cast("bigint"), "is_good_image", F.col("n_lost_pulses").cast("bigint"))
    return rows.groupBy("detector_name").transformWithStateInPandas(_Counter(modulo), "detector_name string, bucket bigint, n_images bigint, n_corrupted_images bigint, n_lost_pulses bigint", "Append", "None")
