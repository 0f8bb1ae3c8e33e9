"""Bytes and pixels: bulk decoding of datagrams, payload assembly, image stacking (SRC-2, PRJ-19 .. PRJ-21)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.frames import valid_datagram
from ..schemas import PACKET_BYTES, PACKETS

# Little-endian layout of a datagram.
_HEADER = [("framenum", "<u8"), ("exptime", "<u4"), ("packetnum", "<u4"), ("bunchid", "<f8"), ("timestamp", "<u8"), ("module_id", "<u2"), ("x_coord", "<u2"), ("y_coord", "<u2"), ("z_coord", "<u2"), ("debug", "<u4"), ("round_robin", "<u2"), ("detector_type", "u1"), ("header_version", "u1")]
_TO = {"<u8": "int64", "<u4": "int64", "<f8": "float64", "<i8": "int64", "<u2": "int32", "u1": "int16"}
#: Bytes of payloads that a task puts together at a time.
BUFFER_BYTES = 32 << 20
_SQL = {"int64": "bigint", "int32": "int", "int16": "smallint", "float64": "double"}


def datagram_dtype(dialect: int = 1) -> np.dtype:
    header = [(n, "<i8" if n == "bunchid" and dialect == 2 else t) for n, t in _HEADER]
    return np.dtype([*header, ("data", f"V{PACKET_BYTES}")])


def flat_bytes(data: pa.Array) -> tuple[memoryview | pa.Buffer, np.ndarray]:
    """The bytes of a binary column one after the other, and where each value begins and the last ends: no copies."""
    data = data.cast(pa.large_binary())
    ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1] if len(data) else np.zeros(1, np.int64)
    return data.buffers()[2] or pa.py_buffer(b""), ends


def _binary(flat: np.ndarray, n: int, size: int) -> pa.Array:
    """n values of `size` bytes each, which lie one after the other."""
    ends = pa.array(np.arange(n + 1, dtype=np.int64) * size)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, ends.buffers()[1], pa.py_buffer(flat)]).cast(pa.binary())


def decode_packets(df: DataFrame, raw_col: str = "raw", dialect: int = 1, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """One row for each datagram of the right size, its header fields and payload; others are dropped before Python."""
    dtype = datagram_dtype(dialect)
    fields = [(n, _TO[dtype[n].str if dtype[n].str != "|u1" else "u1"]) for n in dtype.names if n != "data"]
    fields = [(n, "int32" if n == "packetnum" else t) for n, t in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, ends = flat_bytes(b.column(b.num_columns - 1))
            rows = np.frombuffer(flat[int(ends[0]) : int(ends[-1])], dtype)
            columns = [pa.array(np.ascontiguousarray(rows[n]).astype(t)) for n, t in fields]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *columns, _binary(np.ascontiguousarray(rows["data"]).view(np.uint8), len(rows), PACKET_BYTES)], [*keep, *[n for n, _ in fields], "data"])

    kept = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keep)
    schema = ", ".join(x for x in (kept, ", ".join(f"{n} {_SQL[t]}" for n, t in fields), "data binary") if x)
    return valid_datagram(df, raw_col).select(*keep, raw_col).mapInArrow(run, schema)


def payload_array(packets: Column | str, expected: int, size: int, packetnum: str = "packetnum", data: str = "data") -> Column:
    """Small payloads: an array of structs (packetnum, data array) in arrival order becomes one array of expected*size
    elements. The last of duplicates wins; a missing packet is zeros."""
    col = F.col(packets) if isinstance(packets, str) else packets
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(expected - 1)), lambda i: F.coalesce(F.try_element_at(F.filter(col, lambda p: p[packetnum] == i), F.lit(-1))[data], F.array_repeat(F.lit(0), size))))


def assemble_payload(packets: DataFrame, keys: list[str], expected: int = PACKETS[1], packet_bytes: int = PACKET_BYTES) -> DataFrame:
    """(keys, payload binary) from packets with seq, packetnum and data: each packet's bytes in its slot of a zeroed
    buffer, the last of duplicates over those before. Packets are dealt by key and sorted, and a task puts its frames together
    as they come, batch by batch; it holds the buffers of BUFFER_BYTES of frames at a time, and the open one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the packets of the frame that the last batch ended in
        for b in batches:
            b = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            new[0] = True
            for i in range(len(keys)):
                x, y = b.column(i).slice(1), b.column(i).slice(0, b.num_rows - 1)
                same = pc.fill_null(pc.equal(x, y), False)
                new[1:] |= ~pc.or_(same, pc.and_(pc.is_null(x), pc.is_null(y))).to_numpy(zero_copy_only=False)
            first = np.nonzero(new)[0]
            held = b.slice(int(first[-1]))
            yield from made(b, first)
        if held is not None:
            yield from made(held, np.array([0, held.num_rows]))

    def made(b: pa.RecordBatch, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The frames that start at first[:-1]; the last ends before first[-1]."""
        step = max(1, BUFFER_BYTES // (expected * packet_bytes))
        for at in range(0, len(first) - 1, step):
            cuts = first[at : at + step + 1]
            part = b.slice(int(cuts[0]), int(cuts[-1] - cuts[0]))
            flat = placed(np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), part.column(len(keys)).to_numpy(zero_copy_only=False), part.column(len(keys) + 1), len(cuts) - 1, expected, packet_bytes)
            starts = pa.array(cuts[:-1] - cuts[0])
            yield pa.RecordBatch.from_arrays([*[part.column(i).take(starts) for i in range(len(keys))], _binary(flat, len(cuts) - 1, expected * packet_bytes)], [*keys, "payload"])

    kept = ", ".join(f"{k} {packets.schema[k].dataType.simpleString()}" for k in keys)
    dealt = packets.select(*keys, F.coalesce(F.col("packetnum").cast("bigint"), F.lit(-1)).alias("packetnum"), F.coalesce("data", F.lit(b"")).alias("data"), "seq")
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "seq").drop("seq").mapInArrow(run, f"{kept}, payload binary")


def placed(frame: np.ndarray, packetnum: np.ndarray, data: pa.Array, n_frames: int, expected: int, packet_bytes: int) -> np.ndarray:
    """The bytes of n_frames zeroed buffers, one after the other, with packets' data in their slots: frame says which frame a
    packet is of. Packets come in order, so that the last of duplicates is written last; other packet numbers have no slot,
    and no data goes beyond its slot."""
    out = np.zeros((n_frames * expected, packet_bytes), np.uint8)
    flat, ends = flat_bytes(data)
    flat, sizes = np.frombuffer(flat, np.uint8), np.diff(ends)
    own = (packetnum >= 0) & (packetnum < expected)
    at = frame * expected + packetnum
    if (sizes == packet_bytes).all():
        # of places that come again the last counts
        rows = flat[int(ends[0]) : int(ends[-1])].reshape(len(frame), packet_bytes)
        out[at[own]] = rows if own.all() else rows[own]
    else:
        for i in np.nonzero(own)[0].tolist():
            n = min(int(sizes[i]), packet_bytes)
            out[at[i], :n] = flat[ends[i] : ends[i] + n]
    return out.reshape(-1)


def stack_modules(frames: DataFrame, n_modules: int, size: int, key: str = "pulse_id", data: str = "pixels", zero: Column | None = None) -> DataFrame:
    """(key, image): the modules' arrays one below the other in module order; a missing module is zeros."""
    zeros = F.array_repeat(zero if zero is not None else F.lit(0.0).cast("float"), size)
    held = frames.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("module_id").cast("int"), data)))).alias("_m"))
    spine = F.sequence(F.lit(0), F.lit(n_modules - 1))
    return held.select(key, F.flatten(F.transform(spine, lambda i: F.coalesce(F.try_element_at("_m", i), zeros))).alias("image"))


def stack_binary(frames: DataFrame, n_modules: int, module_bytes: int, key: str = "pulse_id", data: str = "payload") -> DataFrame:
    """As stack_modules, for binary payloads: one buffer of n_modules * module_bytes bytes."""

    def place(frame: pa.Table) -> pa.Table:
        out = bytearray(n_modules * module_bytes)
        for m, d in zip(frame["module_id"].to_pylist(), frame[data].to_pylist(), strict=True):
            if 0 <= m < n_modules and d is not None:
                out[m * module_bytes : m * module_bytes + len(d)] = d
        return pa.table({key: frame[key].slice(0, 1), "image": pa.array([bytes(out)], pa.binary())})

    return frames.select(key, "module_id", data).groupBy(key).applyInArrow(place, f"{key} {frames.schema[key].dataType.simpleString()}, image binary")


def pixels(df: DataFrame, payload: str = "payload", bits: int = 16, out: str = "pixels") -> DataFrame:
    """df with the payload's bytes as unsigned numbers."""
    kind = {8: ("u1", "smallint"), 16: ("<u2", "int"), 32: ("<u4", "bigint")}.get(bits)
    if kind is None:
        raise ValueError(f"no pixel type of {bits} bits")
    wide = {"smallint": np.int16, "int": np.int32, "bigint": np.int64}[kind[1]]
    size = bits // 8

    @F.arrow_udf(f"array<{kind[1]}>")
    def read(data: pa.Array) -> pa.Array:
        """A batch's payloads lie one after the other: they are read at once, and told apart by their offsets."""
        data = data.cast(pa.large_binary())
        ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
        if (np.diff(ends) % size).any():
            raise ValueError(f"a payload is no whole number of pixels of {bits} bits")
        flat = np.frombuffer((data.buffers()[2] or pa.py_buffer(b""))[int(ends[0]) : int(ends[-1])], kind[0]).astype(wide)
        return pa.ListArray.from_arrays(pa.array(((ends - ends[0]) // size).astype(np.int32)), pa.array(flat), mask=data.is_null())

    return df.withColumn(out, read(F.col(payload)))
