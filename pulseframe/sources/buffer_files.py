"""Bulk load of fixed-record frame files (SRC-3), and the files themselves.

A file holds 1000 records of one module, one for each pulse, at fixed places, and one byte more at its end. Tasks list the
tree, a folder each; what is there and in the range is cut into blocks of records, which are dealt into partitions by their
bytes. So partitions follow the files that exist, and the driver learns their number only. Files are opened by the tasks, so
the root must be a path that all executors see.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import running_sum
from ..schemas import BLOCK_PULSES, FILE_PULSES, FOLDER_PULSES, MARKER, MODULE_BYTES
from .staging import fresh_path

SCHEMA = "module_id int, pulse_id bigint, frame_index bigint, daq_rec bigint, n_recv_packets bigint, payload binary"

# A record's layout.
_META = [("marker", "u1"), ("pulse_id", "<u8"), ("frame_index", "<u8"), ("daq_rec", "<u8"), ("n_recv_packets", "<u8"), ("module_id", "<u8")]
#: Bytes of payload in an Arrow batch; bytes of records that a partition reads; folders that a task lists.
BATCH_BYTES, PART_BYTES, FOLDERS = 16 << 20, 128 << 20, 2048


def record_dtype(payload: int = MODULE_BYTES) -> np.dtype:
    return np.dtype([*_META, ("payload", f"V{payload}")])


def _local(root: str) -> str:
    """A root as tasks open it."""
    return root.removeprefix("file://") if root.startswith("file:///") else root.removeprefix("file:")


def folder_path(root: str, module: int, pulse: int) -> str:
    return f"{_local(root)}/M{module:02d}/{pulse // FOLDER_PULSES * FOLDER_PULSES}"


def file_path(root: str, module: int, pulse: int) -> str:
    return f"{folder_path(root, module, pulse)}/{pulse // FILE_PULSES * FILE_PULSES}.bin"


def list_buffer_files(spark: SparkSession, root: str, n_modules: int, start: int, stop: int) -> DataFrame:
    """(module_id, file_base, n_bytes) of the files that may hold pulses start .. stop. A row is made for each folder that the
    range could have, and tasks look which of them exist."""
    first, n_folders = start // FOLDER_PULSES, stop // FOLDER_PULSES - start // FOLDER_PULSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for i in b.column(0).to_pylist():
                module, pulse = i % n_modules, (first + i // n_modules) * FOLDER_PULSES
                try:
                    with os.scandir(folder_path(root, module, pulse)) as there:
                        files = [(e.name.removesuffix(".bin"), e.stat().st_size) for e in there if e.name.endswith(".bin")]
                except FileNotFoundError:
                    continue
                found += [(module, int(name), size) for name, size in files if name.isdigit() and int(name) <= stop and int(name) + FILE_PULSES > start]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))], ["module_id", "file_base", "n_bytes"])

    n = max(0, n_folders) * n_modules
    folders = spark.range(0, n, 1, max(1, -(-n // FOLDERS)))
    return folders.mapInArrow(run, "module_id int, file_base bigint, n_bytes bigint")


def _blocks(files: DataFrame, start: int, stop: int, record: int) -> DataFrame:
    """(module_id, file_base, first, last): the records of each file in the range, block by block."""
    first = F.greatest(F.lit(start) - F.col("file_base"), F.lit(0))
    last = F.least(F.lit(stop) - F.col("file_base"), F.floor(F.col("n_bytes") / record) - 1, F.lit(FILE_PULSES - 1))
    low: Column = F.floor(first / BLOCK_PULSES)
    each = files.withColumns({"_first": first, "_last": last}).where("_last >= _first").withColumn("_block", F.explode(F.sequence(low, F.floor(F.col("_last") / BLOCK_PULSES))))
    at = F.col("_block") * BLOCK_PULSES
    return each.select("module_id", "file_base", F.greatest(at, "_first").alias("first"), F.least(at + BLOCK_PULSES - 1, "_last").alias("last"))


def import_buffer_files(spark: SparkSession, root: str, n_modules: int, start: int, stop: int, payload: int = MODULE_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """The frames that stand in the files for the pulses start .. stop; slots never written, and records cut short, are left
    out. A range without files gives no rows."""
    record = record_dtype(payload)
    held = fresh_path(spark, "listing")
    _blocks(list_buffer_files(spark, root, n_modules, start, stop), start, stop, record.itemsize).write.parquet(held)
    # positions along (module, file, block), in bytes; a module's folder is a share of them
    blocks = spark.read.parquet(held).withColumns({"_bytes": (F.col("last") - F.col("first") + 1) * record.itemsize, "_share": F.struct("module_id", F.floor(F.col("file_base") / FOLDER_PULSES)), "_order": F.struct("module_id", "file_base", "first")})
    dealt = running_sum(blocks, "_bytes", "_upto", "_order").withColumn("_part", F.floor((F.col("_upto") - F.col("_bytes")) / part_bytes).cast("int"))
    n_parts = (blocks.agg(F.sum("_bytes")).first()[0] or 0) // part_bytes + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["pulse_id", "frame_index", "daq_rec", "n_recv_packets"]
        step = max(1, BATCH_BYTES // record.itemsize)
        for b in batches:
            for module, base, first, last in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with open(file_path(root, module, base), "rb") as file:
                    for at in range(first, last + 1, step):
                        n = min(step, last + 1 - at)
                        file.seek(at * record.itemsize)
                        raw = file.read(n * record.itemsize)
                        rows = np.frombuffer(raw[: len(raw) // record.itemsize * record.itemsize], record)
                        rows = rows[(rows["marker"] == MARKER) & (rows["pulse_id"] >= start) & (rows["pulse_id"] <= stop)]
                        if len(rows):
                            columns = [pa.array(np.full(len(rows), module, np.int32)), *[pa.array(rows[c].astype(np.int64)) for c in names], pa.array([x.tobytes() for x in rows["payload"]], pa.binary())]
                            yield pa.RecordBatch.from_arrays(columns, ["module_id", *names, "payload"])

    part = dealt.repartitionById(n_parts, "_part").sortWithinPartitions("module_id", "file_base", "first")
    return part.select("module_id", "file_base", "first", "last").mapInArrow(run, SCHEMA)


def write_buffer_files(frames: DataFrame, root: str, payload: int = MODULE_BYTES) -> int:
    """Writes frames (module_id, pulse_id, frame_index, daq_rec, n_recv_packets, payload) as files, a task for each file at a
    time, and gives their number. A file is written beside its place and then moved, so that a task that runs twice leaves
    one; slots without a frame stay unmarked, of several frames of a slot the last counts, and payloads are cut or filled up
    with zeros."""
    record = record_dtype(payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, key, done = None, None, []

        def close() -> None:
            if file is not None:
                file.truncate(FILE_PULSES * record.itemsize + 1)
                file.close()
                os.replace(file.name, file_path(root, *key))
                done.append(key[1])

        for b in batches:
            for module, pulse, *rest, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != (module, pulse // FILE_PULSES * FILE_PULSES):
                    close()
                    key = (module, pulse // FILE_PULSES * FILE_PULSES)
                    os.makedirs(folder_path(root, module, pulse), exist_ok=True)
                    file = open(f"{file_path(root, *key)}.{uuid.uuid4().hex}", "wb")  # noqa: SIM115
                file.seek(pulse % FILE_PULSES * record.itemsize)
                file.write(np.array((MARKER, pulse, *rest, module, (data or b"")[:payload].ljust(payload, b"\0")), record).tobytes())
        close()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], ["file_base"])

    order = [F.col(c) for c in ("seq",) if c in frames.columns]
    base = F.floor(F.col("pulse_id") / FILE_PULSES)
    rows = frames.where("pulse_id >= 0 and module_id >= 0").repartition("module_id", base).sortWithinPartitions("module_id", base, "pulse_id", *order)
    return rows.select("module_id", "pulse_id", "frame_index", "daq_rec", "n_recv_packets", "payload").mapInArrow(run, "file_base bigint").count()
