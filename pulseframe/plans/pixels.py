"""Images with pixels out of the archive, without moving pixels (JN-3, SNK-3, JN-6).

The archive's layout is the partitioning: a file of pulses has a folder for each module, sorted by pulse. A task takes some
pulses of one file, opens the modules' folders by their path, reads them side by side and puts images together as it goes,
so no payload is ever shuffled. Folders are opened by the tasks: the archive must be on a path that all executors see.

Archive and export keep a digest of every payload, made when it is written. Verification compares digests, from metadata
alone, and reads bytes where these differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.images import module_spine, slots
from ..schemas import FILE_PULSES, FOLDER_PULSES, MODULE_BYTES, PACKETS
from ..sources.archive import read_archive, scan_pulse_range, write_archive
from .historical import aligned, check_range, images_in_range

#: Bytes of a batch of images; files of pulses, and bytes of their images, that a task takes.
BATCH_BYTES = 64 << 20
TASK_FILES, TASK_BYTES = 10, 256 << 20
#: What stands for a module without a frame in an image's digest.
ABSENT = "-"

_META = ["seq", "pulse_id", "frame_index", "daq_rec", "n_recv_packets"]
IMAGES = "requested_pulse_id bigint, pulse_id bigint, frame_index bigint, daq_rec bigint, is_good_frame int, write_index bigint, image binary, digest string"


def write_pixel_archive(frames: DataFrame, path: str) -> None:
    """write_archive() for frames with a `payload`, whose SHA-256 is kept beside it as `digest`."""
    write_archive(frames.withColumn("digest", F.sha2("payload", 256)), path)


def image_digest(digests: list[str | None]) -> str:
    """Of an image: that of its modules' digests, in their order."""
    return hashlib.sha256(",".join([d or ABSENT for d in digests]).encode()).hexdigest()


def _image_digest(n_modules: int, slot: str) -> Column:
    return F.sha2(F.concat_ws(",", *[F.coalesce(F.col(slot.format(m)), F.lit(ABSENT)) for m in range(n_modules)]), 256)


def _frames(path: str, module: int, low: int, high: int, rows: int) -> Iterator[dict]:
    """A module's frames of the pulses low .. high, all of one file, in order. Only the row groups that may hold them are
    read, so many rows at a time."""
    folder = f"{path}/module_id={module}/folder_base={low // FOLDER_PULSES * FOLDER_PULSES}/file_base={low // FILE_PULSES * FILE_PULSES}"
    system, at = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
    if system.get_file_info(at).type != fs.FileType.Directory:
        return
    table = ds.dataset(at, format="parquet", filesystem=system, exclude_invalid_files=False)
    batches = table.to_batches(columns=[*_META, "payload"], filter=(ds.field("pulse_id") >= low) & (ds.field("pulse_id") <= high), batch_size=rows, batch_readahead=1, fragment_readahead=1)
    for b in batches:
        yield from b.to_pylist()


def archive_images(spark: SparkSession, path: str, n_modules: int, start: int, stop: int, step: int = 1, expected: int = PACKETS[1], check_daq_rec: bool = True, align: bool = False, payload: int = MODULE_BYTES) -> DataFrame:
    """(IMAGES): one row for each pulse on the step grid from start to stop, with its image: the modules' payloads one after
    the other, `payload` bytes each, zeros for a module without a frame; incomplete frames' pixels stay. Metadata is that of
    export_rows(). digest is that of the bytes as they were read."""
    if align:
        start, stop = aligned(start, stop, step)
    check_range(start, stop, step)
    first, last = start // FILE_PULSES, stop // FILE_PULSES
    chunk = max(1, BATCH_BYTES // (n_modules * payload))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in b.column(0).to_pylist():
                low, high = max(start, block * FILE_PULSES), min(stop, (block + 1) * FILE_PULSES - 1)
                modules = [_frames(path, m, low, high, chunk) for m in range(n_modules)]
                heads = [next(it, None) for it in modules]
                rows: list[tuple] = []
                for pulse in range(-(-low // step) * step, high + 1, step):
                    held: list[dict | None] = []
                    for m, it in enumerate(modules):
                        while heads[m] is not None and heads[m]["pulse_id"] < pulse:
                            heads[m] = next(it, None)
                        held.append(heads[m] if heads[m] is not None and heads[m]["pulse_id"] == pulse else None)
                    rows.append(_image(pulse, held, (pulse - start) // step))
                    if len(rows) == chunk:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def _image(pulse: int, held: list[dict | None], index: int) -> tuple:
        whole = [h for h in held if h and h["n_recv_packets"] == expected]
        alike = len({h["frame_index"] for h in whole}) == 1 and (not check_daq_rec or len({h["daq_rec"] for h in whole}) == 1)
        meta = whole[0] if whole else {"frame_index": 0, "daq_rec": 0}
        own = [None if h is None else (h["payload"] or b"")[:payload].ljust(payload, b"\0") for h in held]
        digest = image_digest([None if h is None else hashlib.sha256(h["payload"] or b"").hexdigest() for h in held])
        there = any(h is not None for h in held)
        return pulse, pulse if there else 0, meta["frame_index"], meta["daq_rec"], int(len(whole) == n_modules and alike), index, b"".join([bytes(payload) if x is None else x for x in own]), digest

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [c.split(" ")[0] for c in IMAGES.split(", ")])

    # a task takes whole files of pulses, each opened once, and several where images are small: numbers only are dealt out
    n_files, several = last + 1 - first, max(1, min(TASK_FILES, TASK_BYTES // (n_modules * payload * FILE_PULSES)))
    blocks = spark.range(first, last + 1, 1, max(min(n_files, 4 * spark.sparkContext.defaultParallelism), -(-n_files // several)))
    return blocks.mapInArrow(run, IMAGES)


def export_pixels(spark: SparkSession, path: str, n_modules: int, start: int, stop: int, out: str, step: int = 1, expected: int = PACKETS[1], detector_name: str = "", align: bool = False, payload: int = MODULE_BYTES) -> None:
    """Writes images with pixels and general information as Parquet, replacing what is there: each task writes what it has
    read, in the order of pulses."""
    archive_images(spark, path, n_modules, start, stop, step, expected, align=align, payload=payload).write.mode("overwrite").parquet(f"{out}/images")
    general = [(detector_name, n_modules, start, stop, step)]
    spark.createDataFrame(general, "detector_name string, n_modules int, start bigint, stop bigint, step bigint").coalesce(1).write.mode("overwrite").parquet(f"{out}/general")


def image_lookup(spark: SparkSession, path: str, pulse_id: int, n_modules: int, expected: int = PACKETS[1], payload: int = MODULE_BYTES) -> DataFrame:
    """(IMAGES) of one pulse: its modules' folders alone are opened."""
    return archive_images(spark, path, n_modules, pulse_id, pulse_id, 1, expected, payload=payload)


def verify_pixels(export: DataFrame, spark: SparkSession, path: str, n_modules: int, expected: int = PACKETS[1], check_daq_rec: bool = True, payload: int = MODULE_BYTES, deep: bool = False) -> DataFrame:
    """(pulse_id, field, expected, got): what an export, as export_pixels() wrote it, has other than the archive: a row for
    each of frame_index, daq_rec and is_good_frame that differs, and where the digests differ, one for each module whose
    bytes do (their SHA-256; `-` for a module without a frame, whose bytes should be zeros) or, if all bytes are right, for
    the digest itself. deep: digests are made from the export's bytes anew, as after damage on a disk."""
    archive, zero = read_archive(spark, path), F.lit(0).cast("bigint")
    low, high = export.agg(F.min("requested_pulse_id"), F.max("requested_pulse_id")).first()
    low, high = (0, -1) if low is None else (low, high)
    part = scan_pulse_range(archive, low, high)
    images = images_in_range(archive, n_modules, low, max(low, high), 1, expected, check_daq_rec)
    # digests of the last write of each slot: no payload is read for these
    named = part.select("pulse_id", "module_id", "n_recv_packets", "daq_rec", F.col("digest").alias("frame_index"), *[c for c in ("seq",) if c in part.columns])
    digests = slots(named, n_modules, ("pulse_id",)).select("pulse_id", _image_digest(n_modules, "_m{}.frame_index").alias("_digest"))
    none = image_digest([None] * n_modules)
    right = images.join(digests, "pulse_id").select(F.col("pulse_id").alias("_pulse"), F.col("frame_index").alias("_frame_index"), F.col("daq_rec").alias("_daq_rec"), F.col("is_good_image").cast("int").alias("_is_good_frame"), "_digest")
    offsets = [m * payload + 1 for m in range(n_modules)]
    rows = export.select("requested_pulse_id", "frame_index", "daq_rec", "is_good_frame", "digest")
    both = rows.join(right, F.col("requested_pulse_id") == F.col("_pulse"), "left")
    said = lambda c: F.coalesce(F.col(f"_{c}"), zero.cast(rows.schema[c].dataType)).cast("string")
    fields = F.array(*[F.struct(F.lit(c).alias("field"), said(c).alias("expected"), F.col(c).cast("string").alias("got")) for c in ("frame_index", "daq_rec", "is_good_frame")])
    out = both.select(F.col("requested_pulse_id").alias("pulse_id"), F.explode(fields).alias("x")).select("pulse_id", "x.*").where("not (expected <=> got)")

    # the few images whose digests differ, byte by byte: these alone are read
    suspect = both.where(F.lit(True) if deep else ~F.col("digest").eqNullSafe(F.coalesce("_digest", F.lit(none)))).select("requested_pulse_id", "digest", F.coalesce("_digest", F.lit(none)).alias("_digest"))
    cut = [F.sha2(F.substring("image", at, payload), 256).alias(f"_g{m}") for m, at in enumerate(offsets)]
    got = export.select(F.col("requested_pulse_id").alias("_of"), F.octet_length("image").alias("_size"), *cut).join(suspect, F.col("_of") == F.col("requested_pulse_id"))
    spine = module_spine(suspect.select(F.col("requested_pulse_id").alias("pulse_id")), n_modules)
    filled = F.sha2(F.rpad(F.substring("payload", 1, payload), payload, F.lit(b"\0")), 256)
    own = spine.join(part.select("pulse_id", "module_id", filled.alias("_e")), ["pulse_id", "module_id"], "left")
    empty = hashlib.sha256(bytes(payload)).hexdigest()
    wanted = own.groupBy("pulse_id").agg(*[F.coalesce(F.max(F.when(F.col("module_id") == m, F.col("_e"))), F.lit(empty)).alias(f"_e{m}") for m in range(n_modules)], *[F.bool_or((F.col("module_id") == m) & F.col("_e").isNotNull()).alias(f"_t{m}") for m in range(n_modules)])
    met = got.join(wanted, F.col("_of") == F.col("pulse_id"))
    wrong = [F.col(f"_g{m}") != F.col(f"_e{m}") for m in range(n_modules)]
    each = [F.when(wrong[m], F.struct(F.lit(f"module {m}").alias("field"), F.when(F.col(f"_t{m}"), F.col(f"_e{m}")).otherwise(ABSENT).alias("expected"), F.col(f"_g{m}").alias("got"))) for m in range(n_modules)]
    size = F.when(F.col("_size") != n_modules * payload, F.struct(F.lit("n_bytes").alias("field"), F.lit(str(n_modules * payload)).alias("expected"), F.col("_size").cast("string").alias("got")))
    right_bytes = ~wrong[0]
    for w in wrong[1:]:
        right_bytes = right_bytes & ~w
    stale = F.when(right_bytes & ~F.col("digest").eqNullSafe(F.col("_digest")), F.struct(F.lit("digest").alias("field"), F.col("_digest").alias("expected"), F.col("digest").alias("got")))
    bytes_ = met.select("pulse_id", F.explode(F.array_compact(F.array(*each, size, stale))).alias("x")).select("pulse_id", "x.*")
    return out.unionByName(bytes_)
