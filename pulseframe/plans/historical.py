"""Historical images: range queries, range exports, verification (SRT-1, SNK-3, JN-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import file_base
from ..operators.frames import accepted_in_range, pulse_step
from ..operators.images import assemble_images, attach_pixels, reconcile
from ..operators.ordering import running_index
from ..schemas import BLOCK_PULSES, MAX_PULSE_GAP, PACKETS
from ..sources.archive import scan_pulse_range


def aligned(start: int, stop: int, step: int) -> tuple[int, int]:
    return -(-start // step) * step, stop // step * step


def check_range(start: int, stop: int, step: int) -> int:
    """The number of pulses on the grid, or ValueError for a range that the writer would refuse."""
    if stop < start:
        raise ValueError("the stop is before the start")
    if BLOCK_PULSES % step:
        raise ValueError(f"the step does not divide {BLOCK_PULSES}")
    if start % step or stop % step:
        raise ValueError("the range is not on the step grid")
    return 1 + stop // step - start // step


def images_in_range(frames: DataFrame, n_modules: int, start: int, stop: int, step: int = 1, expected: int = PACKETS[1], check_daq_rec: bool = True, align: bool = True) -> DataFrame:
    """The images of the pulses start .. stop on the step grid, with quality flags. Range and step are applied to frames,
    before the one shuffle; no pixels are touched."""
    if align:
        start, stop = aligned(start, stop, step)
    check_range(start, stop, step)
    return assemble_images(pulse_step(scan_pulse_range(frames, start, stop), step), n_modules, expected, check_daq_rec)


def guarded_images(frames: DataFrame, n_modules: int, start: int, stop: int, step: int = 1, expected: int = PACKETS[1], max_gap: int = MAX_PULSE_GAP) -> DataFrame:
    """As images_in_range, for frames straight from the receivers: those out of sequence are dropped first. The guard sees
    what arrived around the range only."""
    start, stop = aligned(start, stop, step)
    return images_in_range(accepted_in_range(frames, start, stop, max_gap), n_modules, start, stop, step, expected)


def newest(frames: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, newest): the last pulse, combined before the shuffle."""
    return frames.groupBy(*keys).agg(F.max("pulse_id").alias("newest"))


def ordered(images: DataFrame) -> DataFrame:
    """Sorted by pulse over all partitions, as an export is read."""
    return images.repartitionByRange("pulse_id").sortWithinPartitions("pulse_id")


def export_rows(frames: DataFrame, n_modules: int, start: int, stop: int, step: int = 1, expected: int = PACKETS[1], check_daq_rec: bool = True, align: bool = False) -> DataFrame:
    """One row for each pulse on the step grid, those without frames too: requested_pulse_id, pulse_id (0 without a frame),
    frame_index, daq_rec, is_good_frame (0 or 1) and the write index."""
    if align:
        start, stop = aligned(start, stop, step)
    check_range(start, stop, step)
    spine = frames.sparkSession.range(start, stop + 1, step).withColumnRenamed("id", "requested_pulse_id")
    images = images_in_range(frames, n_modules, start, stop, step, expected, check_daq_rec)
    zero = F.lit(0).cast("bigint")
    rows = spine.join(images, F.col("requested_pulse_id") == F.col("pulse_id"), "left")
    return rows.select(
        "requested_pulse_id",
        F.coalesce("pulse_id", zero).alias("pulse_id"),
        F.coalesce("frame_index", zero).alias("frame_index"),
        F.coalesce("daq_rec", zero).alias("daq_rec"),
        F.coalesce(F.col("is_good_image").cast("int"), F.lit(0)).alias("is_good_frame"),
        # the grid is regular, so the index is arithmetic and needs no numbering
        ((F.col("requested_pulse_id") - start) / step).cast("bigint").alias("write_index"),
    )


def export_range(archive: DataFrame, n_modules: int, start: int, stop: int, out: str, step: int = 1, expected: int = PACKETS[1], detector_name: str = "", payload: DataFrame | None = None) -> None:
    """Writes images, pixels (if payloads by pulse are given) and general information as Parquet, replacing what is there."""
    rows = export_rows(archive, n_modules, start, stop, step, expected)
    rows.repartitionByRange("requested_pulse_id").sortWithinPartitions("requested_pulse_id").write.mode("overwrite").parquet(f"{out}/images")
    if payload is not None:
        wanted = rows.select(F.col("requested_pulse_id").alias("pulse_id"), "write_index")
        attach_pixels(wanted, payload, "left").repartitionByRange("write_index").write.mode("overwrite").parquet(f"{out}/pixels")
    archive.sparkSession.createDataFrame([(detector_name,)], "detector_name string").coalesce(1).write.mode("overwrite").parquet(f"{out}/general")


def verify_export(export: DataFrame, archive: DataFrame, n_modules: int, start: int, stop: int, expected: int = PACKETS[1]) -> DataFrame:
    """Mismatches between an export (pulse_id, frame_index, daq_rec, is_good_image) and what the archive gives."""
    return reconcile(export, images_in_range(archive, n_modules, start, stop, 1, expected))


def with_write_index(images: DataFrame) -> DataFrame:
    return running_index(images, ["pulse_id"], "write_index", file_base("pulse_id"))
