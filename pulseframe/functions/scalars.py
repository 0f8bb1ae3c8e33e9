"""Scalar functions (PRJ-1 .. PRJ-18) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BLOCK_PULSES, FILE_PULSES, FOLDER_PULSES, MODULE_X, MODULE_Y, PULSE_MS


def _col(x: Column | str | int) -> Column:
    return F.lit(x) if isinstance(x, int) else F.col(x) if isinstance(x, str) else x


def _long(x: Column | str | int) -> Column:
    return _col(x).cast("bigint")


def div(a: Column | str | int, b: Column | str | int) -> Column:
    """Integer division of BIGINTs, towards zero."""
    return F.call_function("div", _long(a), _long(b))


def folder_base(pulse: Column | str) -> Column:
    return div(pulse, FOLDER_PULSES) * FOLDER_PULSES


def file_base(pulse: Column | str) -> Column:
    return div(pulse, FILE_PULSES) * FILE_PULSES


def frame_offset_in_file(pulse: Column | str) -> Column:
    return F.pmod(_long(pulse), F.lit(FILE_PULSES).cast("bigint"))


def module_name(module_id: Column | str) -> Column:
    """M00 .. M99, then M100 and on: never cut."""
    m = _long(module_id)
    return F.concat(F.when(m < 10, F.lit("M0")).otherwise(F.lit("M")), m.cast("string"))


def archive_path(root: str | Column, pulse: Column | str, module_id: Column | str | None = None) -> Column:
    """root/M00/folder/file.bin; without a module, the path of an image file."""
    parts = [F.lit(root) if isinstance(root, str) else root]
    if module_id is not None:
        parts.append(module_name(module_id))
    parts += [folder_base(pulse).cast("string"), F.concat(file_base(pulse).cast("string"), F.lit(".bin"))]
    return F.concat_ws("/", *parts)


def block_id(pulse: Column | str) -> Column:
    return div(pulse, BLOCK_PULSES)


def block_start(pulse: Column | str) -> Column:
    return block_id(pulse) * BLOCK_PULSES


def block_stop(pulse: Column | str) -> Column:
    return block_start(pulse) + (BLOCK_PULSES - 1)


def pulse_event_time(pulse: Column | str) -> Column:
    """The pulse number is the clock: 10 ms a pulse."""
    return F.timestamp_millis(_long(pulse) * PULSE_MS)


def detector_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def n_modules_from_name(name: Column | str) -> Column:
    return F.substring(_col(name), 6, 2).cast("int")


def pulse_from_path(path: Column | str) -> Column:
    return F.regexp_extract(_col(path), r"([0-9]+)\.[^/]*$", 1).cast("bigint")


def packet_to_frame_meta(dialect: int = 1) -> list[Column]:
    """pulse_id, frame_index, daq_rec and module_id of a packet. The second dialect has one receiver, module 0."""
    module = F.col("module_id").cast("int") if dialect == 1 else F.lit(0)
    return [F.col("bunchid").cast("bigint").alias("pulse_id"), F.col("framenum").alias("frame_index"), F.col("debug").alias("daq_rec"), module.alias("module_id")]


def image_n_bytes(y: Column | str, x: Column | str, bits: Column | str) -> Column:
    return div(_long(y) * _long(x) * _long(bits), 8)


def pixel_type(bits: Column | str) -> Column:
    """uint8, uint16 or uint32; any other width is an error."""
    b = _col(bits)
    out = F.raise_error(F.concat(F.lit("no pixel type of "), b.cast("string"), F.lit(" bits"))).cast("string")
    for n in (32, 16, 8):
        out = F.when(b == n, F.lit(f"uint{n}")).otherwise(out)
    return out


def image_shape(n_modules: Column | str | int, has_data: Column) -> Column:
    """[y, x]; a thinned image has four zero pixels."""
    full = F.array(_long(n_modules) * MODULE_Y, F.lit(MODULE_X).cast("bigint"))
    return F.when(has_data, full).otherwise(F.array(F.lit(2).cast("bigint"), F.lit(2).cast("bigint")))


def live_header_json(has_data: Column, n_modules: Column | str | int) -> Column:
    """The header of a live message; needs the image's and the detector's columns."""
    return F.to_json(
        F.struct(
            F.col("frame_index").alias("frame"),
            F.col("is_good_image").cast("int").alias("is_good_frame"),
            "daq_rec",
            "pulse_id",
            "pedestal_file",
            "gain_file",
            "detector_name",
            F.lit("array-1.0").alias("htype"),
            F.lit("uint16").alias("type"),
            image_shape(n_modules, has_data).alias("shape"),
        )
    )


def checked_range(start: Column | str | int, stop: Column | str | int, step: Column | str | int, value: Column) -> Column:
    """value, or an error for a range that the writer would refuse."""
    a, b, s = _long(start), _long(stop), _long(step)
    out = value
    for wrong, why in (
        (b % s != 0, "the stop is not on the step grid"),
        (a % s != 0, "the start is not on the step grid"),
        (F.lit(BLOCK_PULSES) % s != 0, f"the step does not divide {BLOCK_PULSES}"),
        (b < a, "the stop is before the start"),
    ):
        out = F.when(wrong, F.raise_error(F.lit(why)).cast("bigint")).otherwise(out)
    return out


def n_pulses_in_range(start: Column | str | int, stop: Column | str | int, step: Column | str | int) -> Column:
    return checked_range(start, stop, step, F.lit(1) + div(stop, step) - div(start, step))


def align_range(start: Column | str | int, stop: Column | str | int, step: Column | str | int) -> tuple[Column, Column]:
    """The start up and the stop down to the step grid."""
    a, b, s = _long(start), _long(stop), _long(step)
    return div(a + s - 1, s) * s, div(b, s) * s


def line_protocol(measurement: str, tags: dict[str, Column | str], fields: dict[str, tuple[Column | str, bool]], time_ns: Column | str) -> Column:
    """measurement,tag=v field=vi,field=v time; fields: the column and whether it is an integer."""
    head = F.concat(F.lit(measurement), *[x for k, v in tags.items() for x in (F.lit(f",{k}="), _col(v).cast("string"))])
    body = F.concat_ws(",", *[F.concat(F.lit(f"{k}="), _col(v).cast("string"), F.lit("i" if whole else "")) for k, (v, whole) in fields.items()])
    return F.concat_ws(" ", head, body, _long(time_ns).cast("string"))


def repetition_rate(n: Column | str, interval_ms: Column | str | int) -> Column:
    """Items a second; 250 makes up for the cut of the division. Null for an empty interval."""
    ms = _long(interval_ms)
    return F.when(ms != 0, div(_long(n) * 1000 + 250, F.nullif(ms, F.lit(0).cast("bigint"))))
