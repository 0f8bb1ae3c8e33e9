from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pulseframe.functions import scalars as sc
from pulseframe.plans.historical import aligned, check_range

ACCEPTED = [(5, 5, 1), (5, 5, 5), (1234, 1234, 1), (1234, 4567, 1), (4, 4, 4)]
REFUSED = [(5, 4, 1), (1, 9, 10), (5, 10, 10), (10, 19, 10), (1234, 1233, 1), (1234, 1234, 3), (10, 10, 4), (8, 10, 4)]


def one(spark, *cols):  # noqa: ANN001, ANN202
    return spark.range(1).select(*cols).first()


def test_paths(spark) -> None:
    p = F.lit(12345999)
    r = one(spark, sc.archive_path("/root", p, F.lit(1)), sc.archive_path("/root", F.lit(12345000), F.lit(1)), sc.archive_path("/root", F.lit(12346000), F.lit(1)), sc.archive_path("/root", F.lit(12344999), F.lit(1)), sc.archive_path("/root", p))
    assert r[0] == r[1] == "/root/M01/12300000/12345000.bin"
    assert r[2] != r[0] and r[3] != r[0]
    assert r[4] == "/root/12300000/12345000.bin"
    assert list(one(spark, *[sc.frame_offset_in_file(F.lit(x)) for x in (12345000, 12345543, 12345999)])) == [0, 543, 999]


def test_names(spark) -> None:
    r = one(spark, sc.module_name(F.lit(0)), sc.module_name(F.lit(10)), sc.module_name(F.lit(123)), sc.detector_name(F.lit("plain")), sc.n_modules_from_name(F.lit("JF02T09V03")), sc.pulse_from_path(F.lit("/a/M00/1/12345000.bin")))
    assert list(r) == ["M00", "M10", "M123", "plain", 9, 12345000]


def test_packet_meta_takes_whole_pulse(spark) -> None:
    df = spark.createDataFrame([(7.9, 92, 94, 3)], "bunchid double, framenum bigint, debug bigint, module_id int")
    assert list(df.select(*sc.packet_to_frame_meta()).first()) == [7, 92, 94, 3]
    assert df.select(*sc.packet_to_frame_meta(2)).first()["module_id"] == 0


@pytest.mark.parametrize("r", ACCEPTED)
def test_range_accepted(spark, r) -> None:
    n = check_range(*r)
    assert one(spark, sc.n_pulses_in_range(*r))[0] == n == len(range(r[0], r[1] + 1, r[2]))


@pytest.mark.parametrize("r", REFUSED)
def test_range_refused(spark, r) -> None:
    with pytest.raises(ValueError):
        check_range(*r)
    with pytest.raises(Exception, match="step|stop|start"):
        one(spark, sc.n_pulses_in_range(*r))


def test_align() -> None:
    assert aligned(101, 2477, 5) == (105, 2475)
    assert aligned(100, 200, 10) == (100, 200)


def test_pixel_type(spark) -> None:
    assert [one(spark, sc.pixel_type(F.lit(b)))[0] for b in (8, 16, 32)] == ["uint8", "uint16", "uint32"]
    with pytest.raises(Exception, match="no pixel type of 12 bits"):
        one(spark, sc.pixel_type(F.lit(12)))


def test_image_bytes_do_not_overflow(spark) -> None:
    assert one(spark, sc.image_n_bytes(F.lit(32 * 512), F.lit(1024), F.lit(32)))[0] == 32 * 512 * 1024 * 4


def test_header_members_in_order(spark) -> None:
    df = spark.createDataFrame([(1, 2, 3, True, "p", "g", "JF")], "pulse_id long, frame_index long, daq_rec long, is_good_image boolean, pedestal_file string, gain_file string, detector_name string")
    h = json.loads(df.select(sc.live_header_json(F.lit(False), 4)).first()[0])
    assert list(h) == ["frame", "is_good_frame", "daq_rec", "pulse_id", "pedestal_file", "gain_file", "detector_name", "htype", "type", "shape"]
    assert h["shape"] == [2, 2] and h["is_good_frame"] == 1


def test_line_protocol_and_rate(spark) -> None:
    line = sc.line_protocol("m", {"d": F.lit("x")}, {"n": (F.lit(3), True), "v": (F.lit(1.5), False)}, F.lit(9))
    assert one(spark, line)[0] == "m,d=x n=3i,v=1.5 9"
    assert list(one(spark, sc.repetition_rate(F.lit(1000), 10_000), sc.repetition_rate(F.lit(5), 0))) == [100, None]
