"""Decoding, buffer files, archive, configuration, exports, runs."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseframe.functions import pixels as px
from pulseframe.operators.images import missing_frames, module_spine
from pulseframe.plans import historical as hi
from pulseframe.plans import runs as ru
from pulseframe.schemas import MARKER
from pulseframe.sources import archive as ar
from pulseframe.sources import buffer_files as bf
from pulseframe.sources import tables as tb

FRAME = "seq long, module_id int, pulse_id long, frame_index long, daq_rec long, n_recv_packets long"


@pytest.mark.parametrize("dialect", [1, 2])
def test_datagrams(spark, dialect) -> None:
    rows = np.zeros(2, px.datagram_dtype(dialect))
    rows["packetnum"], rows["framenum"], rows["bunchid"], rows["debug"], rows["module_id"] = [91, 1], [92, 2], [93, 3], [94, 4], [5, 65535]
    rows["data"] = [bytes([7]) * 8192, bytes(8192)]
    raw = [bytearray(r.tobytes()) for r in rows]
    df = spark.createDataFrame([(0, raw[0]), (1, raw[1]), (2, raw[0][:-1])], "seq long, raw binary")
    got = px.decode_packets(df, dialect=dialect).orderBy("seq").collect()
    assert len(got) == 2  # 8239 bytes are refused
    r = got[0]
    assert (r.packetnum, r.framenum, r.bunchid, r.debug, r.module_id, bytes(r.data)) == (91, 92, 93, 94, 5, bytes([7]) * 8192)
    assert got[1].module_id == 65535


def test_payload_bytes(spark) -> None:
    rows = [(1, 0, 0, b"aa"), (1, 1, 2, b"cc"), (1, 2, 2, b"dd"), (2, 3, 1, b"bb")]
    df = spark.createDataFrame([(a, b, c, bytearray(d)) for a, b, c, d in rows], "frame_no long, seq long, packetnum int, data binary")
    got = {r.frame_no: bytes(r.payload) for r in px.assemble_payload(df, ["frame_no"], 3, 2).collect()}
    assert got == {1: b"aa\0\0dd", 2: b"\0\0bb\0\0"}


def test_stacking_and_pixels(spark) -> None:
    data = bytearray(np.arange(4, dtype="<u2").tobytes())
    df = spark.createDataFrame([(1, 0, data), (1, 2, data)], "pulse_id long, module_id int, payload binary")
    image = px.stack_binary(df, 3, 8)
    assert px.pixels(image, "image").first().pixels == [0, 1, 2, 3, 0, 0, 0, 0, 0, 1, 2, 3]
    top = spark.createDataFrame([(bytearray(b"\xff\xff\xff\xff"),)], "payload binary")
    assert px.pixels(top, bits=32).first().pixels == [2**32 - 1]
    with pytest.raises(ValueError):
        px.pixels(top, bits=12)
    mixed = spark.createDataFrame([(i, None if i % 3 == 0 else bytearray(np.arange(i % 5, dtype="<u2").tobytes())) for i in range(50)], "i int, payload binary")
    assert {r.i: r.pixels for r in px.pixels(mixed).where("i > 1").collect()} == {i: None if i % 3 == 0 else list(range(i % 5)) for i in range(2, 50)}
    with pytest.raises(Exception, match="no whole number"):
        px.pixels(spark.createDataFrame([(bytearray(3),)], "payload binary")).collect()


def test_buffer_files(spark, tmp_path) -> None:
    dtype = bf.record_dtype(8)
    for module in range(2):
        rows = np.zeros(1000, dtype)
        for p in (5, 250, 999) if module == 0 else (5,):
            rows[p] = (MARKER, 1000 + p, p + 1, p + 2, 128, module, np.array([1, 2, 3, 4], "<u2").tobytes())
        path = tmp_path / f"M{module:02d}" / "0"
        path.mkdir(parents=True)
        (path / "1000.bin").write_bytes(rows.tobytes() + b"\xff")
    df = bf.import_buffer_files(spark, str(tmp_path), 2, 1000, 1999, payload=8)
    got = {(r.module_id, r.pulse_id): r for r in df.collect()}
    assert got.keys() == {(0, 1005), (0, 1250), (0, 1999), (1, 1005)}
    r = got[0, 1005]
    assert (r.frame_index, r.daq_rec, r.n_recv_packets, list(np.frombuffer(r.payload, "<u2"))) == (6, 7, 128, [1, 2, 3, 4])
    part = bf.import_buffer_files(spark, f"file://{tmp_path}", 2, 1200, 1299, payload=8)
    assert [r.pulse_id for r in part.collect()] == [1250]
    assert bf.import_buffer_files(spark, str(tmp_path), 2, 5000, 5099, payload=8).count() == 0
    assert bf.import_buffer_files(spark, str(tmp_path), 2, 5, 4, payload=8).count() == 0


def test_partitions_follow_the_files(spark, tmp_path) -> None:
    """Not the range: a year of pulses in which three files stand is three files' partitions."""
    frames = spark.createDataFrame([(m, p, p + 1, 7, 128, bytearray(b"abcdefghij"[: 3 + p % 4])) for m in range(2) for p in (5, 120, 999, 3_000_000, 3_000_001, 40_000_000) if m == 0 or p > 1000], "module_id int, pulse_id long, frame_index long, daq_rec long, n_recv_packets long, payload binary")
    assert bf.write_buffer_files(frames, str(tmp_path), 6) == 5
    assert bf.write_buffer_files(frames, str(tmp_path), 6) == 5 and len(list(tmp_path.rglob("*"))) == 2 + 5 + 5
    listed = bf.list_buffer_files(spark, str(tmp_path), 3, 0, 3_100_000_000)
    assert sorted(map(tuple, listed.collect())) == [(m, b, 1000 * 47 + 1) for m, b in ((0, 0), (0, 3_000_000), (0, 40_000_000), (1, 3_000_000), (1, 40_000_000))]
    got = bf.import_buffer_files(spark, str(tmp_path), 3, 0, 3_100_000_000, 6, part_bytes=47 * 400)
    assert got.rdd.getNumPartitions() == 5 * 1000 // 400 + 1
    fixed = lambda r: (*r[:5], bytes(r[5]).ljust(6, b"\0")[:6])
    assert sorted((*r[:5], bytes(r[5])) for r in got.collect()) == sorted(fixed(r) for r in frames.collect())
    some = bf.import_buffer_files(spark, str(tmp_path), 3, 6, 3_000_000, 6)
    assert sorted((r.module_id, r.pulse_id) for r in some.collect()) == [(0, 120), (0, 999), (0, 3_000_000), (1, 3_000_000)] and some.rdd.getNumPartitions() == 1
    (tmp_path / "M00/0/0.bin").write_bytes((tmp_path / "M00/0/0.bin").read_bytes()[: 47 * 120 + 46])  # a record cut short
    assert sorted(r.pulse_id for r in bf.import_buffer_files(spark, str(tmp_path), 1, 0, 999, 6).collect()) == [5]


def test_archive_upsert_and_lookup(spark, tmp_path) -> None:
    path = str(tmp_path / "archive")
    first = spark.createDataFrame([(i, i % 2, 990 + i // 2, 10, 1, 128) for i in range(40)], FRAME)
    ar.write_archive(first, path)
    again = spark.createDataFrame([(100, 0, 1001, 77, 1, 128)], FRAME)
    ar.write_archive(again, path)
    ar.write_archive(again, path)  # a replay
    a = ar.read_archive(spark, path)
    assert a.count() == 40
    assert [r.frame_index for r in a.where("pulse_id = 1001").orderBy("module_id").collect()] == [77, 10]
    scan = ar.scan_pulse_range(a, 1000, 1005)
    assert scan.count() == 12 and "PartitionFilters: [isnotnull(folder_base" in scan._jdf.queryExecution().toString()
    image, each = ar.point_lookup(a, 1002, 3)
    assert not image.first().is_good_image and each.count() == 3
    assert ar.latest_pulse(spark, path).first().latest_file == 0
    assert ar.latest_pulse(spark, path, closed_only=False).first().latest_file == 1000
    assert ar.latest_pulse(spark, path, closed_only=False, offset=-1000).first().latest_file == 0
    later = spark.createDataFrame([(1, 0, 250_000, 1, 1, 128)], FRAME)
    ar.write_archive(later, path)
    assert ar.latest_pulse(spark, path).first().latest_file == 1000  # in the folder before
    assert ar.latest_pulse(spark, path, 7).first().latest_file is None and ar.latest_pulse(spark, f"{path}-none").first().latest_file is None
    spine = module_spine(spark.range(1009, 1012).withColumnRenamed("id", "pulse_id"), 2)
    assert sorted((r.pulse_id, r.module_id) for r in missing_frames(spine, a).collect()) == [(1010, 0), (1010, 1), (1011, 0), (1011, 1)]


def test_detectors(spark, tmp_path) -> None:
    conf = dict(streamvis_stream="tcp://a", streamvis_rate=10, live_stream="tcp://b", live_rate=1, pedestal_file="p", gain_file="g", detector_name="JF01T03V01", n_modules=3, start_udp_port=50000, buffer_folder="/b")
    (tmp_path / "a.json").write_text(json.dumps(conf, indent=1))
    (tmp_path / "b.json").write_text(json.dumps(conf | {"detector_name": "JF01T04V02"}, indent=1))
    df = tb.read_detectors(spark, str(tmp_path))
    assert df.count() == 2
    assert tb.resolve_detector(df, "JF01T03").first().n_modules == 3
    with pytest.raises(LookupError, match="no detector"):
        tb.resolve_detector(df, "JF9")
    with pytest.raises(LookupError, match="several"):
        tb.resolve_detector(df, "JF01")
    (tmp_path / "c.json").write_text(json.dumps({k: v for k, v in conf.items() if k != "live_rate"}))
    with pytest.raises(Exception, match="without live_rate"):
        tb.read_detectors(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("start,stop,step", [(5, 10, 1), (500, 599, 1), (500, 598, 2), (500, 596, 4), (500, 590, 10), (500, 500, 100)])
def test_export(spark, tmp_path, start, stop, step) -> None:
    frames = spark.createDataFrame([(p * 2 + m, m, p, p + 10, p + 100, 128) for p in range(start, stop + 1, step) if p != start + 3 for m in range(2)], FRAME)
    out = str(tmp_path / "out")
    for _ in range(2):  # an export replaces what is there
        hi.export_range(frames, 2, start, stop, out, step, detector_name="JF01")
    rows = spark.read.parquet(f"{out}/images").orderBy("write_index").collect()
    assert [r.requested_pulse_id for r in rows] == list(range(start, stop + 1, step))
    assert [r.write_index for r in rows] == list(range(len(rows)))
    for r in rows:
        p = r.requested_pulse_id
        assert (r.pulse_id, r.frame_index, r.daq_rec, r.is_good_frame) == ((0, 0, 0, 0) if p == start + 3 else (p, p + 10, p + 100, 1))
    assert spark.read.parquet(f"{out}/general").first().detector_name == "JF01"
    export = spark.read.parquet(f"{out}/images").where("pulse_id > 0").select("pulse_id", "frame_index", "daq_rec", (F.col("is_good_frame") == 1).alias("is_good_image"))
    assert hi.verify_export(export, frames, 2, start, stop).count() == 0


def test_export_pixels_and_unaligned_range(spark, tmp_path) -> None:
    frames = spark.createDataFrame([(p, 0, p, p, 1, 128) for p in range(4, 9)], FRAME)
    payload = spark.createDataFrame([(p, bytearray([p])) for p in range(4, 9)], "pulse_id long, image binary")
    hi.export_range(frames, 1, 4, 8, str(tmp_path / "o"), 2, payload=payload)
    assert sorted((r.write_index, bytes(r.image)) for r in spark.read.parquet(str(tmp_path / "o/pixels")).collect()) == [(0, b"\4"), (1, b"\6"), (2, b"\x08")]
    with pytest.raises(ValueError):
        hi.export_rows(frames, 1, 3, 8, 2)
    assert hi.export_rows(frames, 1, 3, 9, 2, align=True).count() == 3


def test_runs_are_replaced_one_by_one(spark, tmp_path) -> None:
    schema = "run_id long, i_image long, image_y_size int, image_x_size int, bits_per_pixel int"
    rows = lambda runs: ru.run_rows(spark.createDataFrame([(r, i, 512, 1024, 16) for r in runs for i in range(5)], schema))
    out = str(tmp_path / "runs")
    ru.write_runs(rows([1, 2]), out, 2)
    ru.write_runs(rows([2]), out, 2)
    assert sorted((r.run_id, r.i_image) for r in spark.read.parquet(out).collect()) == [(r, i) for r in (1, 2) for i in range(5)]
    lines = spark.createDataFrame([("a 1",)], "line string")
    ru.write_stats(lines, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).first()[0] == "a 1"
