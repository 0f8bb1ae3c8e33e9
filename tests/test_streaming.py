"""Streams give what the batch forms give, for any split of the input."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulseframe import fixtures as fx
from pulseframe.operators import frames as fr
from pulseframe.operators import images as im
from pulseframe.operators import stats as st
from pulseframe.operators import sync as sy
from pulseframe.sources.archive import read_archive
from pulseframe.stored_queries import _batches, _run_timed
from pulseframe.streaming import assembler as sa
from pulseframe.streaming import frames as sf
from pulseframe.streaming import images as si
from pulseframe.streaming import runs as sr
from pulseframe.streaming import sinks as sk

SF = "/root/testdata/sf0.001"


def fed(spark, df, path, order: str, cuts: list[int]):  # noqa: ANN001, ANN201
    """A stream that reads df, sorted by `order`, in as many micro-batches as `cuts` makes."""
    rows = df.orderBy(order).collect()
    at = 0
    for i, to in enumerate([*cuts, len(rows)]):
        spark.createDataFrame(rows[at:to], df.schema).coalesce(1).write.parquet(str(path / f"batch={i:03d}"))
        at = to
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    return src.parquet(str(path))


def drained(stream, name: str, mode: str = "append") -> list:  # noqa: ANN001
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return stream.sparkSession.table(name).collect()


@pytest.fixture
def packets(spark):  # noqa: ANN001, ANN201
    return fx.packets(spark, SF).where("pulse_id <= 40")


@pytest.mark.parametrize("n_cuts", [0, 4])
def test_frames(spark, packets, tmp_path, n_cuts) -> None:
    n = packets.count()
    cuts = sorted(random.Random(n_cuts).sample(range(1, n), n_cuts))
    batch = fr.flag_sequence(fr.packets_to_frames(packets, fx.PACKETS))
    key = ["module_id", "seq", "pulse_id", "frame_index", "daq_rec", "n_recv_packets", "bad"]
    want = sorted(tuple(r[k] for k in key) for r in batch.collect())
    got = drained(sf.stream_frames(fed(spark, packets, tmp_path, "seq", cuts), fx.PACKETS), f"frames{n_cuts}")
    assert sorted(tuple(r[k] for k in key) for r in got) == want


class Held:
    """A state variable that notes what is written to it."""

    def __init__(self) -> None:
        self.value, self.map, self.written = None, {}, 0

    def exists(self) -> bool:
        return self.value is not None

    def get(self):  # noqa: ANN201
        return self.value

    def update(self, value: tuple) -> None:
        self.value = value
        self.written += sum(len(v) if isinstance(v, bytes) else 8 for v in value)

    def updateValue(self, key: tuple, value: tuple) -> None:  # noqa: N802
        self.map[key] = value
        self.written += len(value[0])

    def iterator(self):  # noqa: ANN201
        return iter(self.map.items())

    def clear(self) -> None:
        self.map = {}


class Handle:
    def __init__(self) -> None:
        self.held: dict[str, Held] = {}

    def getValueState(self, name: str, *_: str) -> Held:  # noqa: N802
        return self.held.setdefault(name, Held())

    getMapState = getValueState  # noqa: N815


def test_a_batch_writes_the_packets_that_it_leaves_open() -> None:
    """Payloads are whole for any split, and state written follows the batch, not the frame."""
    size, expected, rng = 1000, 64, random.Random(1)
    rows = [(f * expected + n, 10 + f, 10 + f, 1, n, bytes([f, n]) * (size // 2)) for f in range(3) for n in range(expected)]
    table = pd.DataFrame(rows, columns=["seq", "pulse_id", "framenum", "debug", "packetnum", "data"])
    want = [b"".join(r[5] for r in rows[f * expected : (f + 1) * expected]) for f in range(3)]
    for n_cuts in (0, 3, 60):
        p, handle = sf._Frames(("module_id",), expected, 1, 1000, False, size, 0, False), Handle()
        p.init(handle)
        got, cuts = [], [0, *sorted(rng.sample(range(1, len(rows)), n_cuts)), len(rows)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            before = handle.held["parts"].written
            for out in p.handleInputRows((0,), iter([table.iloc[a:b]]), None):
                got += list(zip(out.pulse_id, out.payload, out.n_distinct_packets, strict=True))
            assert handle.held["parts"].written - before <= (b - a) * size
        assert [(x, d) for x, _, d in got] == [(10, 64), (11, 64), (12, 64)] and [y for _, y, _ in got] == want
        assert handle.held["open"].written <= (n_cuts + 1) * (expected + 7 * 8) and not handle.held["parts"].map


def test_a_batch_is_gone_through_in_slices(monkeypatch) -> None:  # noqa: ANN001
    """What is grouped and given at once does not grow with a key's rows of a batch, and nothing else changes."""
    rows = [(f * 8 + n, 10 + f, 10 + f, 1, n, bytes([f, n])) for f in range(50) for n in range(8) if (f * 3 + n) % 11]
    table = pd.DataFrame(rows, columns=["seq", "pulse_id", "framenum", "debug", "packetnum", "data"])
    found = []
    for size in (10_000, 37):
        monkeypatch.setattr(sf, "SLICE", size)
        p = sf._Frames(("module_id",), 8, 1, 1000, False, 2, 0, False)
        p.init(Handle())
        shuffled = table.sample(frac=1, random_state=3)
        found.append(list(p.handleInputRows((0,), iter([shuffled.iloc[:99], shuffled.iloc[99:]]), None)))
    one, many = (pd.concat(x).reset_index(drop=True) for x in found)
    pd.testing.assert_frame_equal(one, many)
    assert len(found[0]) == 1 and len(found[1]) >= 9 and max(map(len, found[1])) <= 8
    assert [x for x in one.payload] == [bytes(b for n in range(8) for b in ((f, n) if (f * 3 + n) % 11 else (0, 0))) for f in range(len(one))]


def test_batches_grow_in_number(spark) -> None:
    rows = spark.range(1, 1001).withColumnRenamed("id", "seq")
    for most, n in ((1000, 4), (100, 10)):
        parts, low, high = _batches(rows, "seq", 4, most)
        assert (len(parts), low, high) == (n, 1, 1000) and sum(p.count() for p in parts) == 1000
        assert max(p.count() for p in parts) <= max(most, 250) and all(p.rdd.getNumPartitions() == 1 for p in parts)


@pytest.mark.parametrize("cuts", [[], [3, 4, 30, 31, 77]])
def test_frames_of_detectors_with_payloads(spark, packets, tmp_path, cuts) -> None:
    """Modules of two detectors with one number are two modules."""
    rows = packets.where("pulse_id <= 12").withColumn("data", F.expr("unhex(lpad(hex(packetnum), 2, '0'))"))
    both = rows.withColumn("detector_name", F.lit("A")).unionByName(rows.withColumns({"detector_name": F.lit("B"), "seq": F.col("seq") + 5}))
    got = drained(sf.stream_frames(fed(spark, both, tmp_path, "seq", cuts), fx.PACKETS, packet_bytes=1, keys=("detector_name", "module_id")), f"detectors{len(cuts)}")
    key = ["module_id", "pulse_id", "frame_index", "daq_rec", "n_recv_packets", "n_distinct_packets", "bad"]
    want = sorted(tuple(r[k] for k in key) for r in fr.flag_sequence(fr.packets_to_frames(rows, fx.PACKETS)).collect())
    for d in "AB":
        assert sorted(tuple(r[k] for k in key) for r in got if r.detector_name == d) == want
    held = {(r.module_id, r.framenum): set() for r in rows.collect()}
    for r in rows.collect():
        held[r.module_id, r.framenum].add(r.packetnum)
    assert all(r.payload == bytes(n if n in held[r.module_id, r.frame_index] else 0 for n in range(fx.PACKETS)) for r in got)


@pytest.mark.parametrize("emit", [False, True])
def test_a_silent_module(spark, tmp_path, emit) -> None:
    """Its open frame is given or dropped; what still comes of it is a frame of its own."""
    cols = "module_id int, seq long, pulse_id long, framenum long, debug long, packetnum int, data binary"
    rows = [(0, n, 5, 5, 1, n, b"a") for n in range(3)] + [(1, 10 + n, 5, 5, 1, n, b"b") for n in range(8)] + [(0, 30 + n, 5, 5, 1, n, b"c") for n in (3, 7)]
    stream = sf.stream_frames(fed(spark, spark.createDataFrame(rows, cols), tmp_path, "seq", [3, 11]), 8, packet_bytes=1, silent_ms=1, emit_open=emit)
    # a stream with such timers always has another batch to run
    _run_timed(stream.writeStream.format("memory").queryName(f"silent{emit}"), spark, 100)
    got = sorted((r.module_id, r.seq, r.n_recv_packets, r.payload) for r in spark.table(f"silent{emit}").collect())
    zero = b"\0"
    late, whole = (0, 33, 2, zero * 3 + b"c" + zero * 3 + b"c"), (1, 10, 8, b"b" * 8)
    assert got == ([(0, 0, 3, b"aaa" + zero * 5)] if emit else []) + [late, whole]


def test_guard_alone(spark, tmp_path) -> None:
    frames = fx.frames(spark, SF).where("pulse_id <= 60").drop("recv_ts")
    want = sorted((r.module_id, r.seq, r.bad) for r in fr.flag_sequence(frames).collect())
    got = drained(sf.stream_guard(fed(spark, frames, tmp_path, "seq", [50, 51, 120])), "guard")
    assert sorted((r.module_id, r.seq, r.bad) for r in got) == want


def test_images_and_late_rows(spark, tmp_path) -> None:
    frames = fr.accepted(fx.frames(spark, SF)).drop("recv_ts")
    last = frames.agg(F.max("pulse_id")).first()[0]
    want = {r.pulse_id: tuple(r)[1:4] for r in im.assemble_images(frames, fx.N_MODULES, fx.EXPECTED).join(im.align_modules(frames, fx.N_MODULES), "pulse_id").collect()}
    end = spark.createDataFrame([(10**9, 0, last + 10_000, 1, 1, 128)], frames.schema)  # moves the watermark past all pulses
    late = spark.createDataFrame([(10**9 + i, i, 1, 1, 1, 128) for i in range(1, 5)], frames.schema)
    rows = frames.unionByName(end).unionByName(late)
    n = frames.count()
    got = drained(si.stream_images(fed(spark, rows, tmp_path, "seq", [n // 3, n // 2, n + 1]), fx.N_MODULES, fx.EXPECTED), "images")
    assert {r.pulse_id: (r.frame_index, r.daq_rec, r.is_good_image) for r in got} == want


def test_images_by_slots(spark, tmp_path) -> None:
    """The last write of a slot counts, whichever batch it comes in; modules that are not there, and another detector with
    the same pulses, change nothing."""
    schema = "detector_name string, seq long, module_id int, pulse_id long, frame_index long, daq_rec long, n_recv_packets long"
    rows = [("A", s, m, 1, 5, 7, 128) for s, m in enumerate((0, 1, 2, 9))] + [("B", 10 + m, m, 1, 6, 7, 128) for m in range(4)]
    rows += [("A", 20 + m, m, 2, 5, 7, 128) for m in range(4)] + [("A", 30, 3, 2, 5, 7, 100)] + [("A", 40 + m, m, 3, 5, 7, 128) for m in (0, 1, 2)] + [("A", 29, 3, 3, 5, 7, 128)]
    df = spark.createDataFrame(rows, schema)
    keys = ("detector_name", "pulse_id")
    want = sorted(tuple(r)[:5] for r in im.assemble_images(df, 4, keys=keys).collect())
    end = spark.createDataFrame([("A", 10**6, 0, 10**6, 1, 1, 128)], schema)
    got = drained(si.stream_images(fed(spark, df.unionByName(end), tmp_path / "all", "seq", [3, 9, 13]), 4, aligned_only=False, keys=keys), "slots")
    assert sorted(tuple(r)[1:] for r in got) == want
    assert {r[:2]: r[4] for r in want} == {("A", 1): False, ("B", 1): True, ("A", 2): False, ("A", 3): True}
    got = drained(si.stream_images(fed(spark, df.unionByName(end), tmp_path / "aligned", "seq", [5]), 4, keys=keys), "aligned")
    assert sorted((r.detector_name, r.pulse_id) for r in got) == [("A", 2), ("A", 3), ("B", 1)]


@pytest.mark.parametrize("n_cuts", [0, 5])
def test_assembler(spark, tmp_path, n_cuts) -> None:
    """Events and images are those of the batch forms, for any split, whatever the order within the skew."""
    rng = random.Random(n_cuts)
    rows = [(d, 1000 * p + m + 10 * again, m, p + 700 * (d == "C" and m == 1 and p > 200), p - (m == 1 and p % 50 == 0), 7, rng.choice([128, 128, 127])) for d, lost in (("A", 0.02), ("B", 0.4), ("C", 0.1)) for p in range(1, 300) for m in (0, 1, 2, 7) for again in range(1 + (rng.random() < 0.05)) if rng.random() > lost]
    rng.shuffle(rows)
    schema = "detector_name string, seq long, module_id int, pulse_id long, frame_index long, daq_rec long, n_recv_packets long"
    # delivered out of order by up to 60 pulses
    df = spark.createDataFrame([(*r, r[3] + rng.randrange(60)) for r in rows], schema + ", sent long")
    frames = df.where("module_id < 3")
    end = spark.createDataFrame([("A", 10**9, 0, 10**6, 1, 1, 128, 10**6)], df.schema)
    cuts = sorted(rng.sample(range(1, len(rows)), n_cuts))
    got = drained(sa.stream_sync(fed(spark, df.unionByName(end), tmp_path, "sent", cuts), 3, limit=20, rounds=2), f"sync{n_cuts}")
    want = sorted(map(tuple, sy.sync_events(frames, 3, limit=20, rounds=2).collect()), key=repr)
    assert sorted(((r.detector_name, r.pulse_id, r.event, r.n_lost_pulses, r.violation) for r in got), key=repr) == want
    assert {r[2] for r in want} == {"aligned", "offset", "rounds"}
    images = {(r.detector_name, r.pulse_id): tuple(r)[2:5] for r in im.assemble_images(frames, 3, keys=("detector_name", "pulse_id")).collect()}
    assert all((r.frame_index, r.daq_rec, r.is_good_image) == images[r.detector_name, r.pulse_id] for r in got if r.event == "aligned")
    assert {r.is_good_image for r in got if r.event == "aligned"} == {True, False}
    for d in "ABC":
        pulses = [r.pulse_id for r in got if r.detector_name == d]
        assert n_cuts or pulses == sorted(pulses)


def test_the_synchroniser_gets_one_row_a_pulse(spark, tmp_path) -> None:
    """Frames are put together before one task has all of a detector; it has no timer, and nothing to look through, for each
    block of pulses. Slices go on from one another."""
    rows = [("A", 4 * p + m, m, p, 1, 1, 128) for p in range(1, 40) for m in range(2) if (p + m) % 5] + [("A", 10**6, 0, 10**6, 1, 1, 128)]
    df = spark.createDataFrame(rows, "detector_name string, seq long, module_id int, pulse_id long, frame_index long, daq_rec long, n_recv_packets long")
    plan = sa.stream_sync(fed(spark, df, tmp_path, "seq", []), 2)._jdf.queryExecution().analyzed().toString()
    assert plan.index("TransformWithState") < plan.index("Aggregate") and "NoTime" in plan
    p, handle, whole = sa._Sync(sa.Rules(2, 100, 3)), Handle(), pd.DataFrame({"pulse_id": range(1, 60), "held": [(1, 3, 2, 3, 3)[i % 5] for i in range(59)], "frame_index": 1, "daq_rec": 1, "is_good_image": 1})
    p.init(handle)
    want = pd.concat(p.handleInputRows(("A",), iter([whole]), None))
    before, sa.SLICE = sa.SLICE, 7
    try:
        q, parts = sa._Sync(sa.Rules(2, 100, 3)), []
        q.init(Handle())
        for a, b in ((0, 20), (20, 59)):
            parts += list(q.handleInputRows(("A",), iter([whole.iloc[a:b]]), None))
    finally:
        sa.SLICE = before
    pd.testing.assert_frame_equal(pd.concat(parts).reset_index(drop=True), want.reset_index(drop=True))
    assert len(parts) == 9 and len(want) == 35


def test_assembler_stops_where_it_should(spark, tmp_path) -> None:
    rows = [("A", 2 * p + m, m, p + 300 * (m == 1 and p > 10), 1, 1, 128) for p in range(1, 30) for m in range(2)] + [("A", 10**6, 0, 10**6, 1, 1, 128)]
    df = spark.createDataFrame(rows, "detector_name string, seq long, module_id int, pulse_id long, frame_index long, daq_rec long, n_recv_packets long")
    assert len(drained(sa.stream_assembler(fed(spark, df, tmp_path / "a", "seq", []), 2), "lenient")) == 10
    with pytest.raises(Exception, match="out of sync at pulse 311"):
        drained(sa.stream_assembler(fed(spark, df, tmp_path / "b", "seq", []), 2, strict=True), "strict_sync")


def test_pixels_join(spark, tmp_path) -> None:
    images = spark.createDataFrame([(p, p) for p in range(1, 20)], "pulse_id long, frame_index long")
    payload = spark.createDataFrame([(p, f"d{p}") for p in range(5, 30)], "pulse_id long, data string")
    (tmp_path / "i").mkdir()
    (tmp_path / "p").mkdir()
    joined = si.stream_attach_pixels(fed(spark, images, tmp_path / "i", "pulse_id", [7]), fed(spark, payload, tmp_path / "p", "pulse_id", [3]))
    assert sorted((r.pulse_id, r.data) for r in drained(joined, "pixels")) == sorted((p, f"d{p}") for p in range(5, 20))


def test_time_stats(spark, tmp_path) -> None:
    frames = fr.flag_sequence(fx.frames(spark, SF).where("pulse_id <= 100"))
    want = sorted(tuple(r) for r in st.frame_stats(frames, "1 day", 86_400_000, fx.EXPECTED).collect())
    got = drained(si.stream_frame_stats(fed(spark, frames, tmp_path, "seq", [100]), "1 day", 86_400_000, fx.EXPECTED), "stats", "update")
    newest = {(r.module_id, r.window_start): tuple(r) for r in got}
    assert sorted(newest.values()) == want


def test_count_stats(spark, tmp_path) -> None:
    images = spark.range(1, 57).selectExpr("'JF' as detector_name", "id as pulse_id", "id % 7 <> 0 as is_good_image", "id % 3 as n_lost_pulses")
    want = sorted((r.bucket, r.n_images, r.n_corrupted_images, r.n_lost_pulses) for r in st.assembler_stats(images, 10).collect())
    got = drained(sf.stream_count_stats(fed(spark, images, tmp_path, "pulse_id", [3, 10, 31]), 10), "counts")
    assert sorted((r.bucket, r.n_images, r.n_corrupted_images, r.n_lost_pulses) for r in got) == want and len(want) == 5


RUN = "detector_name string, seq long, run_id long, i_image long, n_images long, pulse_id long"


def test_run_lifecycle(spark, tmp_path) -> None:
    rows = [("JF", 0, 1, 0, 3, 10), ("JF", 1, 1, 1, 3, 11), ("JF", 2, 9, 1, 3, 12), ("JF", 3, 1, 2, 3, 13), ("JF", 4, 1, 2, 3, 13), ("JF", 5, 2, 0, 1, 14), ("JF", 6, 3, 0, 5, 15), ("JF", 7, 4, 0, 5, 16), ("JF", 8, 3, 1, 5, 17)]
    df = spark.createDataFrame(rows, RUN)
    got = sorted(drained(sr.run_lifecycle(fed(spark, df, tmp_path / "a", "seq", [2, 5])), "life"), key=lambda r: r.seq)
    assert [r.event for r in got] == ["open", "write", "rejected", "close", "rejected", "open+close", "open", "open", "rejected"]
    strict = sr.run_lifecycle(fed(spark, df, tmp_path / "b", "seq", []), strict=True)
    with pytest.raises(Exception, match="image of run 9 while run 1 is open"):
        drained(strict, "strict")


def test_op_codes(spark, tmp_path) -> None:
    codes = [(0, 1), (1, 1), (0, 1), (1, 1), (0, 2), (2, 1), (0, 1), (2, 1)]
    df = spark.createDataFrame([("JF", i, run, i, 9, i, c) for i, (c, run) in enumerate(codes)], RUN + ", op_code int")
    got = sorted(drained(sr.run_lifecycle(fed(spark, df, tmp_path, "seq", [3]), "op_code"), "codes"), key=lambda r: r.seq)
    assert [r.event for r in got] == ["ignored", "open", "write", "ignored", "ignored", "close", "ignored", "reset"]


def run(writer, tmp_path, name: str) -> None:  # noqa: ANN001
    q = writer.option("checkpointLocation", str(tmp_path / f"ck-{name}")).trigger(availableNow=True).start()
    q.awaitTermination(120)


def test_sinks(spark, packets, tmp_path) -> None:
    (tmp_path / "in").mkdir()
    frames = sf.stream_frames(fed(spark, packets, tmp_path / "in", "seq", [400]), fx.PACKETS)
    run(sk.archive_sink(frames, str(tmp_path / "archive")), tmp_path, "archive")
    want = fr.accepted(fr.packets_to_frames(packets, fx.PACKETS))
    got = read_archive(spark, str(tmp_path / "archive"))
    assert sorted((r.module_id, r.pulse_id) for r in got.collect()) == sorted({(r.module_id, r.pulse_id) for r in want.collect()})

    rows = spark.range(1, 31).selectExpr("id as pulse_id", "id as frame_index", "1L as daq_rec", "true as is_good_image", "'p' as pedestal_file", "'g' as gain_file", "'JF' as detector_name", "4 as n_modules", "cast('xy' as binary) as data")
    (tmp_path / "im").mkdir()
    images = fed(spark, rows, tmp_path / "im", "pulse_id", [12])
    run(sk.live_sink(images, str(tmp_path / "out")), tmp_path, "live")
    reduced = spark.read.parquet(str(tmp_path / "out/reduced"))
    assert reduced.count() == 30 and reduced.where(F.col("data") == F.lit(bytes(8))).count() == 27
    assert spark.read.parquet(str(tmp_path / "out/live")).where(F.col("data") == F.lit(b"xy")).count() == 30
    assert spark.read.parquet(str(tmp_path / "out/pulses")).count() == 30
    run(sk.publish_images(images, str(tmp_path / "meta")), tmp_path, "meta")
    assert spark.read.parquet(str(tmp_path / "meta")).count() == 30


def test_run_sink_merges_batches(spark, tmp_path) -> None:
    """Images of runs that are not open are left out, of repeats the latest counts, in a batch and over batches; closed runs
    are said to be."""
    base = [(1, 0), (1, 1), (9, 1), (1, 2), (1, 2), (2, 0), (2, 1), (2, 1), (3, 0), (2, 2), (3, 1)]
    rows = [("JF", s, r, i, 3, 10 + s, 512, 1024, 8 if s % 2 else 16) for s, (r, i) in enumerate(base)]
    df = spark.createDataFrame(rows, RUN + ", image_y_size int, image_x_size int, bits_per_pixel int")
    for name, cuts in (("one", []), ("three", [2, 7])):
        out = str(tmp_path / name)
        run(sk.run_sink(fed(spark, df, tmp_path / f"in-{name}", "seq", cuts), out, 2), tmp_path, name)
        got = sorted((r.run_id, r.i_image, r.seq, r.pixel_type) for r in spark.read.parquet(f"{out}/runs").collect())
        assert got == [(1, 0, 0, "uint16"), (1, 1, 1, "uint8"), (1, 2, 3, "uint8"), (2, 0, 5, "uint8"), (2, 1, 7, "uint8"), (3, 0, 8, "uint16"), (3, 1, 10, "uint16")]
        assert [tuple(r) for r in sk.closed_runs(spark, out).collect()] == [(1, 3)]
    assert sk.closed_runs(spark, str(tmp_path / "none")).count() == 0


def test_runs_share_folders(spark, tmp_path) -> None:
    """Many short runs are not as many folders and files."""
    rows = [("JF", 3 * r + i, r, i, 2, 10 * r + i, 512, 1024, 8) for r in range(300) for i in range(2)]
    df = spark.createDataFrame(rows, RUN + ", image_y_size int, image_x_size int, bits_per_pixel int")
    out = tmp_path / "out"
    run(sk.run_sink(fed(spark, df, tmp_path / "in", "seq", [201]), str(out), 2), tmp_path, "many")
    got = sorted((r.run_id, r.i_image, r.pulse_id) for r in spark.read.parquet(f"{out}/runs").collect())
    assert got == [(r, i, 10 * r + i) for r in range(300) for i in range(2)]
    assert len(list((out / "runs").rglob("*.parquet"))) <= 2 and sk.closed_runs(spark, str(out)).count() == 300
