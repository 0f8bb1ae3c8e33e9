"""Images with pixels out of the archive, their export and its verification."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from pulseframe.functions import pixels as px
from pulseframe.plans import pixels as xp

FRAME = "seq long, module_id int, pulse_id long, frame_index long, daq_rec long, n_recv_packets long, payload binary"
P = 6


def data(seq: int) -> bytes:
    return hashlib.sha256(str(seq).encode()).digest()[:P]


@pytest.fixture
def archive(spark, tmp_path):  # noqa: ANN001, ANN201
    """Three modules over a file's end, with frames that lack packets, modules and pulses, and one that was written twice."""
    rows = [(p * 10 + m, m, p, p + 1, 7, 127 if p % 11 == 0 and m == 1 else 128) for p in range(950, 1250) for m in range(3) if not (p % 7 == 0 and m == 2) and p % 13]
    rows.append((99_999, 0, 1001, 1002, 7, 128))
    path = f"{tmp_path}/archive"
    df = spark.createDataFrame([(*r, bytearray(data(r[0]))) for r in rows], FRAME)
    xp.write_pixel_archive(df.where("seq % 2 = 0"), path)
    xp.write_pixel_archive(df.where("seq % 2 = 1"), path)
    held = {}
    for r in sorted(rows):
        held[r[2], r[1]] = r
    return path, held


def image(held: dict, p: int) -> tuple:
    each = [held.get((p, m)) for m in range(3)]
    whole = [r for r in each if r and r[5] == 128]
    return p, p if any(each) else 0, whole[0][3] if whole else 0, whole[0][4] if whole else 0, int(len(whole) == 3), b"".join(data(r[0]) if r else bytes(P) for r in each)


@pytest.mark.parametrize(("start", "stop", "step"), [(940, 1260, 1), (960, 1200, 10), (1001, 1001, 1), (5000, 5010, 1)])
def test_images_out_of_the_archive(spark, archive, start, stop, step) -> None:
    path, held = archive
    df = xp.archive_images(spark, path, 3, start, stop, step, payload=P)
    got = sorted(df.collect())
    assert [(r.requested_pulse_id, r.pulse_id, r.frame_index, r.daq_rec, r.is_good_frame, bytes(r.image)) for r in got] == [image(held, p) for p in range(start, stop + 1, step)]
    assert [r.write_index for r in got] == list(range(len(got)))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_one_image_and_bad_ranges(spark, archive) -> None:
    path, held = archive
    r = xp.image_lookup(spark, path, 1001, 3, payload=P).first()
    assert bytes(r.image) == image(held, 1001)[-1] and bytes(r.image)[:P] == data(99_999)
    with pytest.raises(ValueError, match="step grid"):
        xp.archive_images(spark, path, 3, 1, 10, 5, payload=P)
    # longer and shorter payloads than an image's modules have room for
    assert bytes(xp.image_lookup(spark, path, 1001, 1, payload=4).first().image) == data(99_999)[:4]
    assert bytes(xp.image_lookup(spark, path, 1001, 1, payload=9).first().image) == data(99_999) + bytes(3)


def test_verification(spark, archive, tmp_path) -> None:
    path, held = archive
    out = f"{tmp_path}/export"
    for _ in range(2):  # an export replaces what is there
        xp.export_pixels(spark, path, 3, 940, 1260, out, detector_name="JF01", payload=P)
    e = spark.read.parquet(f"{out}/images")
    assert e.count() == 321 and tuple(spark.read.parquet(f"{out}/general").first()) == ("JF01", 3, 940, 1260, 1)
    check = lambda df, **o: sorted((r.pulse_id, r.field) for r in xp.verify_pixels(df, spark, path, 3, payload=P, **o).collect())
    assert check(e) == [] and check(e, deep=True) == []
    p = F.col("requested_pulse_id")
    rot = e.withColumn("image", F.when(p == 1000, F.concat(F.lit(b"\1" * P), F.substring("image", P + 1, 2 * P))).when(p == 945, F.lit(b"\2" * 3 * P)).otherwise(F.col("image")))
    assert check(rot) == []  # digests are as they were written
    assert check(rot, deep=True) == [(945, "module 0"), (945, "module 1"), (945, "module 2"), (1000, "module 0")]
    signed = rot.withColumn("digest", F.when(p.isin(945, 1000), F.lit("x")).otherwise(F.col("digest")))
    assert check(signed) == check(rot, deep=True)
    row = xp.verify_pixels(signed, spark, path, 3, payload=P).where("pulse_id = 945 and field = 'module 2'").first()
    assert row.expected == "-" and row.got == hashlib.sha256(b"\2" * P).hexdigest()
    others = e.withColumns({"frame_index": F.when(p == 999, 5).otherwise(F.col("frame_index")), "is_good_frame": F.when(p == 999, 1 - F.col("is_good_frame")).otherwise(F.col("is_good_frame")), "digest": F.when(p == 1003, "y").otherwise(F.col("digest")), "image": F.when(p == 1003, F.col("image")).when(p == 1005, F.substring("image", 1, 2 * P)).otherwise(F.col("image"))})
    assert check(others) == [(999, "frame_index"), (999, "is_good_frame"), (1003, "digest")]
    assert (1005, "n_bytes") in check(others, deep=True)
    plan = xp.verify_pixels(e, spark, path, 3, payload=P)
    assert plan.count() == 0 and check(e.limit(0)) == []


@pytest.mark.parametrize("rows", [3, 10_000])
def test_payload_of_many_frames(spark, rows) -> None:
    """No group of its own for each frame; frames go on over batches, null keys are a key, the last of duplicates counts."""
    packets = [(m, f, 10 * f + n, n % 5, bytearray([f, n])) for m in (0, 1, None) for f in range(9) for n in range(7) if (f + n) % 4]
    df = spark.createDataFrame(packets, "module_id int, frame_no long, seq long, packetnum int, data binary")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        made = px.assemble_payload(df, ["module_id", "frame_no"], 4, 2)
        got = {(r.module_id, r.frame_no): bytes(r.payload) for r in made.collect()}
    finally:
        spark.conf.set(key, before)
    want = {}
    for m, f, _, n, x in packets:
        own = want.setdefault((m, f), bytearray(8))
        if n < 4:
            own[2 * n : 2 * n + 2] = x
    assert got == {k: bytes(v) for k, v in want.items()} and len(got) == 27
    assert "FlatMapGroups" not in made._jdf.queryExecution().executedPlan().toString()
