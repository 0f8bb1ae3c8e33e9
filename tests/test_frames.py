"""Frame assembly, guard and upserts."""

from __future__ import annotations

import random

import pytest

from pulseframe.operators import frames as fr

SCHEMA = "module_id int, seq long, pulse_id long, framenum long, debug long, packetnum int"


def packets(spark, n_frames: int, expected: int, missing: int | None = None, module: int = 3):  # noqa: ANN001, ANN201
    rows, seq = [], 0
    for f in range(n_frames):
        for p in range(expected):
            if p != missing:
                rows.append((module, seq, f + 1, f + 1000, f + 10000, p))
                seq += 1
    random.Random(1).shuffle(rows)  # arrival order is seq, not row order
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("dialect,expected", [(1, 128), (2, 4096)])
@pytest.mark.parametrize("missing,n_out", [(None, 3), (10, 3), (0, 3), (-1, 2)])
def test_assembly(spark, dialect, expected, missing, n_out) -> None:
    if expected == 4096 and missing not in (None, -1):
        pytest.skip("as with 128")
    gap = expected - 1 if missing == -1 else missing
    got = fr.packets_to_frames(packets(spark, 3, expected, gap), expected, dialect).orderBy("pulse_id").collect()
    assert len(got) == n_out
    for i, r in enumerate(got):
        assert (r.pulse_id, r.frame_index, r.daq_rec, r.module_id) == (i + 1, i + 1000, i + 10000, 3)
        assert r.n_recv_packets == r.n_distinct_packets == expected - (gap is not None)


def test_open_frame_only_on_demand(spark) -> None:
    df = packets(spark, 2, 8, 7)
    assert fr.packets_to_frames(df, 8).count() == 1
    assert fr.packets_to_frames(df, 8, emit_open=True).count() == 2


def test_duplicates_stragglers_and_wild_packets(spark) -> None:
    rows = [(0, i, 5, 50, 1, p) for i, p in enumerate([0, 1, 1, 2, 3])]  # a duplicate, then the last packet
    rows += [(0, 5, 5, 50, 1, 2), (0, 6, 6, 51, 1, 99), (0, 7, 6, 51, 1, 0), (0, 8, 6, 51, 1, 3)]  # straggler, wild number
    rows += [(1, 9, 0, 7, 1, 0), (1, 10, 0, 7, 1, 3)]  # pulse 0: no frame
    got = fr.packets_to_frames(spark.createDataFrame(rows, SCHEMA), 4).orderBy("seq").collect()
    assert [(r.n_recv_packets, r.n_distinct_packets) for r in got] == [(5, 4), (1, 1), (2, 2)]


def test_guard(spark) -> None:
    rows = [(0, 0, 1, 1), (0, 1, 2, 2), (0, 2, 2, 3), (0, 3, 1, 4), (0, 4, 1003, 5), (0, 5, 1004, 7), (0, 6, 1005, 8)]
    df = spark.createDataFrame(rows, "module_id int, seq long, pulse_id long, frame_index long")
    bad = [r.bad for r in fr.flag_sequence(df).orderBy("seq").collect()]
    assert bad == [False, False, True, True, True, True, False]
    again = [r.bad for r in fr.flag_sequence(df, allow_repeat=True).orderBy("seq").collect()]
    assert again == [False, False, False, True, True, True, False]
    assert fr.accepted(df).count() == 3


def test_first_frame_is_bad_unless_it_starts_the_count(spark) -> None:
    df = spark.createDataFrame([(0, 0, 5000, 900), (0, 1, 5001, 901)], "module_id int, seq long, pulse_id long, frame_index long")
    assert [r.bad for r in fr.flag_sequence(df).orderBy("seq").collect()] == [True, False]


def test_latest_and_recent(spark) -> None:
    df = spark.createDataFrame([(0, 0, 1, 10), (0, 1, 1, 11), (0, 2, 2000, 12), (1, 3, 5, 13)], "module_id int, seq long, pulse_id long, frame_index long")
    assert sorted(r.frame_index for r in fr.latest_per_key(df).collect()) == [11, 12, 13]
    assert sorted(r.frame_index for r in fr.recent_frames(df).collect()) == [12, 13]


def test_thin_keeps_rows(spark) -> None:
    df = spark.range(100).withColumnRenamed("id", "pulse_id").selectExpr("pulse_id", "pulse_id as data")
    assert fr.thin(df, 10, ["data"]).where("data is not null").count() == 10
    assert fr.thin(df, 1, ["data"]).where("data is not null").count() == 100
    some = fr.thin(df, 2, ["data"], seed=3)
    assert some.count() == 100 and 20 < some.where("has_data").count() < 80
    kept = lambda n, seed: sorted(r.pulse_id for r in fr.thin(df.repartition(n), 2, ["data"], seed=seed).where("has_data").collect())
    assert kept(1, 3) == kept(8, 3) != kept(1, 4)


def test_shards_and_run_guard(spark) -> None:
    df = spark.createDataFrame([(1, i) for i in range(10)], "run_id long, i_image long")
    assert sorted(r.i_image for r in fr.writer_shard(df, 3, 1).collect()) == [1, 4, 7]
    assert fr.writer_shard(df, 3).rdd.getNumPartitions() == 3
    with pytest.raises(Exception, match="row of another run"):
        fr.run_id_guard(df, 2, strict=True).collect()
    assert fr.run_id_guard(df, 2).count() == 0


def test_modules_of_the_second_dialect(spark) -> None:
    df = spark.createDataFrame([(0, 0), (0, 127), (0, 128), (0, 4095)], "module_id int, packetnum int")
    assert sorted(tuple(r) for r in fr.split_modules(df).collect()) == [(0, 0), (0, 127), (1, 0), (31, 127)]


@pytest.mark.parametrize("share", [3, 50, 10**9])
def test_shares_of_the_arrival_order_change_nothing(spark, share) -> None:
    rng = random.Random(share)
    rows, index, pulse = [], [0, 0], [0, 0]
    for seq in rng.sample(range(0, 2000, 2), 600):
        rows.append([rng.randrange(2), seq])
    rows.sort(key=lambda r: r[1])
    for r in rows:
        m = r[0]
        index[m] += 1 if rng.random() < 0.9 else 2
        pulse[m] += rng.choice([1, 1, 1, 1, 2, 0, -1, 1200])
        r += [pulse[m], index[m], rng.randrange(4), index[m] // 4]
    want = {}
    for m in (0, 1):
        before = (0, 0, None, None)
        no = 0
        for _, seq, p, i, n, num in (r for r in rows if r[0] == m):
            no += before[3] is None or before[3] != num or before[2] == 3
            want[m, seq] = (i != before[1] + 1 or p - before[0] <= 0 or p - before[0] > 1000, no)
            before = (p, i, n, num)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "module_id int, seq long, pulse_id long, frame_index long, packetnum int, framenum long")
    got = {(r.module_id, r.seq): r for r in fr.frame_boundaries(fr.flag_sequence(df, share=share), 4, share=share).collect()}
    assert {k: (r.bad, r.frame_no) for k, r in got.items()} == want
    for start, stop in ((1, 400), (5000, 9000), (20_000, 30_000), (10**6, 10**7)):
        part = fr.accepted_in_range(df, start, stop, share=share)
        assert sorted((r.module_id, r.seq) for r in part.collect()) == sorted(k for k, r in got.items() if not r.bad and start <= r.pulse_id <= stop)


@pytest.mark.parametrize("share", [1, 5, 40, 10**9])
@pytest.mark.parametrize("dialect", [1, 2])
def test_frames_over_the_ends_of_shares(spark, share, dialect) -> None:
    """Frames that begin and end in other shares, repeats, holes, frames of pulse 0, and the open one of each module."""
    rng, rows, seq = random.Random(share), [], 0
    for f in range(60):
        for m in (0, 1):
            for n in range(70):
                for _ in range(1 + (rng.random() < 0.05)):
                    if rng.random() > (0.9 if f % 7 == 3 else 0.1) and (f < 59 or n < 30):
                        rows.append((m, seq, 0 if f == 20 else 100 + f + (n > 60), 100 + f // (2 if f % 11 == 0 else 1), f, n))
                    seq += 1
    rows.sort(key=lambda r: r[1])
    want = []
    for m in (0, 1):
        held, number = [], 0
        own = [r for r in rows if r[0] == m]
        for i, r in enumerate(own):
            if held and (held[-1][3] != r[3] or held[-1][5] == 69):
                held = []
            number += not held
            held.append(r)
            end = i + 1 == len(own)
            if end or own[i + 1][3] != r[3] or r[5] == 69:
                meta = held[0] if dialect == 1 else held[-1]
                if meta[2] > 0:
                    want.append((m, meta[2], meta[3], meta[4], len(held), len({x[5] for x in held}), held[0][1], number, not end or r[5] == 69))
    df = spark.createDataFrame(rows, "module_id int, seq long, pulse_id long, framenum long, debug long, packetnum int").repartition(3)
    names = ["module_id", "pulse_id", "frame_index", "daq_rec", "n_recv_packets", "n_distinct_packets", "seq", "frame_no"]
    got = fr.packets_to_frames(df, 70, dialect, emit_open=True, share=share, numbered=True).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(r[:8] for r in want)
    closed = fr.packets_to_frames(df, 70, dialect, share=share).select(*names[:-1])
    assert sorted(map(tuple, closed.collect())) == sorted(r[:7] for r in want if r[8])
    assert len(want) > sum(r[8] for r in want)


def test_raw_sizes_and_markers(spark) -> None:
    df = spark.createDataFrame([(1, bytearray(8240), 0xBE), (2, bytearray(8239), 0), (3, None, None)], "seq long, raw binary, marker int")
    assert [r.seq for r in fr.valid_datagram(df).collect()] == [1]
    assert [r.seq for r in fr.present(df).collect()] == [1]
