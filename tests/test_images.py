"""Fold, alignment and losses."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import images as im
from pulseframe.operators import sync as sy
from pulseframe.operators import stats as st

SCHEMA = "module_id int, pulse_id long, frame_index long, daq_rec long, n_recv_packets long"


def test_fold(spark) -> None:
    rows = [(m, 123523, 12342300, 1234, 128) for m in range(3)]
    r = im.assemble_images(spark.createDataFrame(rows, SCHEMA), 3).first()
    assert (r.pulse_id, r.frame_index, r.daq_rec, r.is_good_image) == (123523, 12342300, 1234, True)


@pytest.mark.parametrize(
    "rows,want",
    [
        ([(m, 1, 0, 0, 0) for m in range(3)], (0, 0, False)),  # nothing complete
        ([(0, 1, 9, 7, 127), (1, 1, 5, 6, 128), (2, 1, 5, 6, 128)], (5, 6, False)),  # the lowest complete module
        ([(0, 1, 9, 6, 128), (1, 1, 5, 6, 128), (2, 1, 5, 6, 128)], (9, 6, False)),  # module 0 disagrees, and still names it
        ([(0, 1, 5, 7, 128), (1, 1, 5, 6, 128), (2, 1, 5, 6, 128)], (5, 7, False)),
        ([(0, 1, 5, 6, 128), (1, 1, 5, 6, 128)], (5, 6, False)),  # one is missing
        ([(0, 1, 5, 6, 129), (1, 1, 5, 6, 128), (2, 1, 5, 6, 128)], (5, 6, False)),  # a duplicate packet
    ],
)
def test_fold_faults(spark, rows, want) -> None:
    r = im.assemble_images(spark.createDataFrame(rows, SCHEMA), 3).first()
    assert (r.frame_index, r.daq_rec, r.is_good_image) == want


def test_a_repeated_frame_does_not_stand_for_another_module(spark) -> None:
    rows = [(0, 0, 1, 5, 7, 128), (1, 0, 1, 5, 7, 128), (2, 1, 1, 5, 7, 128), (3, 2, 1, 5, 7, 128)]
    rows += [(4, m, 2, 5, 7, 128) for m in range(4)] + [(5, 2, 2, 6, 7, 128)]  # the last write of a slot counts
    rows += [(6, m, 3, 5, 7, 128) for m in range(4)] + [(7, 3, 3, 5, 7, 127), (8, 9, 3, 5, 7, 128)]  # a module beyond the last
    got = {r.pulse_id: r for r in im.assemble_images(spark.createDataFrame(rows, "seq long, " + SCHEMA), 4).collect()}
    assert [(got[p].is_good_image, got[p].n_good_modules, got[p].frame_index) for p in (1, 2, 3)] == [(False, 3, 5), (False, 4, 5), (False, 3, 5)]


def test_daq_rec_is_optional(spark) -> None:
    rows = [(0, 1, 5, 7, 128), (1, 1, 5, 6, 128)]
    assert im.assemble_images(spark.createDataFrame(rows, SCHEMA), 2, check_daq_rec=False).first().is_good_image


def simulated(notices: dict[int, list[int]], limit: int = 100, rounds: int = 3) -> tuple[list[tuple], list[tuple]]:
    """The synchroniser as its description has it: take one notice of each; while they differ, each discards up to the
    newest; the most discarded by one module count, round by round. (aligned pulses with lost and what went wrong, the first
    thing that goes wrong after each aligned pulse)."""
    at = dict.fromkeys(notices, 0)
    out, bad = [], []
    while all(at[m] < len(notices[m]) for m in notices):
        lost, n_rounds, wrong = 0, 0, None
        while True:
            heads = {m: notices[m][at[m]] for m in notices}
            goal = max(heads.values())
            if min(heads.values()) == goal:
                break
            n_rounds += 1
            kind = "rounds" if n_rounds > rounds else "offset" if goal - min(heads.values()) > limit else None
            if kind and not wrong:
                wrong = kind
                bad.append((goal, kind))
            gone = 0
            for m in notices:
                n = 0
                while at[m] < len(notices[m]) and notices[m][at[m]] < goal:
                    at[m] += 1
                    n += 1
                gone = max(gone, n)
            lost += gone
            if any(at[m] >= len(notices[m]) for m in notices):
                return out, bad
        out.append((goal, lost, wrong))
        for m in notices:
            at[m] += 1
    return out, bad


def events(df, n_modules: int, **rules: int) -> dict:  # noqa: ANN001
    """By detector, as simulated() has it."""
    out: dict = {}
    for r in sy.sync_events(df, n_modules, **rules).collect():
        aligned, bad = out.setdefault(r.detector_name, ([], []))
        (aligned.append((r.pulse_id, r.n_lost_pulses, r.violation)) if r.event == "aligned" else bad.append((r.pulse_id, r.event)))
    return {d: (sorted(a), sorted(b)) for d, (a, b) in out.items()}


def rows_of(notices: dict, rng: random.Random) -> list[tuple]:
    rows = [(d, m, p) for d in notices for m in notices[d] for p in notices[d][m]]
    rng.shuffle(rows)
    return rows


SYNC = "detector_name string, module_id int, pulse_id long"


@pytest.mark.parametrize("share", [3, 17, 50_000])
def test_sync_exact_equals_simulation(spark, share) -> None:
    """Detectors that lose little and much, never align, lose a module for good or for long, or stop in a stretch, under
    narrow and wide limits, in shares of any size."""
    rng = random.Random(share)
    some = lambda lost, last=400: {m: [p for p in range(1, last) if rng.random() > lost] for m in range(4)}
    notices = {"few": some(0.02), "many": some(0.4), "most": some(0.8), None: some(0.3)}
    notices["apart"] = {m: [p for p in range(1, 400) if p < 50 or p % 4 == m] for m in range(4)}
    notices["gone"] = {m: [p for p in range(1, 400) if m != 2 or p < 100] for m in range(4)}
    notices["away"] = {m: [p for p in range(1, 400) if (m != 1 or not 100 < p < 350) and rng.random() > 0.1] for m in range(4)}
    notices["ahead"] = {m: [p + 1900 * (m == 0 and p > 10) for p in range(1, 60)] for m in range(4)}
    notices["never"] = {m: [4 * p + m for p in range(60)] for m in range(4)}
    rows = rows_of(notices, rng)
    rows += [("few", 4, p) for p in range(1, 300)] + [("few", None, 5), ("few", 1, None), *rows[:50]]
    df = spark.createDataFrame(rows, SYNC).repartition(3)
    for limit, rounds in ((100, 3), (1, 1), (20, 2), (1000, 10)):
        got = events(df, 4, limit=limit, rounds=rounds, share=share)
        for d in notices:
            assert got.get(d, ([], [])) == simulated(notices[d], limit, rounds), (d, limit, rounds)
    sets = {(r.detector_name, r.pulse_id): r.n_lost_pulses for r in im.sync_loss(df.where("detector_name = 'many' and module_id < 4"), 4, share=10).withColumn("detector_name", F.lit("many")).collect()}
    exact = {("many", p): n for p, n, _ in simulated(notices["many"])[0]}
    assert sets.keys() == exact.keys() and all(n >= sets[k] for k, n in exact.items())


def test_a_stretch_without_a_common_pulse_is_read_by_several_tasks(spark) -> None:
    """Summaries of shares stand in for the shares: one long stretch, whose violation is far from its start."""
    rng = random.Random(8)
    notices = {"JF": {m: [p for p in range(1, 4000) if p % 4 == m or p in (1, 3900)] for m in range(4)}}
    df = spark.createDataFrame(rows_of(notices, rng), SYNC)
    assert events(df, 4, limit=3, rounds=700, share=100)["JF"] == simulated(notices["JF"], 3, 700)
    made = []
    for n in (100, 50_000):
        plan = sy.sync_events(df, 4, share=n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            made.append(plan.withColumn("task", F.spark_partition_id()).groupBy("task").count().count())
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = df.where("pulse_id > 1 and pulse_id < 3900")
    assert sy.sync_pulses(rows, 4, share=100).count() == 0 and sy.sync_violations(rows, 4, share=100).count() == 1
    with pytest.raises(ValueError, match="at most 62"):
        sy.sync_events(df, 63)
    assert made[0] >= made[1]


def test_summaries_carry_any_state(spark) -> None:
    """A state carried over summaries of shares is the state that reading their pulses gives."""
    rng = random.Random(2)
    for _ in range(300):
        n, lost = rng.choice([2, 3, 5]), rng.choice([0.2, 0.6, 0.9])
        rules = sy.Rules(n, rng.choice([1, 4, 50]), rng.choice([1, 3, 20]))
        pulses = [p for p in range(1, 60) if rng.random() > 0.1]
        held = [sum(1 << m for m in range(n) if rng.random() > lost) or 1 for _ in pulses]
        read, carried = sy.State(), sy.State()
        for a in range(0, len(pulses), 7):
            for p, h in zip(pulses[a : a + 7], held[a : a + 7], strict=True):
                if len(read.first) == n and len(set(read.first.values())) == 1:
                    read = sy.State()
                rules.take(read, p, rules.modules(h))
            carried = sy.carry(rules, carried, sy.summarise(rules, pulses[a : a + 7], held[a : a + 7]))
            assert rules.fresh(carried) == rules.fresh(read)


def test_forms_differ_where_rounds_add_up(spark) -> None:
    """Two rounds that each discard one notice of another module: the exact form counts both."""
    rows = [("JF", 0, p) for p in (1, 4)] + [("JF", 1, p) for p in (2, 4)] + [("JF", 2, p) for p in (2, 3, 4)]
    df = spark.createDataFrame(rows, SYNC)
    assert [tuple(r)[1:] for r in sy.sync_pulses(df, 3).collect()] == simulated({0: [1, 4], 1: [2, 4], 2: [2, 3, 4]})[0]
    assert im.sync_loss(df, 3).first().n_lost_pulses == 2


def test_violations(spark) -> None:
    """Of modules that align again, and of two that stay 1,900 pulses apart for good."""
    rows = [("JF", 0, p) for p in (1, 500)] + [("JF", 1, 500)]
    tail = [("T", m, p + 1900 * (m == 1 and p > 10)) for m in range(2) for p in range(1, 100)]
    df = spark.createDataFrame(rows + tail, SYNC)
    assert sorted(map(tuple, sy.sync_violations(df, 2).collect())) == [("JF", 500, "offset"), ("T", 1911, "offset")]
    assert sy.sync_pulses(df, 2).where("detector_name = 'T'").count() == 10
    with pytest.raises(Exception, match="out of sync at pulse 1911"):
        sy.sync_violations(df.where("detector_name = 'T'"), 2, strict=True).collect()


def test_reconcile_reports_missing_and_payloads(spark) -> None:
    schema = "pulse_id long, frame_index long, daq_rec long, is_good_image boolean, payload binary"
    a = spark.createDataFrame([(1, 1, 1, True, b"x"), (2, 2, 1, True, b"y"), (3, 3, 1, True, b"z")], schema)
    b = spark.createDataFrame([(1, 1, 1, True, b"x"), (2, 2, 1, True, b"Y")], schema)
    got = {(r.pulse_id, r.field) for r in im.reconcile(a, b, payload="payload").collect()}
    assert got == {(2, "payload"), (3, "frame_index"), (3, "daq_rec"), (3, "is_good_image"), (3, "payload")}


def test_detector_join(spark) -> None:
    detectors = spark.createDataFrame([("JF", 4)], "detector_name string, n_modules int")
    assert im.with_detector(spark.createDataFrame([("JF", 1), ("XX", 2)], "detector_name string, v int"), detectors).count() == 1


def test_index_and_buckets_over_files(spark) -> None:
    pulses = [1, 999, 1000, 1001, 5000, 123456, 123457]
    df = spark.createDataFrame([(p,) for p in pulses], "pulse_id long")
    assert [(r.pulse_id, r.i_image) for r in st.image_index(df).orderBy("pulse_id").collect()] == list(zip(pulses, range(7), strict=True))
    assert sorted(r.bucket for r in st.count_buckets(df, 3).collect()) == [0, 0, 0, 1, 1, 1]


def test_empty_run_has_no_throughput(spark) -> None:
    rows = [(1, 0, 512, 1024, 16)]
    r = st.run_write_stats(spark.createDataFrame(rows, "run_id long, write_us long, image_y_size int, image_x_size int, bits_per_pixel int")).first()
    assert r.n_bytes == 1 << 20 and r.mib_per_s is None


def test_trusted_sources_and_strict_notices(spark) -> None:
    rows = [(0, 1, 5, 7, 3), (1, 1, 5, 6, 128)]
    frames = spark.createDataFrame(rows, SCHEMA)
    assert im.assemble_images(frames, 4, trust_source=True).first().is_good_image
    notices = spark.createDataFrame([(0, 1), (1, 2)], "module_id int, pulse_id long")
    assert [r.module_id for r in im.frames_for_notices(notices, frames).collect()] == [0]
    with pytest.raises(Exception, match="no frame for the notice of pulse 2"):
        im.frames_for_notices(notices, frames, strict=True).collect()
