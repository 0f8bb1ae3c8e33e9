"""Queries against their SQL on events that the driver's tables rarely hold."""

from __future__ import annotations

import duckdb
import pandas as pd

from __spark_entry__ import oracle_sql, queries


def events(path, rows: list[tuple[int, str, float]]) -> str:  # noqa: ANN001
    """A folder with a table of (event_id, event_type, value)."""
    t = pd.DataFrame(rows, columns=["event_id", "event_type", "value"]).astype({"event_id": "int64", "value": "float64"})
    t["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(t.event_id, unit="s")
    t.to_parquet(path / "events.parquet", coerce_timestamps="us")
    return str(path)


def same(spark, name: str, d: str) -> list[tuple]:  # noqa: ANN001
    """The query's rows, which are its SQL's."""
    got = queries()[name](spark, d)
    c = duckdb.connect()
    c.execute(f"create view events as select * from '{d}/events.parquet'")
    found = c.execute(oracle_sql()[name])
    assert [x[0] for x in found.description] == got.columns
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == sorted(found.fetchall(), key=repr)
    return rows


def twice() -> tuple[int, list[tuple[int, str, float]]]:
    """(number, events): a module's frame without its last packet, and another frame of that number after it, between whose
    packets the payload's values start anew."""
    at = next(s for s in range(0, 10**5, 4) if (s * 31 + 7 * 17) % 97 == 0 and s * 8 % 1000 >= 976)
    return at, [(at - 4, "view", 10.0), (at, "error", 200.0), (at + 4, "view", 10.0), (at + 8, "view", 10.0)]


def test_a_packet_that_comes_twice(spark, tmp_path) -> None:
    at, rows = twice()
    got = same(spark, "prj19_payload", events(tmp_path, rows))
    assert len(got) == 3 * 16 and (at * 8 + 32) % 1000 in {r[3] for r in got}


def test_images_without_a_complete_module(spark, tmp_path) -> None:
    rows = [(16 + i, "view", 0.5 if i < 4 else 10.0) for i in range(12)]
    got = same(spark, "st3_stream_images", events(tmp_path, rows))
    assert ("JF02", 5, 0, 0, False) in got and ("JF02", 6, 7, 1, True) in got


def test_frames_are_numbered(spark, tmp_path) -> None:
    got = same(spark, "agg1_frames", events(tmp_path, [(i, "view", 10.0) for i in range(4, 40) if i != 21]))
    assert {r[1] for r in got if r[0] == 1} == set(range(1, 9))
