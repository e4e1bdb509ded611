"""Streams with state: copies of log rows, late rows, restarts, the newest rows of each client."""

import datetime
import random

import pandas as pd
import pytest

from ledgerlens.session import scratch_path
from ledgerlens.streaming import scoring, state

LOG = "id long, ts timestamp, name string, amount double"


def at(minute):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)


def runs(spark, schema, parts, make, name, keyed=False):
    """Append each part to a folder and drain the stream, every time from its checkpoint."""
    folder, table, out = scratch_path(spark, name), scratch_path(spark, f"{name}-table"), None
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = make(scoring.read_files(spark, folder, spark.createDataFrame([], schema).schema))
        if keyed:
            with state.keyed_state(spark):
                out = scoring.drain_to_table(stream, name, table)
        else:
            out = scoring.drain_to_table(stream, name, table)
    return out


def test_copies_go_once_also_late_and_after_a_restart(spark):
    first = [(i, at(i), f"n{i}" if i % 5 else None, None if i % 7 == 0 else float(i)) for i in range(60)]
    second = [(i, at(i), "other", float(i)) for i in range(60, 120)]
    parts = [first + first[:30], second + first[40:] + second[::2], first[50:]]
    out = runs(spark, LOG, parts, lambda s: state.distinct_stream(s, "ts", "90 minutes"), "once")
    assert sorted(map(tuple, out.collect()), key=lambda r: r[0]) == sorted(first + second, key=lambda r: r[0])


def test_rows_older_than_the_watermark_and_rows_without_time(spark):
    """Equal ids with unlike values are unlike rows; a null time takes no part."""
    parts = [[(1, at(0), "a", 1.0), (1, at(0), "a", 2.0), (2, None, "b", 1.0)], [(3, at(500), "c", 1.0)], [(4, at(501), "d", 1.0)], [(1, at(0), "a", 1.0)]]
    out = runs(spark, LOG, parts, lambda s: state.distinct_stream(s, "ts", "10 minutes"), "late")
    assert sorted((r.id, r.amount) for r in out.collect()) == [(1, 1.0), (1, 2.0), (3, 1.0), (4, 1.0)]
    chosen = runs(spark, LOG, parts[:1], lambda s: state.distinct_stream(s, "ts", "10 minutes", ["id"]), "by-id")
    assert chosen.count() == 1


@pytest.mark.parametrize("n", [1, 4])
def test_newest_rows_of_each_client(spark, n):
    rng = random.Random(n)
    # One client has a third of the rows; times are equal now and then.
    rows = [(i, at(rng.randrange(50)), rng.choice(["hot", "a", "b", "c", None]) if i % 3 else "hot", None if i % 9 == 0 else float(i)) for i in range(150)]
    parts = [rows[i::3] for i in (1, 0, 2)]
    lists = runs(spark, LOG, parts, lambda s: state.newest_stream(s, "name", ["ts", "id"], n), "newest", keyed=True)
    found = {}
    for r in state.last_versions(lists, "name").collect():
        found.setdefault(r.name, {})[r["rank"]] = (r.id, r.ts, r.amount)
    for name in ("hot", "a", "b", "c"):
        want = sorted((r for r in rows if r[2] == name), key=lambda r: (r[1], r[0]), reverse=True)[:n]
        assert [found[name][i + 1] for i in range(len(want))] == [(r[0], r[1], r[3]) for r in want]
    assert set(found) == {"hot", "a", "b", "c"}


def test_the_state_setting_is_put_back(spark):
    before = spark.conf.get(state.PROVIDER, None)
    with state.keyed_state(spark):
        assert spark.conf.get(state.PROVIDER) == state.ROCKSDB
    assert spark.conf.get(state.PROVIDER, None) == before


def test_a_client_costs_little(spark):
    """Rows of a client stay plain values: newest first, missing values last, ties in the order they came, whole numbers whole."""
    rows = [(1, 5.0), (2, None), (3, 7.0), (4, 5.0)]
    assert state.newest(rows, [1], 3) == [(3, 7.0), (1, 5.0), (4, 5.0)] and state.newest(rows, [1], 9)[-1] == (2, None)
    assert state.listed(pd.Series([1.0, None, 3.0]), True) == [1, None, 3]
    assert state.listed(pd.Series([pd.Timestamp("2024-01-01"), pd.NaT])) == [datetime.datetime(2024, 1, 1), None]
