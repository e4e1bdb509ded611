"""Streams that remember: repeated rows of a log, and the newest rows of each client."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which keyed processors need; the setting is put back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def distinct_stream(stream: DataFrame, ts: str, delay: str, columns: list[str] | None = None) -> DataFrame:
    """Each row of a log once, as long as its copies come within ``delay`` of event time.

    Rows are equal if all ``columns`` are (every column by default, nulls
    equal). The state is one hash a row and is dropped when the watermark has
    passed the row's time by ``delay``; rows older than the watermark, and rows
    without a time, are left out.
    """
    columns = columns or stream.columns
    row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    timed = stream.filter(F.col(ts).isNotNull()).withColumn("_time", F.col(ts).cast("timestamp")).withWatermark("_time", delay)
    return timed.withColumn("_row", row).dropDuplicatesWithinWatermark(["_row"]).select(*stream.columns)


def newest(rows: list[tuple], order: list[int], n: int) -> list[tuple]:
    """The first ``n`` rows, largest first by the values at ``order``; a missing value is the smallest, ties keep their order."""
    return sorted(rows, key=lambda r: [(r[i] is not None, r[i]) if r[i] is not None else (False,) for i in order], reverse=True)[:n]


class NewestRows(StatefulProcessor):
    """The ``n`` newest rows of a client in a list state; the whole list goes out whenever rows come."""

    def __init__(self, client: str, columns: list[str], order: list[str], n: int, state: T.StructType, keep_ms: int | None):
        self.client, self.columns, self.order, self.n, self.state, self.keep_ms = client, columns, order, n, state, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.state, ttlDurationMs=self.keep_ms)
        self.version = handle.getValueState("version", "version long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = [tuple(r) for r in self.rows.get()]
        order = [self.columns.index(c) for c in self.order]
        whole = [isinstance(f.dataType, T.IntegralType) for f in self.state.fields]
        # A part of a client's rows at a time, so that a busy client needs no more memory. There are few rows a client
        # and many clients: plain tuples cost a fraction of a table of each.
        for some in rows:
            held = newest([*held, *zip(*map(listed, [some[c] for c in self.columns], whole))], order, self.n)
        self.rows.put(held)
        version = ((self.version.get() or (0,))[0] or 0) + 1
        self.version.update((version,))
        data = {self.client: [key[0]] * len(held), "version": [version] * len(held), "rank": range(1, len(held) + 1)}
        values = zip(*held) if held else [()] * len(self.columns)
        yield pd.DataFrame(data | {c: pd.Series(v, dtype=object) for c, v in zip(self.columns, values)})

    def close(self) -> None:
        pass


def listed(column: pd.Series, whole: bool = False) -> list:
    """Values as state takes them; a missing one is None. Whole numbers with gaps come as floats."""
    values = column.tolist()
    if column.dtype.kind == "M":
        return [None if x is pd.NaT else x.to_pydatetime() for x in values]
    if column.dtype.kind in "iub":
        return values
    return [None if missing else int(x) if whole else x for x, missing in zip(values, column.isna().tolist())]


def newest_stream(stream: DataFrame, client: str, order: list[str], n: int = 30, keep_ms: int | None = None) -> DataFrame:
    """(client, version, rank, columns): the ``n`` newest rows of each client that gets rows, after each of its batches.

    ``order`` are the columns that make a row newer, the last ones to break
    ties. A batch is cut to n rows a client before it is shuffled. ``keep_ms``
    drops what a client was given that long ago. Start it inside
    ``keyed_state``. Rows without a client are left out.
    """
    columns = [c for c in stream.columns if c != client]
    state = T.StructType([stream.schema[c] for c in columns])

    def trimmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values(order, ascending=False, kind="stable").groupby(client, sort=False).head(n)

    out = T.StructType([stream.schema[client], T.StructField("version", T.LongType()), T.StructField("rank", T.LongType()), *state.fields])
    cut = stream.filter(F.col(client).isNotNull()).mapInPandas(trimmed, stream.schema)
    return cut.groupBy(client).transformWithStateInPandas(
        NewestRows(client, columns, order, n, state, keep_ms), out, outputMode="Append", timeMode="ProcessingTime" if keep_ms else "None"
    )


def last_versions(lists: DataFrame, client: str) -> DataFrame:
    """The last list of each client from a table of all of them."""
    last = Window.partitionBy(client).orderBy(F.desc("version"))
    return lists.withColumn("_n", F.dense_rank().over(last)).filter("_n = 1").drop("_n", "version")
