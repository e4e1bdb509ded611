"""What the operators of this subpackage share."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path

# A word is a run of anything but ASCII white space; bytes.split() cuts at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
# Characters of text that one step inside a task holds.
SLICE_CHARS = 2_000_000


def by_value(name: str) -> None:
    """Tasks receive this module's functions by value, so executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


by_value(__name__)


def table(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Keys that are sent to all tasks, at most: 32 MB of two numbers each.
MOST_KEYS = 2_000_000


def narrowed(df: DataFrame, keys: DataFrame, on: list[str], most: int = MOST_KEYS) -> DataFrame:
    """Rows of ``df`` joined to a stored table of distinct keys.

    Few keys are broadcast, so that the wide side isn't shuffled; their number
    is counted first, and beyond the bound both sides are shuffled.
    """
    return df.join(F.broadcast(keys) if keys.count() <= most else keys, on)


def pieces(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def bucket(n: Column | int, *cols: str | Column) -> Column:
    """A stable bucket below ``n`` from the hash of ``cols``."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(F.xxhash64(*cols), n.cast("long")).cast("int")


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key's text modulo ``n``; a missing key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def word_count(text: str | Column) -> Column:
    """Number of words, 0 without text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with at most ``limit`` bytes of text (one row at least), and the texts as bytes."""
    column = batch.column(text).cast(pa.large_binary())
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1])
    start = 0
    while start < len(sizes):
        total = np.cumsum(sizes[start:])
        stop = start + max(1, int(np.searchsorted(total, limit, side="right")))
        part = [x or b"" for x in column.slice(start, stop - start).to_pylist()]
        yield batch.slice(start, stop - start), part
        start = stop


SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
BASE = np.uint64(0xD1342543DE82EF95)
# Powers of BASE and of its inverse modulo 2**64, as long as the longest slice so far.
POWERS: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    if not POWERS or len(POWERS[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(BASE), -1, 2**64))
        POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)])) for b in (BASE, inverse)]
    return POWERS


def hashed_words(part: pa.RecordBatch, text: str, lower: bool = False, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a batch, and where each row's words begin (one entry more than rows).

    A word's hash is a polynomial over its bytes, taken from running sums, so
    that no word becomes an object. ``lower`` folds A to Z first; ``between``
    marks the bytes that part words.
    """
    column = part.column(text).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~between[data]
    # A text's first byte begins a word even if the text before ends in one.
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts]), np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit numbers (the finaliser of splitmix64, constants fixed)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive word hashes; empty below ``k`` words. Doubles its span step by step."""
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    done, span, have, power = None, 0, mix64(words), 1
    # have[i] covers `power` words from i; done[i] covers `span` words from i.
    rest = k
    while rest:
        if rest & 1:
            if done is None:
                done, span = have, power
            else:
                m = len(words) - span - power + 1
                done = mix64(done[:m] * odd + have[span : span + m])
                span += power
        rest >>= 1
        if rest:
            m = len(words) - 2 * power + 1
            have = mix64(have[:m] * odd + have[power : power + m])
            power *= 2
    return done[:n]


def spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers begin[i] to begin[i] + length[i] - 1 of all i, one after another."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + length, length)


def distinct(points: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each group of equal stretches of ``points``, and the group of every stretch."""
    up, down = powers(len(points))
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
    hashes = mix64((sums[begin + length] - sums[begin]) * down[begin])
    _, chosen, same = np.unique(hashes, return_index=True, return_inverse=True)
    # Equal hashes prove nothing: compare with the stretch that stands for the group.
    equal = (length == length[chosen][same]).all() and (points[spread(begin, length)] == points[spread(begin[chosen][same], length)]).all()
    return (chosen, same) if equal else (np.arange(len(begin)), np.arange(len(begin)))
