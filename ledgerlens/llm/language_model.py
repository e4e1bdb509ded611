"""Scoring of texts by a smoothed n-gram model in an Elias-Fano trie.

Level 1 holds the words: their 64-bit hashes as a monotone Elias-Fano sequence
(a word's number is its rank), their exact counts and the share of probability
that is left to the shorter context. Level 2 holds the word pairs, those that
occur once as well: the contexts that have successors, monotone pointers to their
ranges, and the successors as one monotone sequence, made so by adding a
multiple of the vocabulary's size for each context before, so that a pair is
found by a search relative to its context. Probabilities are quantised to a
byte, rounded down; what rounding leaves goes to the shorter context.

    p(w)   = (c(w) + 1) / (N + V + 1)
    p(w|h) = max(c(hw) - D, 0) / c(h) + left(h) p(w)

Levels are files of bounded size in the shared folder, one for each range of
numbers, written by the tasks that gathered the range. Scoring maps them into
memory; where the folder is no mounted file system they are read whole, one at
a time. Counts are summed per task before they are shuffled, a hot context may
span several files, and no level passes through the driver, which only sees
one row per file.

Null texts are empty and have one token, their end. Repeated rows are counted
and scored each. A null id counts as the empty id text. Without training texts
every word is unknown. An empty table gives an empty result. Extra columns are
ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import by_value, crc_mod, hashed_words, pieces, slices, stored
from ledgerlens.llm.elias_fano import EliasFano
from ledgerlens.session import scratch_path

by_value(__name__)

# The end of a text is a token of its own; no word has this hash.
END = np.uint64(0x9D39247E33776D41)
DISCOUNT = 0.75
MIN_PAIRS = 1
# Entries of a file of a level.
PER_FILE = 1_000_000
# Steps of a quantised probability for a factor of 2.
STEPS = 12.0
# Tokens that a task gathers before it sums them, and bytes of text scored at a time.
GATHER = 1_000_000
SCORE_BYTES = 2_000_000
# Rows of a batch that a task gives at once.
GIVEN = 100_000
# Files of a level that a task holds: mapped ones are opened again at no cost, read ones are not.
HELD_MAPPED = 8
HELD_READ = 64


def mapped(folder: str) -> bool:
    return urlparse(folder).scheme in ("", "file")


def shared_write(folder: str, name: str, parts: list[np.ndarray]) -> None:
    """Write a file of the shared folder; a repeated attempt replaces it by the same content."""
    body = b"".join(np.ascontiguousarray(x).tobytes() for x in parts)
    if mapped(folder):
        path = urlparse(folder).path
        os.makedirs(path, exist_ok=True)
        attempt = f"{path}/.{name}-{uuid.uuid4().hex}"
        with open(attempt, "wb") as f:
            f.write(body)
        os.replace(attempt, f"{path}/{name}")
        return
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    attempt = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as f:
        f.write(body)
    system.move(attempt, f"{path}/{name}")


def shared_read(folder: str, name: str, kind: type = np.uint64) -> np.ndarray:
    """A file of the shared folder, mapped into memory if it is mounted."""
    if mapped(folder):
        return np.memmap(f"{urlparse(folder).path}/{name}", kind, "r").view(np.ndarray)
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    with system.open_input_file(f"{path}/{name}") as f:
        return np.frombuffer(f.read(), kind)


@dataclass
class Levels:
    """Where the files are, and what each holds; a row for a file."""

    folder: str
    words: list[tuple[int, int, int]]  # smallest hash, first number, how many
    pairs: list[tuple[int, int]]  # file, smallest key
    tokens: int
    distinct: int


def room(files: dict, folder: str) -> None:
    """Let go of the file that was opened first, where a task holds as many as it may; its pages leave memory with it."""
    while len(files) >= (HELD_MAPPED if mapped(folder) else HELD_READ):
        files.pop(next(iter(files)))


class Words:
    """Level 1, file by file."""

    def __init__(self, levels: Levels, left: bool):
        self.levels, self.left = levels, left
        self.lowest = np.array([x[0] for x in levels.words], np.uint64)
        self.files: dict[int, tuple] = {}

    def file(self, i: int) -> tuple:
        if i not in self.files:
            room(self.files, self.levels.folder)
            words = shared_read(self.levels.folder, f"words-{i}")
            hashes, size = EliasFano.read(words)
            counts = words[size : size + hashes.n]
            left = shared_read(self.levels.folder, f"left-{i}", np.uint16) if self.left else None
            self.files[i] = hashes, counts, left
        return self.files[i]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number (-1 if unknown), count and share left of each hash; hashes are sorted and distinct."""
        number = np.full(len(hashes), -1, np.int64)
        count, left = np.zeros(len(hashes)), np.ones(len(hashes))
        if not len(self.lowest):
            return number, count, left
        edges = np.append(np.searchsorted(hashes, self.lowest), len(hashes))
        for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if a == b:
                continue
            sequence, counts, shares = self.file(i)
            low = np.uint64(self.levels.words[i][0])
            at = sequence.find(hashes[a:b] - low)
            have = at >= 0
            number[a:b][have] = at[have] + self.levels.words[i][1]
            count[a:b][have] = counts[at[have]]
            if shares is not None:
                left[a:b][have] = shares[at[have]] / 65535.0
        return number, count, left

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """Counts by number; numbers are sorted."""
        first = np.array([x[1] for x in self.levels.words] + [self.levels.distinct])
        edges = np.searchsorted(numbers, first)
        out = np.zeros(len(numbers))
        for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if a < b:
                out[a:b] = self.file(i)[1][numbers[a:b] - first[i]]
        return out


class Pairs:
    """Level 2, file by file."""

    def __init__(self, levels: Levels):
        self.levels = levels
        self.lowest = np.array([x[1] for x in levels.pairs], np.int64)
        self.files: dict[int, tuple] = {}

    def file(self, i: int) -> tuple:
        if i not in self.files:
            room(self.files, self.levels.folder)
            words = shared_read(self.levels.folder, f"pairs-{self.levels.pairs[i][0]}")
            contexts, a = EliasFano.read(words)
            pointers, b = EliasFano.read(words[a:])
            successors, c = EliasFano.read(words[a + b :])
            self.files[i] = contexts, pointers, successors, words[a + b + c :].view(np.uint8)
        return self.files[i]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Discounted probability of each pair (context << 32 | word), 0 if it is not held; keys are sorted."""
        out = np.zeros(len(keys))
        if not len(self.lowest):
            return out
        edges = np.append(np.searchsorted(keys, self.lowest), len(keys))
        for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if a == b:
                continue
            contexts, pointers, successors, levels = self.file(i)
            known = contexts.find((keys[a:b] >> 32).astype(np.uint64))
            live = np.flatnonzero(known >= 0)
            context = known[live]
            word = (keys[a:b][live] & 0xFFFFFFFF).astype(np.uint64)
            # Successors of context number r lie above r times the vocabulary's size.
            at = successors.find(context.astype(np.uint64) * np.uint64(self.levels.distinct) + word)
            inside = at >= 0
            begin = pointers.get(context[inside])
            assert (at[inside].astype(np.uint64) >= begin).all()
            out[a + live[inside]] = 2.0 ** (-levels[at[inside]].astype(np.float64) / STEPS)
        return out


def tokens_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a batch with an end after each text, and where each row begins."""
    hashes, begin = hashed_words(part, "text", lower=True)
    return np.insert(hashes, begin[1:], END), begin + np.arange(len(begin))


def summed(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.concatenate(values), np.concatenate(counts)
    distinct, at = np.unique(values, return_inverse=True)
    return distinct, np.bincount(at, counts, len(distinct)).astype(np.int64)


def in_batches(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(key), GIVEN):
        yield pa.RecordBatch.from_arrays([pa.array(key[i : i + GIVEN]), pa.array(n[i : i + GIVEN])], ["key", "n"])


def counted(gathered: Iterator[np.ndarray], kind: type) -> Iterator[pa.RecordBatch]:
    """(key, n) of everything a task gathers, summed whenever it holds many."""
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for values in gathered:
        distinct, n = np.unique(values, return_counts=True)
        keys.append(distinct)
        counts.append(n.astype(np.int64))
        if sum(map(len, keys)) > GATHER:
            a, b = summed(keys, counts)
            keys, counts = [a], [b]
            if len(a) > GATHER // 2:
                yield from in_batches(a.view(kind), b)
                keys, counts = [], []
    if keys:
        a, b = summed(keys, counts)
        yield from in_batches(a.view(kind), b)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from counted((tokens_of(part)[0] for batch in batches for part, _ in slices(batch, "text", SCORE_BYTES)), np.int64)


def write_words(folder: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        file, low, high = (int(rows[c].iloc[0]) for c in ("file", "low", "high"))
        order = rows.sort_values("rank")
        hashes = order["rank"].to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        start = np.uint64(low % 2**64) ^ np.uint64(1 << 63)
        sequence = EliasFano.build(hashes - start, high - low + 1)
        shared_write(folder, f"words-{file}", [*sequence.arrays(), order["n"].to_numpy(np.uint64)])
        return pd.DataFrame({"file": [file], "size": [len(rows)], "tokens": [int(rows["n"].sum())]})

    return run


def count_pairs(levels: Levels) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(context << 32 | word, n) of the pairs that can occur often enough: both words do."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        words = Words(levels, False)
        for batch in batches:
            for part, _ in slices(batch, "text", SCORE_BYTES):
                tokens, begin = tokens_of(part)
                distinct, at = np.unique(tokens, return_inverse=True)
                number, count, _ = words.find(distinct)
                number = np.where(count >= MIN_PAIRS, number, -1)[at]
                inside = np.ones(len(tokens), bool)
                inside[begin[:-1]] = False
                key = (number[:-1] << 32) | number[1:]
                yield key[(inside[1:]) & (number[:-1] >= 0) & (number[1:] >= 0)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from counted(gathered(batches), np.int64)

    return run


def write_pairs(levels: Levels) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One file of level 2 from the sorted pairs of a partition; gives its smallest key and each context's share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("key").to_numpy(), b.column("n").to_numpy()) for b in batches]
        parts = [p for p in parts if len(p[0])]
        if not parts:
            return
        key, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        context, begin = np.unique(key >> 32, return_index=True)
        total = Words(levels, False).counts(context)
        ordinal = np.repeat(np.arange(len(context)), np.diff(np.append(begin, len(key))))
        share = (n - DISCOUNT) / total[ordinal]
        level = np.minimum(255, np.ceil(-np.log2(share) * STEPS - 1e-9)).astype(np.uint8)
        # The last level stands for less than any share.
        given = np.where(level < 255, 2.0 ** (-level.astype(np.float64) / STEPS), 0.0)
        keep = np.flatnonzero(level < 255)
        file = TaskContext.get().partitionId()
        held, first = np.unique(ordinal[keep], return_index=True)
        renamed = np.searchsorted(held, ordinal[keep])
        successors = renamed.astype(np.uint64) * np.uint64(levels.distinct) + (key[keep] & 0xFFFFFFFF).astype(np.uint64)
        sequences = [
            EliasFano.build(context[held], levels.distinct),
            EliasFano.build(np.append(first, len(keep)), len(keep) + 1),
            EliasFano.build(successors, max(1, len(held)) * levels.distinct),
        ]
        levels_padded = np.zeros((len(keep) + 7) // 8 * 8, np.uint8)
        levels_padded[: len(keep)] = level[keep]
        shared_write(levels.folder, f"pairs-{file}", [*(a for s in sequences for a in s.arrays()), levels_padded])
        mass = np.bincount(ordinal, given, len(context))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(context), file, np.int64)), pa.array(np.full(len(context), key[0], np.int64)), pa.array(context), pa.array(mass)],
            ["file", "lowest", "context", "mass"],
        )

    return run


def write_left(folder: str, words: list[tuple[int, int, int]]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The share of probability that each context leaves to the shorter one."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        file = int(rows["file"].iloc[0])
        left = np.full(words[file][2], 65535, np.uint16)
        some = rows[rows["context"] >= 0]
        left[some["context"].to_numpy(np.int64) - words[file][1]] = np.floor(np.clip(1 - some["mass"].to_numpy(), 0, 1) * 65535)
        shared_write(folder, f"left-{file}", [left])
        return pd.DataFrame({"file": [file]})

    return run


def train(docs: DataFrame, per_file: int = PER_FILE) -> Levels:
    """Count the texts of ``docs`` and write the trie."""
    spark = docs.sparkSession
    texts = docs.select("text")
    folder = scratch_path(spark, "trie")
    unigrams = stored(texts.mapInArrow(count_words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "lm-words")
    distinct = unigrams.count()
    files = 1
    while files * per_file < distinct:
        files *= 2
    # Hashes in unsigned order, cut into equal ranges: their number of words hardly differs.
    rank = F.expr("key ^ cast('-9223372036854775808' as bigint)")
    width = 2**64 // files
    ranged = unigrams.withColumn("rank", rank)
    part = F.shiftright("rank", 64 - (files.bit_length() - 1)).cast("long") + files // 2 if files > 1 else F.lit(0).cast("long")
    ranged = ranged.withColumn("file", part)
    bounds = [(-(2**63) + i * width, -(2**63) + (i + 1) * width - 1) for i in range(files)]
    low = F.element_at(F.array(*[F.lit(a) for a, _ in bounds]), (col("file") + 1).cast("int"))
    high = F.element_at(F.array(*[F.lit(b) for _, b in bounds]), (col("file") + 1).cast("int"))
    written = stored(
        ranged.withColumns({"low": low, "high": high}).groupBy("file").applyInPandas(write_words(folder), "file long, size long, tokens long"),
        "lm-word-files",
    )
    sizes = {r["file"]: (r["size"], r["tokens"]) for r in written.collect()}
    words, number = [], 0
    for i in range(files):
        size = sizes.get(i, (0, 0))[0]
        if not size:
            shared_write(folder, f"words-{i}", [*EliasFano.build(np.empty(0, np.uint64), width).arrays()])
        words.append((i * width, number, size))
        number += size
    levels = Levels(folder, words if distinct else [], [], sum(t for _, t in sizes.values()), distinct)
    if not distinct:
        return levels
    pairs = texts.mapInArrow(count_pairs(levels), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    pairs = stored(pairs.filter(col("n") >= MIN_PAIRS), "lm-pairs")
    parts = pieces(pairs.count(), per_file)
    meta = stored(
        pairs.repartitionByRange(parts, "key").sortWithinPartitions("key")
        .mapInArrow(write_pairs(levels), "file long, lowest long, context long, mass double"),
        "lm-pair-files",
    )
    levels.pairs = sorted(((r[0], r[1]) for r in meta.select("file", "lowest").distinct().collect()), key=lambda r: r[1])
    starts = F.array(*[F.lit(w[1]) for w in words])
    file_of = F.size(F.filter(starts, lambda s: s <= col("context"))) - 1
    mass = meta.groupBy("context").agg(F.sum("mass").alias("mass")).withColumn("file", file_of)
    # Every file gets a row, so that each has its shares even without a context.
    every = spark.range(files).select(F.lit(-1).cast("long").alias("context"), F.lit(0.0).alias("mass"), col("id").cast("int").alias("file"))
    stored(mass.unionByName(every).groupBy("file").applyInPandas(write_left(folder, words), "file long"), "lm-left-files")
    return levels


def score_texts(levels: Levels) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = Words(levels, True), Pairs(levels)
        whole = np.log10(levels.tokens + levels.distinct + 1.0)
        for batch in batches:
            for part, _ in slices(batch, "text", SCORE_BYTES):
                tokens, begin = tokens_of(part)
                distinct, at = np.unique(tokens, return_inverse=True)
                number, count, left = words.find(distinct)
                alone = np.log10(count + 1) - whole
                rows = len(begin) - 1
                row = np.repeat(np.arange(rows), np.diff(begin))
                base = np.bincount(row, alone[at], rows)
                # Word after word; the first of a text has no context.
                p = 10.0 ** alone[at]
                context, word = number[at[:-1]], number[at[1:]]
                follows = np.ones(len(tokens), bool)
                follows[begin[:-1]] = False
                held = np.flatnonzero(follows[1:] & (context >= 0))
                key = np.where(word[held] >= 0, (context[held] << 32) | np.maximum(word[held], 0), -1)
                asked, back = np.unique(key, return_inverse=True)
                share = np.zeros(len(asked))
                share[asked >= 0] = pairs.find(asked[asked >= 0])
                p[held + 1] = share[back] + left[at[held]] * p[held + 1]
                score = np.bincount(row, np.log10(p), rows)
                known = np.bincount(row, count[at] > 0, rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tid"), pa.array(np.diff(begin).astype(np.int64)), pa.array(known), pa.array(base), pa.array(score)],
                    ["doc_id", "tid", "n_tokens", "n_known", "base_score", "score"],
                )

    return run


def score(docs: DataFrame, levels: Levels) -> DataFrame:
    """(doc_id, tid, n_tokens, n_known, base_score, score) of every row."""
    given = docs.select(col("doc_id").cast("long"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tid"), "text")
    return given.mapInArrow(
        score_texts(levels), "doc_id long, tid long, n_tokens long, n_known long, base_score double, score double"
    )


def held_out(key: str = "doc_id") -> Column:
    return crc_mod(key, 7) == 2


def op8_lm_scores(docs: DataFrame) -> DataFrame:
    levels = train(docs.filter(~held_out()))
    return score(docs, levels).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(levels.tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
