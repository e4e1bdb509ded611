"""Removal of passages that an earlier document has, by automata of repeated phrases.

1. *Copies.* Documents with equal word sequences form a class; its smallest id
   stands for it. In the other members every word in a window is removed.
2. *Anchors.* Of each class one hash in every run of windows is chosen by its
   value alone (winnowing over shorter grams), so that equal windows choose
   equal anchors. Anchors found in two documents mark candidate windows.
3. *Passages.* The candidate windows are hashed whole and their smallest
   document is found. Windows that other documents repeat are joined, in their
   smallest document, into the longest passages.
4. *Automata.* Passages are cut into chunks of half a window, so that every
   window has a whole chunk inside. Chunks are dealt into shards of bounded
   size, each compiled into one Aho-Corasick automaton over words.
5. *Streaming.* All representatives run through the automata, one shard after
   the other. A chunk found is extended to both sides word by word along its
   passage; a stretch of a window or more marks its words as removed.

Hash values only choose candidates; words are marked by comparing the words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import bucket, by_value, hashed_words, rolling, slices, stored

by_value(__name__)

# Words of a window, of the grams that anchors are chosen from, and of an automaton's chunks.
WINDOW = 50
GRAM = 24
# Bytes of passages in one automaton, and of documents that one task streams through it.
SHARD_BYTES = 1_000_000
STREAM_BYTES = 16_000_000
SECOND = np.uint64(0xD6E8FEB86659FD93)


def window_anchors(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For every window the smallest hash among its grams."""
    low = rolling(hashes, gram)
    n, span = len(hashes) - window + 1, 1
    if n < 1:
        return np.empty(0, np.uint64)
    want = window - gram + 1
    while span * 2 <= want:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = want - span
    return np.minimum(low[:n], low[rest : rest + n])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def digests(window: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per document: its words' digest and count, and its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                hashes, at = hashed_words(part, "text")
                sha = [hashlib.sha256(b" ".join(text.split())).digest() for text in texts]
                count, anchors = np.diff(at), []
                for row, given in enumerate(part.column("doc_id").is_valid().to_pylist()):
                    words = hashes[at[row] : at[row + 1]] if given else hashes[:0]
                    anchors.append(signed(np.unique(window_anchors(words, window, gram))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tid"), pa.array(sha, pa.binary()), pa.array(count, pa.int64()),
                     pa.array(anchors, pa.list_(pa.int64()))],
                    ["doc_id", "tid", "sha", "n_words", "anchors"],
                )

    return run


def candidate_windows(window: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Hashes of the windows whose anchor recurs, once per document, with their first position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in slices(batch, "text"):
                every, begin = hashed_words(part, "text")
                out: list[list[np.ndarray]] = [[], [], [], [], []]
                keys = zip(part.column("doc_id").to_pylist(), part.column("tid").to_pylist(), part.column("anchors").to_pylist())
                for row, (doc_id, tid, anchors) in enumerate(keys):
                    hashes = every[begin[row] : begin[row + 1]]
                    wanted = np.array(anchors, np.int64).view(np.uint64)
                    at = np.flatnonzero(np.isin(window_anchors(hashes, window, gram), wanted))
                    if not len(at):
                        continue
                    first = rolling(hashes, window)[at]
                    second = rolling(hashes ^ SECOND, window)[at]
                    _, once = np.unique(first, return_index=True)
                    for column, values in zip(out, (signed(first[once]), second[once].astype(np.uint32).view(np.int32), at[once].astype(np.int32))):
                        column.append(values)
                    out[3].append(np.full(len(once), doc_id, np.int64))
                    out[4].append(np.full(len(once), tid, np.int64))
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in out], ["first", "second", "at", "doc_id", "tid"]
                    )

    return run


def passages(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The longest runs of recurring windows of a document, as words joined by spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows = []
                keys = zip(part.column("doc_id").to_pylist(), part.column("positions").to_pylist())
                for text, (doc_id, positions) in zip(texts, keys):
                    words = text.split()
                    at = np.unique(np.array(positions, np.int64))
                    for found in np.split(at, np.flatnonzero(np.diff(at) != 1) + 1):
                        rows.append({"owner": doc_id, "words": b" ".join(words[int(found[0]) : int(found[-1]) + window])})
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("owner", pa.int64()), ("words", pa.binary())]))

    return run


class Phrases:
    """One shard's passages as an Aho-Corasick automaton over words."""

    def __init__(self, owners: list[int], texts: list[bytes], window: int):
        import ahocorasick

        self.window, self.owners = window, owners
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        self.passages = [
            np.array([number(w, len(self.vocabulary) + 1) for w in text.split(b" ")], np.int64) for text in texts
        ]
        # Two whole chunks fit into a window, so every window has one inside wherever it begins.
        size = window // 2
        places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for i, words in enumerate(self.passages):
            listed = words.tolist()
            for start in range(0, len(listed) - size + 1, size):
                places.setdefault(tuple(listed[start : start + size]), []).append((i, start + size))
        self.places = list(places.values())
        # A word is a few letters of a small alphabet, since a node looks through all its children; the first letter
        # is of an alphabet of its own, so that no match begins inside a word.
        self.letters = 1
        while 64**self.letters <= len(self.vocabulary):
            self.letters += 1
        self.spelling = [chr(1) * self.letters] + [self.spelled(n) for n in range(1, len(self.vocabulary) + 1)]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, key in enumerate(places):
            self.automaton.add_word("".join([self.spelling[n] for n in key]), i)
        self.automaton.make_automaton()

    def spelled(self, n: int) -> str:
        digits = [n // 64**k % 64 for k in range(self.letters)]
        return chr(128 + digits[0]) + "".join(chr(192 + d) for d in digits[1:])

    def covered(self, doc_id: int, words: list[bytes]) -> tuple[list[int], list[int]]:
        """Starts and ends of the stretches that an earlier document's passage covers, a window long at least."""
        numbers = [self.vocabulary.get(w, 0) for w in words]
        marked = np.zeros(len(numbers) + 1, np.int32)
        array = np.array(numbers, np.int64)
        # Up to where a passage at one offset was compared already.
        done: dict[tuple[int, int], int] = {}
        for letter, found in self.automaton.iter("".join([self.spelling[n] for n in numbers])):
            end = (letter + 1) // self.letters - 1
            for passage, stop in self.places[found]:
                if self.owners[passage] >= doc_id:
                    continue
                shift = end + 1 - stop
                if done.get((passage, shift), -1) >= end:
                    continue
                theirs = self.passages[passage]
                low, high = max(0, shift), min(len(array), shift + len(theirs))
                same = array[low:high] == theirs[low - shift : high - shift]
                here = end - low
                back, ahead = same[here::-1], same[here:]
                k = int(back.argmin())
                start = low if back[k] else low + here - k + 1
                k = int(ahead.argmin())
                finish = high if ahead[k] else end + k
                done[(passage, shift)] = finish - 1
                if finish - start >= self.window:
                    marked[start] += 1
                    marked[finish] -= 1
        inside = np.cumsum(marked[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        return edges[::2].tolist(), edges[1::2].tolist()


COVERED = "doc_id long, tid long, starts array<int>, stops array<int>"


def stream_shard(window: int):
    """Run a block of documents through the automaton of a shard, for ``cogroup().applyInPandas``."""

    def run(docs: pd.DataFrame, phrases: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "tid", "starts", "stops"]
        if not len(docs) or not len(phrases):
            return pd.DataFrame(columns=columns)
        # Passages repeat if rows of the table do.
        unique = sorted(set(zip(phrases["owner"].tolist(), map(bytes, phrases["words"]))))
        shard = Phrases([o for o, _ in unique], [w for _, w in unique], window)
        rows = []
        for doc_id, tid, text in zip(docs["doc_id"].tolist(), docs["tid"].tolist(), docs["text"]):
            starts, stops = shard.covered(doc_id, text.encode("utf-8", "surrogatepass").split())
            if starts:
                rows.append((doc_id, tid, starts, stops))
        return pd.DataFrame(rows, columns=columns)

    return run


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of removed words, and the digest and text of the kept ones."""
    for batch in batches:
        for part, texts in slices(batch, "text"):
            removed, sha, kept_text = [], [], []
            for text, starts, stops in zip(texts, part.column("starts").to_pylist(), part.column("stops").to_pylist()):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int32)
                np.add.at(gone, [x for s in starts for x in s], 1)
                np.add.at(gone, [x for s in stops for x in s], -1)
                stay = np.cumsum(gone[:-1]) == 0
                joined = b" ".join([w for w, k in zip(words, stay.tolist()) if k])
                removed.append(len(words) - int(stay.sum()))
                sha.append(hashlib.sha256(joined).hexdigest())
                kept_text.append(joined.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("tid"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(kept_text, pa.string())],
                ["doc_id", "tid", "n_cut", "cut_sha", "cut_text"],
            )


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, texts: bool = False) -> DataFrame:
    """Remove each word covered by a window that starts in a document with a smaller id as well.

    ``docs`` has (doc_id, text). Returns (doc_id, n_words, n_removed,
    kept_sha256) per row, and the kept words as ``kept_text`` if ``texts``.
    Windows are judged on the input, and are ``window`` words long.

    A null or empty text has no words. A row without an id keeps all its words
    and is earlier than none. Repeated rows get the same result each; rows with
    one id and other texts don't count as earlier than each other. An empty
    table gives an empty result. Extra columns are ignored.
    """
    key = ["doc_id", "tid"]
    given = docs.select(col("doc_id").cast("long"), "text").withColumn("tid", F.coalesce(F.xxhash64("text"), F.lit(0)))
    digest = stored(
        given.mapInArrow(digests(window, gram), "doc_id long, tid long, sha binary, n_words long, anchors array<long>"),
        "repeats-digest",
    )
    classes = stored(digest.groupBy("sha").agg(F.min("doc_id").alias("_least")), "repeats-classes")
    leading = digest.filter(F.size("anchors") > 0).join(classes, "sha").filter(col("doc_id") == col("_least"))
    found = stored(leading.select(*key, F.explode("anchors").alias("anchor")), "repeats-anchors")
    recurring = (
        found.groupBy("anchor").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b"))
        .filter(col("_a") < col("_b")).select("anchor")
    )
    occurring = stored(found.join(recurring, "anchor"), "repeats-occurring")
    per_doc = occurring.groupBy(*key).agg(F.collect_set("anchor").alias("anchors"))
    candidates = stored(given.dropna(subset=["doc_id"]).join(per_doc, key), "repeats-candidates")

    windows = stored(
        candidates.mapInArrow(candidate_windows(window, gram), "first long, second int, at int, doc_id long, tid long"),
        "repeats-windows",
    )
    firsts = stored(
        windows.groupBy("first", "second")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("_b"), F.min_by("at", "doc_id").alias("at"),
             F.min_by("tid", "doc_id").alias("tid"))
        .filter(col("owner") < col("_b")),
        "repeats-firsts",
    )
    positions = firsts.groupBy(col("owner").alias("doc_id"), "tid").agg(F.collect_list("at").alias("positions"))
    listed = stored(
        candidates.select(*key, "text").join(positions, key)
        .mapInArrow(passages(window), "owner long, words binary"),
        "repeats-passages",
    )

    size = listed.agg(F.sum(F.length("words"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    listed = listed.withColumn("shard", bucket(shards, "owner"))
    # A document meets the shards of the documents that own its windows; in the owner itself nothing is covered by them.
    owned = firsts.select("first", "second", "owner", bucket(shards, "owner").alias("shard"))
    routed = windows.join(owned, ["first", "second"]).filter(col("doc_id") != col("owner")).select(*key, "shard").distinct()
    routed = stored(routed, "repeats-routed")
    loads = stored(
        routed.join(candidates.select(*key, F.octet_length("text").alias("_bytes")), key)
        .groupBy("shard").agg(F.ceil(F.sum("_bytes") / F.lit(STREAM_BYTES)).cast("int").alias("_parts")),
        "repeats-loads",
    )
    parts = F.greatest(col("_parts"), F.lit(1))
    # Every block of a shard's documents gets the shard's passages, which are no more than the block itself.
    dealt = routed.join(loads, "shard").select(*key, "shard", bucket(parts, F.lit("part"), *key).alias("part"))
    dealt = dealt.join(candidates.select(*key, "text"), key)
    copies = loads.select(col("shard").alias("_shard"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    spread = listed.select("shard", "owner", "words").join(copies, col("shard") == col("_shard")).select(
        "_shard", "_part", "owner", "words"
    )
    covered = (
        dealt.groupBy("shard", "part").cogroup(spread.groupBy("_shard", "_part"))
        .applyInPandas(stream_shard(window), COVERED)
    )
    spans = covered.groupBy(*key).agg(F.collect_list("starts").alias("starts"), F.collect_list("stops").alias("stops"))
    changed = stored(
        candidates.select(*key, "text").join(spans, key)
        .mapInArrow(cut, "doc_id long, tid long, n_cut long, cut_sha string, cut_text string").dropDuplicates(key),
        "repeats-changed",
    )
    copy = (col("doc_id") > col("_least")) & (col("n_words") >= window)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    rows = digest.drop("anchors").join(classes, "sha").join(changed if texts else changed.drop("cut_text"), key, "left")
    result = rows.select(
        *key, "n_words",
        F.when(copy, col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, nothing).otherwise(F.coalesce("cut_sha", F.lower(F.hex("sha")))).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(col("cut_text")).alias("_cut")] if texts else []),
    )
    if not texts:
        return result.drop("tid")
    # A text that loses nothing is given as it is, words joined by one space.
    whole = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    kept = F.coalesce(col("_cut"), whole).alias("kept_text")
    by_text = given.select("tid", "text").dropDuplicates(["tid"])
    return result.join(by_text, "tid", "left").select("doc_id", "n_words", "n_removed", "kept_sha256", kept)


def op7_repeats(docs: DataFrame) -> DataFrame:
    return repeated_passages(docs)
