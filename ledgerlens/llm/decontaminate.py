"""Benchmark decontamination by the CGK embedding and bit sampling.

The CGK random walk reads a sequence of words: at step j it gives the word it
stands on and moves on by a random bit of (j, word). Sequences a few edits
apart fall into step again, so edit distance becomes Hamming distance of what
the walk gives. A repetition is a walk and some of its steps, sampled; two
windows that agree on them are candidates. A walk starts at every known word of
a document and at every word of an item, so that a stretch without edits
anywhere in the item is enough. n words with k edits leave n - k words in k + 1
such stretches at the most, which bounds the recall from below however the
edits lie: an item gets as many walks as ``RECALL`` needs at its most edits. A
candidate gives an alignment of the whole item, which is verified by its exact
edit distance to the best stretch of the document there. Copies without edits
are always found.

Words are lower-cased (A to Z) and compared whole. An item is found where its
edit distance in words to a stretch is at most (1 - similarity) times its
length. Benchmarks go to the tasks in slices of bounded size; documents are
read in place and nothing is shuffled.

Null and empty documents hold no item, null and empty items are found nowhere.
Repeated documents give repeated rows; repeated items are one; texts under one
item id are items each. A null id is kept. Empty tables give an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import bucket, by_value, hashed_words, mix64, pieces, slices

by_value(__name__)

SIMILARITY = 0.8
# Share of the passages with the most edits allowed that become candidates, at least, in any spread of the edits.
RECALL = 0.99
# Steps of a walk, and how many words a sampling of it has to meet; an item takes the first that needs few walks.
WALKS = ((8, 3), (4, 3), (4, 2), (2, 2), (1, 1))
FEW = 6
# Steps of a sampling.
SAMPLED = 5
# Longer items are walked as often as one of so many words; they have more stretches without edits.
LONGEST = 60
# Words of a stretch that the bound looks at, and random walks that it is taken from.
STRETCH, TRIALS = 16, 4000
# Bytes of benchmark text in one pass.
SLICE_BYTES = 8_000_000

FOUND = "doc_id long, tid long, item_id long, start_word long, n_words long, distance long"


def best_stretch(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """Smallest edit distance of the whole pattern to a stretch of the text, and where the first such stretch ends.

    Bit-parallel dynamic programming: one integer holds a column of the table.
    """
    m = len(pattern)
    full, last = (1 << m) - 1, 1 << (m - 1)
    where: dict[int, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | (1 << i)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        match = where.get(c, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        rise = down | ~(diagonal | up) & full
        fall = up & diagonal
        if rise & last:
            score += 1
        elif fall & last:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | ~(diagonal | rise) & full, rise & diagonal
        if score < best:
            best, end = score, j + 1
    return best, end


def sampled_steps(steps: int, walk: int) -> np.ndarray:
    """One step of each of equal stretches of the walk, so that a sampling spans several words."""
    rng = np.random.default_rng(1000 * steps + walk)
    edges = np.linspace(0, steps, min(SAMPLED, steps) + 1).astype(int)
    return np.array([rng.integers(a, b) for a, b in zip(edges[:-1], edges[1:])])


def words_met(places: np.ndarray) -> np.ndarray:
    """At how many places the sampled steps of each walk stand."""
    return 1 + (np.diff(places, axis=0) > 0).sum(axis=0)


def stretch_misses(steps: int, least: int, walk: int) -> np.ndarray:
    """How likely no walk within an unedited stretch of 0, 1, ... words gives a key."""
    rng = np.random.default_rng(walk)
    bits = rng.integers(0, 2, (steps, TRIALS, STRETCH + steps), dtype=np.int32)
    at = np.broadcast_to(np.arange(STRETCH, dtype=np.int32), (TRIALS, STRETCH)).copy()
    places = np.empty((steps, TRIALS, STRETCH), np.int32)
    for step in range(steps):
        places[step] = at
        at = at + np.take_along_axis(bits[step], at, axis=1)
    places = places[sampled_steps(steps, walk)]
    last = np.where(words_met(places) >= least, places[-1], STRETCH)
    return np.array([1.0] + [1 - (last[:, :n] < n).any(axis=1).mean() for n in range(1, STRETCH + 1)])


def worst_miss(misses: np.ndarray, words: int, edits: int) -> float:
    """The largest product of misses over edits + 1 stretches that hold the words left."""
    of = misses[np.minimum(np.arange(words + 1), STRETCH)]
    worst = of[: words - edits + 1]
    for _ in range(edits):
        worst = np.array([(worst[: n + 1] * of[n::-1]).max() for n in range(len(worst))])
    return float(worst[-1])


def planned(similarity: float, recall: float = RECALL) -> list[tuple[int, int, int]]:
    """Steps, least words met and number of walks for items of 0, 1, ... words."""
    # After so many walks each.
    tried = {kind: np.cumprod([stretch_misses(*kind, w) for w in range(FEW)], axis=0) for kind in WALKS}
    out = [(1, 1, 1)]
    for n in range(1, LONGEST + 1):
        best = None
        for (steps, least), misses in tried.items():
            if steps > n:
                continue
            missed = [worst_miss(m, n, int((1 - similarity) * n + 1e-9)) for m in misses]
            enough = [w + 1 for w, m in enumerate(missed) if m <= 1 - recall]
            if enough:
                best = (steps, least, enough[0])
                break
        # Not reached by any: single words, which miss only items without an unedited word.
        out.append(best or (1, 1, 1))
    return out


class Items:
    """A slice of the benchmark, ready for search."""

    def __init__(self, rows: list[tuple[int | None, str]], similarity: float, plan: list[tuple[int, int, int]]):
        texts = pa.record_batch([pa.array([t for _, t in rows], pa.string())], ["text"])
        hashes, begin = hashed_words(texts, "text", lower=True)
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes) + 1
        self.items = [(rows[i][0], numbers[begin[i] : begin[i + 1]].tolist()) for i in range(len(rows)) if begin[i + 1] > begin[i]]
        self.most = [int((1 - similarity) * len(words) + 1e-9) for _, words in self.items]
        self.distinct = [set(words) for _, words in self.items]
        # Repetitions: number of walk, sampled steps, known keys, their places (items and offsets), and which low bits a key can have.
        self.repetitions: list[tuple] = []
        walks = [plan[min(len(words), LONGEST)] for _, words in self.items]
        for steps, least in WALKS:
            for walk in range(FEW):
                mine = [i for i, w in enumerate(walks) if w[:2] == (steps, least) and w[2] > walk]
                if not mine:
                    continue
                chosen = sampled_steps(steps, walk)
                words = np.concatenate([np.array(self.items[i][1] + [0] * steps, np.int32) for i in mine])
                sizes = np.array([len(self.items[i][1]) for i in mine])
                item = np.repeat(np.arange(len(mine)), sizes)
                first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                offset = np.arange(len(item)) - first[item]
                given, places = self.walk(words, np.flatnonzero(words), chosen, walk)
                met = np.where((given > 0).all(axis=0), words_met(places), 0)
                # Keys of few words are found everywhere; an item without a better one keeps them.
                keep = np.flatnonzero((met > 0) & (met >= np.minimum(least, np.maximum.reduceat(met, first))[item]))
                keys = self.keys(given[:, keep])
                order = np.argsort(keys, kind="stable")
                known, begins = np.unique(keys[order], return_index=True)
                maybe = np.zeros(1 << 20, bool)
                maybe[(known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
                place = keep[order]
                self.repetitions.append((walk, chosen, known, np.append(begins, len(order)), np.array(mine)[item[place]], offset[place], maybe))

    def bits(self, step: int, walk: int) -> np.ndarray:
        """The random bit of each word at one step; number 0 is any word that no item has."""
        seed = mix64(np.array([step * 64 + walk + 1], np.uint64))
        return (mix64(np.concatenate([np.zeros(1, np.uint64), self.vocabulary]) ^ seed) >> np.uint64(17) & np.uint64(1)).astype(np.int32)

    def walk(self, words: np.ndarray, starts: np.ndarray, chosen: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """What the walk gives at the chosen steps, from each start, and where it stands there."""
        at = starts.astype(np.int32)
        given, places = np.empty((2, len(chosen), len(starts)), np.int32)
        for step in range(int(chosen[-1]) + 1):
            now = words[at]
            taken = np.flatnonzero(chosen == step)
            given[taken], places[taken] = now, at
            at = at + self.bits(step, number)[now]
        return given, places

    @staticmethod
    def keys(given: np.ndarray) -> np.ndarray:
        key = np.zeros(given.shape[1], np.uint64)
        for row in given:
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + row.astype(np.uint64))
        return key

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)

    def candidates(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(position at which the item would start, item, position that a walk began at) of all windows of a slice."""
        # No key has a foreign word, and a stretch without edits begins with a known one.
        starts = np.flatnonzero(words)
        padded = np.concatenate([words, np.zeros(max(k for k, _ in WALKS) + 1, np.int32)])
        found = [np.empty((0, 3), np.int64)]
        for walk, chosen, known, first, item, offset, maybe in self.repetitions:
            given, _ = self.walk(padded, starts, chosen, walk)
            live = np.flatnonzero((given > 0).all(axis=0))
            keys = self.keys(given[:, live])
            hit = np.flatnonzero(maybe[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(known, keys[hit]), len(known) - 1)
            same = np.flatnonzero(known[at] == keys[hit])
            k, i = at[same], starts[live[hit[same]]]
            many = first[k + 1] - first[k]
            i = np.repeat(i, many)
            place = np.repeat(first[k] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(len(i)) if len(k) else np.empty(0, np.int64)
            found.append(np.column_stack([i - offset[place], item[place], i]))
        return np.unique(np.concatenate(found), axis=0).tolist()

    def verified(self, words: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, first word in its row, words, distance) of every passage found in a slice."""
        ends: dict[tuple[int, int], int] = {}
        tried = None
        for start, item, position in self.candidates(words):
            pattern, most = self.items[item][1], self.most[item]
            # The walk began in the passage, so its row is the passage's.
            r = int(np.searchsorted(begin, position, side="right")) - 1
            if (start, item, r) == tried:
                continue
            tried = (start, item, r)
            low, high = max(int(begin[r]), start - most), min(int(begin[r + 1]), start + len(pattern) + most)
            if high <= low or ends.get((r, item), -1) > start + most:
                continue
            text = words[low:high].tolist()
            # Each word that the text lacks is an edit.
            if len(self.distinct[item].difference(text)) > most:
                continue
            distance, end = best_stretch(pattern, text)
            if distance > most:
                continue
            if distance:
                # The alignment may be off by some words: look once more, wider around.
                low, high = max(int(begin[r]), low - most), min(int(begin[r + 1]), high + most)
                text = words[low:high].tolist()
                distance, end = best_stretch(pattern, text)
            # The same backwards from the end gives the stretch's first word.
            back = best_stretch(pattern[::-1], text[:end][::-1])[1]
            ends[(r, item)] = low + end
            yield r, item, low + end - back - int(begin[r]), back, distance


def find_items(rows: list[tuple[int | None, str]], similarity: float, plan: list[tuple[int, int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(rows, similarity, plan)
        schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "tid", "item_id", "start_word", "n_words", "distance")])
        for batch in batches:
            for part, _ in slices(batch, "text"):
                hashes, begin = hashed_words(part, "text", lower=True)
                if not len(hashes) or not items.items:
                    continue
                doc_id, tid = part.column("doc_id").to_pylist(), part.column("tid").to_pylist()
                out = [
                    {"doc_id": doc_id[r], "tid": tid[r], "item_id": items.items[i][0], "start_word": s, "n_words": n, "distance": d}
                    for r, i, s, n, d in items.verified(items.numbers(hashes), begin)
                ]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Every passage of a document that is a benchmark item: (doc_id, tid, item_id, start_word, n_words, distance)."""
    given = docs.select(col("doc_id").cast("long"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tid"), "text")
    items = benchmark.select(col("item_id").cast("long"), "text").dropna(subset=["text"]).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = pieces(total, slice_bytes)
    plan = planned(similarity)
    found = None
    for part in range(passes):
        some = items.filter(bucket(passes, F.lit("items"), "item_id", "text") == part).collect()
        rows = sorted(((r[0], r[1]) for r in some), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        hits = given.mapInArrow(find_items(rows, similarity, plan), FOUND)
        found = hits if found is None else found.unionByName(hits)
    return found


def op6_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark).drop("tid")
