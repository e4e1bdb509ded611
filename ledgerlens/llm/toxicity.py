"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled texts: an ordinary one, whose
content the zstandard trainer picks from ordinary texts, and a toxic one, which
has the same content and after it the words that toxic texts have and ordinary
ones lack (found by character n-grams, so that unseen forms of a word count).
A window is one word between two fixed marks that both dictionaries hold; it is
compressed with either. What the toxic dictionary saves is the window's gain.
Gains of a document give a few numbers, which a logistic curve turns into a
score; the curve is calibrated on labelled texts that no dictionary was made of.

The model is fitted on a bounded sample of labelled rows (``MAX_LABELLED`` a
class, those with the smallest hash of their id; ``MAX_BYTES`` of text a class,
of which a text that no longer fits is left out).
Scoring reads every whole text and needs no shuffle.

Null and empty texts have no window and get the score of no gain. Repeated rows
get the same score. Without labelled rows of both classes every score is 0. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import by_value, crc_mod, slices

by_value(__name__)

MAX_LABELLED = 3000
MAX_BYTES = 24_000_000
GRAM = 5
# A gram or word marks toxic text if it is in so many toxic texts, and so many times likelier there.
MIN_TEXTS = 8
GRAM_RATIO = 40.0
WORD_RATIO = 10.0
BASE_BYTES = 12_000
# Bytes of ordinary text that the trainer sees, in pieces taken evenly.
TRAINED_BYTES = 4_000_000
TOXIC_BYTES = 12_000
MARKS = (bytes(range(1, 9)), bytes(range(14, 24)))
CLEAR_GAIN = 5
THRESHOLD = 0.7
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: list[float]
    bias: float


def distinct_words(text: bytes) -> set[bytes]:
    return set(text.translate(LOWER).split())


def grams(words: bytes) -> np.ndarray:
    a = np.frombuffer(words, np.uint8).astype(np.uint64)
    n = len(a) - GRAM + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(GRAM if n > 0 else 0):
        out = (out << np.uint64(8)) | a[k : k + n]
    return out


def text_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Grams and in how many texts each is."""
    found = [np.unique(grams(t)) for t in texts]
    return np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))


def marked_words(text: bytes, marked: np.ndarray) -> set[bytes]:
    """Words with a marked gram, of a text with a blank before and after each word."""
    hit = np.isin(grams(text), marked)
    before = np.concatenate([[0], np.cumsum(hit)])
    blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    # Grams that lie between a word's blanks, those included.
    first, last = np.minimum(blanks[:-1], len(hit)), np.clip(blanks[1:] - GRAM + 2, 0, len(hit))
    has = before[np.maximum(first, last)] > before[first]
    return {text[a + 1 : b] for a, b in zip(blanks[:-1][has].tolist(), blanks[1:][has].tolist())}


def marking_words(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Words of toxic texts with a gram that ordinary texts lack, rarest first."""
    have, counts = text_counts(toxic)
    other, other_counts = text_counts(ordinary)
    if not len(have):
        return []
    at = np.minimum(np.searchsorted(other, have), max(0, len(other) - 1))
    seen = np.where(other[at] == have, other_counts[at], 0) if len(other) else np.zeros(len(have))
    ratio = (counts / len(toxic)) / ((seen + 1) / (len(ordinary) + 1))
    least = min(MIN_TEXTS, max(2, len(toxic) // 50))
    # With few texts the ratio that they can show is limited.
    marked = have[(counts >= least) & (ratio >= min(GRAM_RATIO, (len(ordinary) + 1) * least / len(toxic)))]
    found: Counter = Counter()
    for text in toxic:
        found.update(marked_words(text, marked))
    common: Counter = Counter()
    for text in ordinary:
        common.update(w for w in set(text.split()) if w in found)
    kept = [
        w for w, n in found.items()
        if n >= min(3, least) and n / len(toxic) >= WORD_RATIO * (common[w] + 0.5) / (len(ordinary) + 1)
    ]
    return sorted(kept, key=lambda w: (found[w], w))


def trained_content(texts: list[bytes]) -> bytes:
    """What the zstandard trainer picks from texts, or their ends where they are too few for it."""
    parts = [t[i : i + 256] for t in texts for i in range(0, len(t), 256)]
    parts = parts[:: max(1, 256 * len(parts) // TRAINED_BYTES)]
    try:
        return zstandard.train_dictionary(BASE_BYTES + 4096, parts).as_bytes()[-BASE_BYTES:]
    except zstandard.ZstdError:
        return b" ".join(texts)[-BASE_BYTES:]


class Gains:
    """What the toxic dictionary saves on the window of a word; remembered up to a bound."""

    def __init__(self, model: Model, limit: int = 300_000):
        given = zstandard.ZstdCompressionParameters(
            window_log=16, chain_log=14, hash_log=14, search_log=4, min_match=4, target_length=0,
            strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        self.coders = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(MARKS[0] + body + MARKS[1], dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                compression_params=given,
            )
            for body in (model.ordinary, model.toxic)
        ]
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def __getitem__(self, word: bytes) -> int:
        gain = self.known.get(word)
        if gain is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            window = MARKS[0] + b" " + word + b" " + MARKS[1]
            ordinary, toxic = (len(c.compress(window)) for c in self.coders)
            gain = self.known[word] = ordinary - toxic
        return gain

    def features(self, text: bytes) -> tuple[list[float], bytes]:
        """Numbers of a document, and its most toxic word."""
        words = distinct_words(text)
        if not words:
            return [0.0, 0.0, 0.0, 0.0], b""
        gains = [self[w] for w in words]
        least = heapq.nlargest(8, gains)[-1]
        best = sorted(((g, w) for g, w in zip(gains, words) if g >= least), reverse=True)[:8]
        shares = max(g / (len(w) + 2) for g, w in best)
        clear = sum(g >= CLEAR_GAIN for g in gains)
        top = [g for g, _ in best[:3]]
        return [float(top[0]), sum(top) / len(top), shares, math.log1p(clear) - 0.3 * math.log1p(len(words))], best[0][1]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    keep = np.diag([ridge] * x.shape[1] + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + keep @ w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + keep
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * mean / scale).sum())


def fit_texts(toxic: list[bytes], ordinary: list[bytes], toxic_rows: int, ordinary_rows: int) -> Model | None:
    """Dictionaries from two thirds of the texts, the curve from the others; rows give the classes' true shares."""
    # Copies would make their rare words look typical.
    toxic, ordinary = sorted(set(toxic)), sorted(set(ordinary))
    if len(toxic) < 3 or len(ordinary) < 3:
        return None
    joined = [[b" " + b" ".join(t.translate(LOWER).split()) + b" " for t in side] for side in (toxic, ordinary)]
    learn = [[t for i, t in enumerate(side) if i % 3 != 2] for side in joined]
    check = [side[2::3] for side in joined]
    body = trained_content(learn[1])
    words = b"".join(b" " + w + b" " for w in marking_words(learn[0], learn[1]))[-TOXIC_BYTES:]
    model = Model(body, body + words, [], 0.0)
    gains = Gains(model)
    x = np.array([gains.features(t)[0] for side in check for t in side])
    y = np.array([1.0] * len(check[0]) + [0.0] * len(check[1]))
    weight = np.where(y == 1, toxic_rows / len(check[0]), ordinary_rows / len(check[1]))
    weights, bias = logistic(x, y, weight * len(y) / weight.sum())
    return Model(body, body + words, weights.tolist(), bias)


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, most_bytes: int = MAX_BYTES) -> Model | None:
    """Learn from the labelled rows of training ids (crc32 of the id modulo 3 is not 1)."""
    known = labels.select(col("doc_id").cast("long"), col("toxic").cast("int")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter((crc_mod("doc_id", 3) != 1) & col("toxic").isin(0, 1))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    chosen = None
    for label in (0, 1):
        part = known.filter(col("toxic") == label).orderBy(F.xxhash64(F.lit("tox"), "doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    # Twice ``most`` rows at the most.
    texts = docs.select(col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "text"])
    sides: list[list[bytes]] = [[], []]
    sizes = [0, 0]
    ranked = texts.select("toxic", "text", F.xxhash64(F.lit("tox"), "doc_id").alias("_h"), F.octet_length("text").alias("_b"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_t"))
    # A text that does not fit is left out alone; those after it in hash order still count.
    skipped = []
    for toxic, key, size, text in sorted((r["toxic"], r["_h"], r["_b"] or 0, r["_t"]) for r in ranked.select("toxic", "_h", "_b", "_t").collect()):
        if sizes[toxic] + size > most_bytes:
            skipped.append((key, text))
        else:
            sizes[toxic] += size
    if skipped:
        left_out = docs.sparkSession.createDataFrame(skipped, "_h long, _t long")
        ranked = ranked.join(F.broadcast(left_out), ["_h", "_t"], "left_anti")
    for row in ranked.select("toxic", "text").toLocalIterator():
        sides[row["toxic"]].append((row["text"] or "").encode())
    return fit_texts(sides[1], sides[0], counts[1], counts[0])


def scorer(model: Model | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(model) if model else None
        for batch in batches:
            for part, texts in slices(batch, "text"):
                scores, worst = [], []
                for text in texts:
                    x, word = gains.features(text) if gains else ([], b"")
                    level = sum(a * b for a, b in zip(model.weights, x)) + model.bias if model else -30.0
                    scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, level)))) if model else 0.0)
                    worst.append(word.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in part.schema.names if c != "text"), pa.array(scores, pa.float64()), pa.array(worst, pa.string())],
                    [*(c for c in part.schema.names if c != "text"), "score", "worst"],
                )

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, tid, score, worst) of every row; ``tid`` tells texts under one id apart, ``worst`` is the most toxic window."""
    given = docs.select(col("doc_id").cast("long"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tid"), "text")
    return given.mapInArrow(scorer(model), "doc_id long, tid long, score double, worst string")


def op5_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (col("score") >= THRESHOLD).cast("int").alias("predicted"), "worst"
    )
