"""Alignment of two tokenizers over the bytes of a corpus, each distinct text once.

Rows are shuffled by their full text, so that equal ones meet; copies in one
task are one row before that. Each distinct text is encoded by both tokenizers
and their token ends are laid over its bytes. Two tokens are linked if they
share a byte: every stretch between neighbouring ends of either kind lies in
one token of each, so stretches are links. Ends that both have cut the text
into groups. A pair of ids counts as many documents as hold it, which is the
multiplicity of each text that does. The counts lie sorted in files of the
shared folder, mapped by the tasks that look pairs up; what a text gets goes
to its documents by a hash of the text (sha256), for which very common texts are dealt
out over several tasks.

A, the byte-level tokenizer, reads a blank and the text; B, the piece model,
puts that blank itself. Strings of special tokens are plain text. A text that
is null or empty, or that either tokenizer doesn't give back byte for byte
(U+2581 reads as a blank), has no tokens: all its measures are 0 and its
groups the empty text. Null ids and repeated rows stay rows and count as
documents. An empty table gives an empty result. Other columns are ignored,
whatever their names. Texts of any length are taken whole, in parts cut before
a blank between two words, where both tokenizers always cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm import sentence_pieces, token_files
from ledgerlens.llm.common import by_value, pieces, slices, spread, stored
from ledgerlens.llm.language_model import shared_read, shared_write
from ledgerlens.session import scratch_path

by_value(__name__)

# Bytes of text that one step holds; pairs that a task gathers before it adds them up, pairs of a file, files that it holds
# open.
STEP_BYTES = 1_000_000
GATHERED = 1_000_000
PER_FILE = 1_000_000
OPEN_FILES = 256
# Texts with more than this share of all rows are dealt out over several tasks: fewer than its inverse.
HOT = 0.001


def byte_of_letter() -> dict[str, int]:
    """Letters of byte-level vocabularies: visible latin ones stand for themselves, the other bytes follow from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(others)}}


@dataclass
class Side:
    """Bytes of a vocabulary's tokens."""

    flat: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray

    def gathered(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.offsets[ids], self.lengths[ids])]


class Decimals:
    """Ids written out, each followed by one more byte."""

    def __init__(self, size: int):
        self.size = np.array([len(str(i)) for i in range(size)], np.int64)
        width = int(self.size.max(initial=1))
        self.digits = np.frombuffer("".join(str(i).ljust(width) for i in range(size)).encode(), np.uint8).reshape(size, width)

    def written(self, ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and where each id ends."""
        size = self.size[ids]
        ends = np.cumsum(size + 1)
        out, begin, text = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8), ends - size - 1, self.digits[ids]
        for k in range(self.digits.shape[1]):
            some = size > k
            out[begin[some] + k] = text[some, k]
        out[ends - 1] = after
        return out, ends


def kept(ids: np.ndarray, begin: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some rows only."""
    size = np.diff(begin)[rows]
    return ids[spread(begin[:-1][rows], size)], np.concatenate([[0], np.cumsum(size)])


@dataclass
class Aligned:
    """Measures of each text; ``pairs`` and ``times`` are its distinct id pairs and how often each is linked."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: list[np.ndarray]
    times: list[np.ndarray]
    groups: list[memoryview]


class Aligner:
    """Both tokenizers and what their tokens stand for."""

    def __init__(self, definition: str, model: sentence_pieces.PieceModel):
        self.first = token_files.Encoder(definition)
        self.first.tokenizer.encode_special_tokens = True
        self.first.added = []
        self.second = sentence_pieces.Encoder(model)
        letters, names = byte_of_letter(), self.first.tokenizer.get_vocab()
        bytes_of = [b""] * len(self.first.lengths)
        for name, i in names.items():
            bytes_of[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        lengths = np.array([len(b) for b in bytes_of], np.int64)
        self.a = Side(np.frombuffer(b"".join(bytes_of), np.uint8), np.cumsum(lengths) - lengths, lengths)
        t = model.tables()
        self.b = Side(t["flat"], t["offsets"], t["lengths"])
        self.width = model.size
        self.decimals = Decimals(max(len(lengths), model.size))
        # Whether a word of B always begins at a blank after another character.
        blank = t["classes"][ord(sentence_pieces.BLANK)]
        before = t["together"].reshape(t["width"], t["width"])[:, blank].copy()
        before[blank] = False
        self.may_cut = not before.any()

    def parts(self, text: str) -> list[str]:
        """A long text as several, each of which both tokenizers read as they read it in its place."""
        if len(text) <= token_files.PART or not self.may_cut:
            return [text]
        # The blank before the text counts as one before its first word.
        found = list(self.first.parts(text))
        return [found[0], *(p[1:] for p in found[1:])]

    def __call__(self, texts: list[str]) -> Aligned:
        """Align texts; a long one is put together from its parts."""
        cut = [self.parts(t) for t in texts]
        if all(len(c) == 1 for c in cut):
            return self.some(texts)
        each = [self.joined([self.some([p]) for p in c]) for c in cut]
        numbers = [np.concatenate([getattr(x, n) for x in each]) for n in ("n_a", "n_b", "n_groups", "n_links")]
        return Aligned(*numbers, *([y for x in each for y in getattr(x, n)] for n in ("pairs", "times", "groups")))

    @staticmethod
    def joined(found: list[Aligned]) -> Aligned:
        if not all(x.n_a[0] for x in found):
            none = np.zeros(1, np.int64)
            return Aligned(none, none, none, none, [none[:0]], [none[:0]], [memoryview(b"")])
        numbers = [sum(getattr(x, n) for x in found) for n in ("n_a", "n_b", "n_groups", "n_links")]
        pairs, back = np.unique(np.concatenate([x.pairs[0] for x in found]), return_inverse=True)
        times = np.bincount(back, np.concatenate([x.times[0] for x in found])).astype(np.int64)
        return Aligned(*numbers, [pairs], [times], [memoryview(b";".join(x.groups[0] for x in found))])

    def some(self, texts: list[str]) -> Aligned:
        n = len(texts)
        spaced = [" " + t for t in texts]
        written = [t.encode() for t in spaced]
        found = self.first(spaced)
        unit = np.dtype(self.first.kind).itemsize
        ids_a = np.frombuffer(b"".join(found), self.first.kind).astype(np.int64)
        begin_a = np.concatenate([[0], np.cumsum([len(f) // unit for f in found])])
        ids_b, begin_b = self.second(texts)
        size = np.array([len(w) for w in written], np.int64)
        rows = np.array([bool(t) for t in texts])
        for ids, begin, side in ((ids_a, begin_a, self.a), (ids_b, begin_b, self.b)):
            ends = np.concatenate([[0], np.cumsum(side.lengths[ids])])[begin]
            rows &= np.diff(ends) == size
        for ids, begin, side in ((ids_a, begin_a, self.a), (ids_b, begin_b, self.b)):
            some = np.flatnonzero(rows)
            body = np.frombuffer(b"".join([written[i] for i in some.tolist()]), np.uint8)
            wrong = np.flatnonzero(side.gathered(kept(ids, begin, rows)[0]) != body)
            rows[some[np.searchsorted(np.cumsum(size[some]), wrong, side="right")]] = False
        ids_a, begin_a = kept(ids_a, begin_a, rows)
        ids_b, begin_b = kept(ids_b, begin_b, rows)
        ends_a, ends_b, text_ends = (np.cumsum(x) for x in (self.a.lengths[ids_a], self.b.lengths[ids_b], size[rows]))
        total = int(text_ends[-1]) if len(text_ends) else 0
        is_a, is_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        is_a[ends_a], is_b[ends_b] = True, True
        # Stretches end where either has an end; before an end lie as many tokens as ends.
        stretch = np.flatnonzero(is_a | is_b)
        seen_a, seen_b = np.cumsum(is_a, dtype=np.int32), np.cumsum(is_b, dtype=np.int32)
        pair = ids_a[seen_a[stretch] - is_a[stretch]] * self.width + ids_b[seen_b[stretch] - is_b[stretch]]
        both = is_a & is_b
        seen = np.cumsum(both, dtype=np.int32)
        groups_of = [seen[e] - both[e] for e in (ends_a, ends_b)]
        edges = np.concatenate([[0], text_ends])
        n_links = np.diff(np.searchsorted(stretch, edges, side="right"))
        n_groups = np.diff(seen[edges]) if total else np.zeros(0, np.int64)
        # Pairs by text, then value.
        text = np.repeat(np.arange(len(text_ends)), n_links)
        top = int(self.width) * len(self.a.lengths)
        order = np.sort(text * top + pair)
        first = np.flatnonzero(np.diff(order, prepend=-1))
        times = np.diff(np.append(first, len(order)))
        order = order[first]
        cuts = np.searchsorted(order, np.arange(1, len(text_ends)) * top)
        out_pairs, out_times = np.split(order % top, cuts), np.split(times, cuts)
        shown = self.shown(ids_a, ids_b, *groups_of, np.cumsum(n_groups))

        def full(values: np.ndarray) -> np.ndarray:
            out = np.zeros(n, np.int64)
            out[rows] = values
            return out

        def listed(values: list, none: object) -> list:
            held = iter(values)
            return [next(held) if r else none for r in rows.tolist()]

        empty = np.empty(0, np.int64)
        return Aligned(
            full(np.diff(begin_a)), full(np.diff(begin_b)), full(n_groups), full(n_links), listed(out_pairs, empty), listed(out_times, empty),
            listed(shown, memoryview(b"")),
        )

    def shown(self, ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, last: np.ndarray) -> list[memoryview]:
        """The groups of each text as a1,a2|b1;a3|b2,b3; ``last`` counts the groups up to each text's end."""
        if not len(last):
            return []
        count = int(last[-1])
        size_a, size_b = np.bincount(group_a, minlength=count), np.bincount(group_b, minlength=count)
        begin = np.cumsum(size_a + size_b) - size_a - size_b
        at_a = np.arange(len(ids_a)) + (begin - (np.cumsum(size_a) - size_a))[group_a]
        at_b = np.arange(len(ids_b)) + (begin + size_a - (np.cumsum(size_b) - size_b))[group_b]
        ids, after = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = ids_a, ids_b
        after[begin + size_a - 1] = ord("|")
        after[begin + size_a + size_b - 1] = ord(";")
        body, ends = self.decimals.written(ids, after)
        stops = ends[(begin + size_a + size_b)[last - 1] - 1].tolist()
        view = memoryview(body)
        # Without the mark behind a text's last group.
        return [view[a : b - 1] for a, b in zip([0, *stops], stops)]


class Tally:
    """Sums of counts by pair, added up whenever many have come."""

    def __init__(self) -> None:
        self.pairs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        self.pairs.append(pairs)
        self.counts.append(counts)
        self.size += len(pairs)
        if self.size > GATHERED:
            self.compact()

    def compact(self) -> None:
        pairs, counts = np.concatenate(self.pairs), np.concatenate(self.counts)
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], counts[order]
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        self.pairs, self.counts = [pairs[first]], [np.add.reduceat(counts, first)] if len(first) else [counts]
        self.size = len(first)

    def taken(self, least: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All sums in pieces, if there are more than ``least``."""
        if self.pairs:
            self.compact()
        if self.size > least:
            [pairs], [counts] = self.pairs, self.counts
            self.__init__()
            for i in range(0, len(pairs), PER_FILE):
                yield pairs[i : i + PER_FILE], counts[i : i + PER_FILE]


def packed(values: np.ndarray, kind: str) -> bytes:
    return values.astype(kind).tobytes()


# A row for each text, and rows without a key for the counts of a task's pairs.
TEXTS = [("key", pa.binary()), ("n", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
         ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())]
TEXT_COLUMNS = "key binary, n long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def align_texts(definition: str, model: sentence_pieces.PieceModel, full: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, text, n) to measures and pairs; ``full`` adds the groups written out."""
    schema = pa.schema(TEXTS + [("groups", pa.string())] * full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, tally = Aligner(definition, model), Tally()

        def counted(least: int) -> Iterator[pa.RecordBatch]:
            for pairs, counts in tally.taken(least):
                row = dict.fromkeys(schema.names) | {"pairs": packed(pairs, "<i8"), "times": packed(counts, "<i8")}
                yield pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for part, texts in slices(batch, "text", STEP_BYTES):
                found = align([t.decode("utf-8", "replace") for t in texts])
                n = part.column("n").to_numpy()
                tally.add(np.concatenate(found.pairs), np.repeat(n, [len(p) for p in found.pairs]))
                shown = [hashlib.sha256(g).hexdigest() if a else "" for g, a in zip(found.groups, found.n_a.tolist())]
                columns = [
                    part.column("key"), part.column("n"), *(pa.array(x) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)), pa.array(shown),
                    pa.array([packed(p, "<i8") for p in found.pairs]), pa.array([packed(t, "<u4") for t in found.times]),
                ]
                columns += [pa.array([bytes(g).decode() for g in found.groups])] * full
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                yield from counted(GATHERED // 2)
        yield from counted(0)

    return run


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of several tasks, added up before they are shuffled."""
    tally = Tally()
    for batch in batches:
        for pairs, counts in zip(batch.column("pairs"), batch.column("times")):
            tally.add(np.frombuffer(pairs.as_buffer(), "<i8"), np.frombuffer(counts.as_buffer(), "<i8"))
            for some in tally.taken(GATHERED // 2):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in some], ["pair", "n"])
    for some in tally.taken():
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in some], ["pair", "n"])


def write_counts(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Files of ascending pairs and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            pairs, counts = (batch.column(c).to_numpy() for c in ("pair", "n"))
            if len(pairs):
                name = f"pairs-{part}-{seq}"
                shared_write(folder, name, [pairs, counts])
                yield pa.RecordBatch.from_pylist([{"lowest": int(pairs[0]), "name": name}])
                seq += 1

    return run


class Counts:
    """Counts of pairs from the files."""

    def __init__(self, folder: str, files: list[tuple[int, str]]):
        self.folder, self.files = folder, sorted(files)
        self.lowest = np.array([f[0] for f in self.files], np.int64)
        self.open: dict[int, np.ndarray] = {}

    def file(self, i: int) -> np.ndarray:
        if i not in self.open:
            if len(self.open) >= OPEN_FILES:
                self.open.pop(next(iter(self.open)))
            self.open[i] = shared_read(self.folder, self.files[i][1], np.int64).reshape(2, -1)
        return self.open[i]

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of ascending pairs, all of which are held."""
        out = np.zeros(len(pairs), np.int64)
        edges = np.append(np.searchsorted(pairs, self.lowest), len(pairs)).tolist()
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            if a < b:
                keys, counts = self.file(i)
                out[a:b] = counts[np.searchsorted(keys, pairs[a:b])]
        return out


def weigh(folder: str, files: list[tuple[int, str]], best: np.ndarray, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What the links of each text count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(folder, files)
        for batch in batches:
            for part, rows in slices(batch, "pairs", 8 * GATHERED // 2):
                pairs = np.frombuffer(b"".join(rows), "<i8")
                times = np.frombuffer(b"".join(part.column("times").to_pylist()), "<u4").astype(np.int64)
                asked, back = np.unique(pairs, return_inverse=True)
                count = counts.find(asked)
                top = (count == best[asked // width])[back]
                ends = np.concatenate([[0], np.cumsum([len(r) // 8 for r in rows])])
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * top, times * count[back])]
                columns = [c for name, c in zip(part.schema.names, part.columns) if name not in ("pairs", "times")]
                names = [name for name in part.schema.names if name not in ("pairs", "times")]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(np.diff(s[ends])) for s in sums)], [*names, "n_best", "count_sum"])

    return run


@dataclass
class Alignment:
    """Tables in the shared folder: ``texts``, a row of measures for each distinct text, and ``pairs`` (a, b, n), the documents of each id pair."""

    texts: DataFrame
    pairs: DataFrame


def text_key(text: str = "text") -> Column:
    return F.unhex(F.sha2(col(text), 256))


def align(docs: DataFrame, tokenizer: str | None = None, model: sentence_pieces.PieceModel | None = None, full: bool = False) -> Alignment:
    """Align every distinct text; ``full`` keeps the groups written out, which take several times the text's size."""
    spark, model = docs.sparkSession, model or sentence_pieces.read_model()
    with open(tokenizer or token_files.tokenizer_file(), encoding="utf-8") as f:
        definition = f.read()
    given = docs.filter("text is not null and text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    columns = TEXT_COLUMNS + ", groups string" * full
    found = stored(given.select(text_key().alias("key"), "text", "n").mapInArrow(align_texts(definition, model, full), columns), "aligned")
    counted = found.filter("key is null").select("pairs", "times").mapInArrow(add_up, "pair long, n long")
    counted = stored(counted.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    pairs = counted.select(F.expr(f"pair div {model.size}").alias("a"), F.expr(f"pair % {model.size}").alias("b"), "n")
    # One row per id of the vocabulary, and one per file.
    best = np.zeros(max(token_files.Encoder(definition).tokenizer.get_vocab_size(), 1), np.int64)
    for row in pairs.groupBy("a").agg(F.max("n").alias("n")).collect():
        best[row["a"]] = row["n"]
    folder = scratch_path(spark, "pair-files")
    ranged = counted.repartitionByRange(pieces(counted.count(), PER_FILE), "pair").sortWithinPartitions("pair")
    files = stored(ranged.mapInArrow(write_counts(folder), "lowest long, name string"), "pair-file-list")
    listed = [(r["lowest"], r["name"]) for r in files.collect()]
    columns = ", ".join(c for c in columns.split(", ") if not c.startswith(("pairs", "times"))) + ", n_best long, count_sum long"
    return Alignment(stored(found.filter("key is not null").mapInArrow(weigh(folder, listed, best, model.size), columns), "weighed"), pairs)


def by_document(docs: DataFrame, texts: DataFrame, measures: list[str]) -> DataFrame:
    """(doc_id, measures) of every row of ``docs``; null for texts that ``texts`` doesn't hold."""
    most = texts.agg((F.sum("n") * HOT).alias("most")).first()["most"] or 0
    often = texts.withColumn("_tasks", F.when(col("n") > most, F.ceil(col("n") / F.lit(max(most, 1.0)))).otherwise(1).cast("int"))
    # Fewer than 1 / HOT texts can have more than that share of all rows.
    hot = often.filter("_tasks > 1").select("key", "_tasks")
    given = docs.select(col("doc_id").cast("long"), text_key().alias("key"))
    dealt = given.join(F.broadcast(hot), "key", "left").withColumn(
        "_task", F.coalesce(F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), col("_tasks")).cast("int"), F.lit(0))
    )
    held = often.withColumn("_task", F.explode(F.sequence(F.lit(0), col("_tasks") - 1))).select("key", "_task", *measures)
    return dealt.join(held, ["key", "_task"], "left").select("doc_id", *measures)


MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def op12_alignment(docs: DataFrame) -> DataFrame:
    rows = by_document(docs, align(docs).texts, [*MEASURES, "groups_sha256"])
    return rows.select("doc_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in MEASURES), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
