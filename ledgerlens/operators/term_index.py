"""A term index with block maxima: exact top-k by weighted terms that skips what can't be among the best.

A posting is a term of a row with its weight, the term's count times the
term's rarity in whole thousandths, so scores are whole numbers and equal in
any order of summation. Rows are dealt into blocks by the rarest term they
have, which keeps rows about one subject together. For every term and block
the largest weight is stored; the sum over a query's terms bounds the score of
every row in the block. Texts, and then piles of rows with lists of their terms, are
what is shuffled to build it; single postings are not. A search takes the
maxima of its own terms together.

A search scores a few blocks with the highest bounds, takes the k-th score
found as the floor, and then scores only blocks whose bound reaches it: every
block has bits for the queries it is open to, and its postings meet no others.
A row's scores are summed in one task, which hands on its k best.

Rows and queries without an id or without terms take no part. Ids must be
unique. Equal scores go to the smaller id.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What stands between terms.
BETWEEN = r"[^\p{L}\p{N}]+"
ROWS_PER_BLOCK = 16
# Bytes of text of a pile of rows, and postings that a task gives at a time.
PILE_BYTES = 4_000_000
POSTING_ROWS = 200_000
PILE = "first {id}, ids array<{id}>, sizes binary, places binary, counts binary, words array<string>, held array<long>"
# Parts into which the rows of a block are dealt for scoring, so that a large one is several tasks' work.
PARTS = 8


def terms(text: str) -> Column:
    return F.filter(F.split(F.lower(F.col(text)), BETWEEN), lambda t: t != "")


def counted(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, n) of every term of a row; texts of a key meet before they are split, so that no term is shuffled."""
    met = df.filter(F.col(key).isNotNull()).select(key, text).repartition(key)
    listed = met.select(key, F.explode(terms(text)).alias("term"))
    return listed.groupBy(key, "term").agg(F.count("*").alias("n"))


@dataclass
class TermIndex:
    """Stored tables: postings (term, block, id, weight) and maxima (term, block, most) of each pile; the largest is the block's."""

    postings: DataFrame
    maxima: DataFrame


def piles(rows: DataFrame, key: str, text: str, size: int = PILE_BYTES) -> DataFrame:
    """Terms of rows, many rows to a pile: (first, ids, sizes, places, counts, words, held).

    Row i of a pile has the next ``sizes[i]`` of ``places`` and ``counts``: where
    a term is in ``words``, and how often the row has it. ``held`` says how many
    rows have each word, ``first`` is the first of ``ids``. Texts of a key meet,
    and are put in order, before they are split.
    """
    met = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), text).repartition("id").sortWithinPartitions("id")
    # Terms with one blank between them, which pass to a task at less cost than lists of them.
    given = met.select("id", F.coalesce(F.regexp_replace(F.lower(text), BETWEEN, " "), F.lit("")).alias("terms"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            ends = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("terms")).to_numpy())])
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
                whole, last = counted_rows(batch.slice(at, upto - at), last)
                yield from pile(whole)
                at = upto
        if last is not None:
            yield from pile(last)

    return given.mapInArrow(run, PILE.format(id=given.schema["id"].dataType.simpleString()))


@dataclass
class Counts:
    """How often each row has which word: entries in order of rows."""

    ids: pa.Array
    words: pa.Array
    row: np.ndarray
    word: np.ndarray
    n: np.ndarray

    def of(self, chosen: np.ndarray, ids: pa.Array, first: int) -> Counts:
        """The chosen entries, of the rows from ``first``; words that none of them has are left out."""
        used, word = np.unique(self.word[chosen], return_inverse=True)
        return Counts(ids, self.words.take(pa.array(used)), self.row[chosen] - first, word, self.n[chosen])


def counted_rows(batch: pa.RecordBatch, last: Counts | None) -> tuple[Counts, Counts]:
    """Counts of all rows but those of the last key, and of that one, which may go on; ``last`` is what the batch before left."""
    given = pc.split_pattern(batch.column("terms"), " ")
    ids, found = batch.column("id"), given.flatten()
    row = np.repeat(np.arange(len(ids)), np.diff(given.offsets.to_numpy()))
    # Nothing stands before a first blank or behind a last one.
    some = pc.not_equal(found, "")
    found, row = found.filter(some), row[some.to_numpy(zero_copy_only=False)]
    if last is not None:
        ids, found = pa.concat_arrays([last.ids, ids]), pa.concat_arrays([last.words, found])
    # Rows of a key stand together.
    number = ids.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    coded = found.dictionary_encode()
    words, word = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    before = 0 if last is None else len(last.words)
    many = max(len(words), 1)
    of_row = number if last is None else number[1:]
    key, n = np.unique(of_row[row] * many + word[before:], return_counts=True)
    if before:
        # The row that went on: its new entries and those it had.
        its = int(np.searchsorted(key, many))
        joined, same = np.unique(np.concatenate([word[:before][last.word], key[:its]]), return_inverse=True)
        sums = np.zeros(len(joined), np.int64)
        np.add.at(sums, same, np.concatenate([last.n, n[:its]]))
        key, n = np.concatenate([joined, key[its:]]), np.concatenate([sums, n[its:]])
    counts = Counts(ids, words, key // many, key % many, n)
    each = ids.take(pa.array(np.unique(number, return_index=True)[1]))
    end, cut = int(number[-1]), int(np.searchsorted(key, int(number[-1]) * many))
    return counts.of(np.arange(cut), each[:end], 0), counts.of(np.arange(cut, len(key)), each[end:], end)


def pile(counts: Counts) -> Iterator[pa.RecordBatch]:
    """Rows without terms take no part."""
    rows, sizes = np.unique(counts.row, return_counts=True)
    if len(rows):
        ids = counts.ids.take(pa.array(rows))
        held = np.bincount(counts.word, minlength=len(counts.words))
        parts = [pa.array([a.astype(np.int32).tobytes()], pa.binary()) for a in (sizes, counts.word)]
        lists = [one(ids), *parts, pa.array([counts.n.astype(np.int64).tobytes()], pa.binary()), one(counts.words), one(pa.array(held))]
        yield pa.RecordBatch.from_arrays([ids[:1], *lists], ["first", "ids", "sizes", "places", "counts", "words", "held"])


def one(values: pa.Array) -> pa.Array:
    """A column of one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def placed(met: DataFrame) -> DataFrame:
    """Postings (term, block, id, weight, most) of piles with ``rated``, the (place, rarity, block) of their words.

    They are ordered by term and block within a pile, and the first one of both has ``most``, the pile's largest weight of them.
    """
    kind = met.schema["first"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, words, rated = (batch.column(c)[i].values for c in ("ids", "words", "rated"))
                sizes, word = (np.frombuffer(batch.column(c)[i].as_py(), np.int32) for c in ("sizes", "places"))
                n = np.frombuffer(batch.column("counts")[i].as_py(), np.int64)
                rarity, at_block = np.zeros((2, len(words)), np.int64)
                place = rated.field("place").to_numpy()
                rarity[place], at_block[place] = rated.field("rarity").to_numpy(), rated.field("block").to_numpy()
                by_name = np.empty(len(words), np.int64)
                by_name[pc.array_sort_indices(words).to_numpy()] = np.arange(len(words))
                # A row's rarest term, the smallest of equally rare ones.
                order = np.lexsort((by_name, -rarity))
                rank = np.empty(len(words), np.int64)
                rank[order] = np.arange(len(words))
                rarest = order[np.minimum.reduceat(rank[word], np.cumsum(sizes) - sizes)]
                row = np.repeat(np.arange(len(sizes)), sizes)
                block, weight = at_block[rarest][row], n * rarity[word]
                by_term = np.lexsort((block, by_name[word]))
                word, block, weight, row = word[by_term], block[by_term], weight[by_term], row[by_term]
                first = np.concatenate([[True], (word[1:] != word[:-1]) | (block[1:] != block[:-1])])
                begins, most = np.flatnonzero(first), np.zeros(len(word), np.int64)
                most[begins] = np.maximum.reduceat(weight, begins)
                for at in range(0, len(word), POSTING_ROWS):
                    some = slice(at, at + POSTING_ROWS)
                    names, whose = words.take(pa.array(word[some])), ids.take(pa.array(row[some]))
                    columns = [names, pa.array(block[some]), whose, pa.array(weight[some]), pa.array(most[some], mask=~first[some])]
                    yield pa.RecordBatch.from_arrays(columns, ["term", "block", "id", "weight", "most"])

    return met.mapInArrow(run, f"term string, block long, id {kind}, weight long, most long")


def build_terms(rows: DataFrame, id_col: str, text: str, per_block: int = ROWS_PER_BLOCK) -> TermIndex:
    """Index the texts of all rows."""
    found = written(piles(rows, id_col, text), "terms")
    total = found.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).scalar()
    held = found.select(F.explode(F.arrays_zip("words", "held")).alias("_w")).groupBy(F.col("_w.words").alias("term")).agg(F.sum("_w.held").alias("df"))
    blocks = F.greatest(F.ceil(total / F.lit(per_block)), F.lit(1)).cast("long")
    rarity = F.round(1000 * F.log(1 + total / F.col("df"))).cast("long")
    rated = written(held.select("term", rarity.alias("rarity"), F.pmod(F.xxhash64("term"), blocks).alias("block")), "rarity")
    # What is joined is the words of piles, each once a pile, and not the postings.
    known = found.select("first", F.posexplode("words").alias("place", "term")).join(rated, "term")
    known = known.groupBy("first").agg(F.collect_list(F.struct("place", "rarity", "block")).alias("rated"))
    postings = written(placed(found.join(known, "first")), "postings")
    return TermIndex(postings.drop("most"), postings.filter(F.col("most").isNotNull()).select("term", "block", "most"))


def bounds(index: TermIndex, asked: DataFrame) -> DataFrame:
    """(query_id, block, bound): no row of the block scores more."""
    known = index.maxima.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term", "block").agg(F.max("most").alias("most"))
    met = asked.join(known, "term")
    return met.groupBy("query_id", "block").agg(F.sum(F.col("n") * F.col("most")).alias("bound"))


def numbered(asked: DataFrame) -> DataFrame:
    """(query_id, slot, bit): a place for each query in words of 64 bits. One row a query passes through one task."""
    at = F.row_number().over(Window.orderBy("query_id")) - 1
    return asked.select("query_id").distinct().select("query_id", F.floor(at / 64).cast("int").alias("slot"), (at % 64).alias("bit"))


def scores(index: TermIndex, asked: DataFrame, places: DataFrame, blocks: DataFrame, many: bool) -> DataFrame:
    """(query_id, id, score) of all rows of the given (query_id, block) that have a term of the query.

    With ``many`` blocks the postings of asked terms are shuffled once, and no
    row's parts of a score; with few, the blocks may be sent to all tasks.
    """
    open_to = blocks.join(places, "query_id").groupBy("block", "slot").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    open_to = open_to.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    known = index.postings.join(asked.select("term").distinct(), "term", "left_semi")
    known = known.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int"))
    near = known.join(open_to.hint("merge") if many else open_to, ["block", "part"])
    met = near.join(asked.join(places, "query_id"), ["term", "slot"]).filter("(shiftright(bits, bit) & 1) = 1")
    return met.groupBy("query_id", "block", "part", "id").agg(F.sum(F.col("n") * F.col("weight")).alias("score")).select("query_id", "id", "score")


@dataclass
class Search:
    """Hits (query_id, id, score, rank), and (query_id, blocks, scored): how many blocks were bounded and how many read."""

    hits: DataFrame
    effort: DataFrame


def search_terms(index: TermIndex, queries: DataFrame, text: str, k: int = 10, first: int = 4) -> Search:
    """The exact ``k`` best rows of each query (query_id, text)."""
    asked = written(counted(queries, "query_id", text), "asked-terms")
    places = written(numbered(asked), "query-places")
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    ranked = written(bounds(index, asked).withColumn("_n", F.row_number().over(by_bound)), "bounds")
    seeds = written(scores(index, asked, places, ranked.filter(F.col("_n") <= first), False), "seeds")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    floors = seeds.withColumn("_n", F.row_number().over(by_score)).filter(F.col("_n") == k).select("query_id", F.col("score").alias("floor"))
    # A row that equals the floor may have a smaller id, so its block is read as well.
    open_ = ranked.filter(F.col("_n") > first).join(floors, "query_id", "left").filter(F.col("bound") >= F.coalesce("floor", F.lit(0)))
    open_ = written(open_.select("query_id", "block"), "open-blocks")
    every = seeds.unionByName(scores(index, asked, places, open_, True))
    hits = every.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    read = ranked.filter(F.col("_n") <= first).select("query_id", "block").unionByName(open_).groupBy("query_id").agg(F.count("*").alias("scored"))
    effort = ranked.groupBy("query_id").agg(F.count("*").alias("blocks")).join(read, "query_id")
    return Search(hits, effort)
