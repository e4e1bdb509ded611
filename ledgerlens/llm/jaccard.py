"""Self-join of documents on the Jaccard similarity of their word n-grams.

Two sets of n and m tokens with similarity t or more have |n - m| bounded and
share a token among the first ``n - ceil(t n) + 1`` of each, under *any* order
of all tokens. Several orders are used: all put rare tokens first, by the
counts of a sketch of fixed size, and differ in how they order tokens of like
frequency. A pair becomes a candidate through a shared prefix token under the
first order, stays one only if it shares a prefix token under each of the
others, and if the parity sketches of the sets don't differ by more than two
similar sets can; then the sets themselves are compared.

Equal sets are one node from the start. Nodes that share a token and a range of
sizes are compared with one of them first (a star, not all pairs). Links found
so are contracted to components. What remains are groups that still hold
several components: small ones give their pairs across components. Large ones
are dealt into blocks; a task compares the whole sets of a block, or of two,
and gives a spanning forest of the links it finds, fewer rows than it has read.
Blocks by themselves come first, so that families of copies are contracted
before blocks meet. A group of several blocks is divided by the prefix tokens
of the further orders where that leaves less to compare, and of groups with
the same members one is kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import bucket, by_value, hashed_words, mix64, narrowed, rolling, slices, stored
from ledgerlens.llm.components import components

by_value(__name__)

SHINGLE = 3
PERCENT = 90
# Further token orders by which candidates are filtered.
ORDERS = 2
# Cells of the frequency sketch, at most; one byte each is sent to the tasks.
MAX_CELLS = 1 << 20
TOKENS_PER_CELL = 64
# Cells in which tokens held by one member of the hot groups are told from shared ones; two bits each are sent to the tasks.
SEEN = 1 << 22
# Groups up to this size give their pairs; larger ones are compared in blocks of BLOCK nodes and VOLUME tokens.
SMALL = 64
BLOCK = 512
VOLUME = 1 << 19
# Columns of the matrix in which a task counts shared tokens.
COLUMNS = 4096
SEEDS = tuple(np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89))


def token_sets(part: pa.RecordBatch, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a text of fewer words is one shingle, no words none."""
    hashes, begin = hashed_words(part, "text", lower=True)
    grams = rolling(hashes, k)
    sets = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        if b - a >= k:
            sets.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            sets.append(mix64(rolling(hashes[a:b], b - a) ^ SEEDS[3] ^ np.uint64(b - a)))
        else:
            sets.append(hashes[:0])
    return sets


def set_id(tokens: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63


def most_apart(n: int, m: int, percent: int) -> int:
    """Largest symmetric difference of two linked sets of these sizes."""
    # 100 I >= percent (n + m - I)
    least = -(-percent * (n + m) // (100 + percent))
    return n + m - 2 * least


def count_cells(cells: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Token counts per cell of what a task reads, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.uint32)
        for batch in batches:
            for part, _ in slices(batch, "text"):
                sets = token_sets(part, k)
                if sets:
                    at = np.concatenate(sets) & np.uint64(cells - 1)
                    total = added(total, np.bincount(at.astype(np.int64), minlength=cells))
        key = int(total.sum())
        yield pa.RecordBatch.from_pydict({"key": [mix_key(key)], "cells": pa.array([total.tobytes()], pa.binary())})

    return run


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums that stop at the largest 32-bit number."""
    return np.minimum(a.astype(np.int64) + b, 2**32 - 1).astype(np.uint32)


def mix_key(x: int) -> int:
    return int(mix64(np.array([x], np.uint64)).view(np.int64)[0])


def add_cells(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(rows["cells"].iloc[0], np.uint32)
    for x in rows["cells"].iloc[1:]:
        total = added(total, np.frombuffer(x, np.uint32))
    return pd.DataFrame({"key": [mix_key(int(total.sum()))], "cells": [total.tobytes()]})


def token_levels(docs: DataFrame, k: int = SHINGLE, max_cells: int = MAX_CELLS) -> np.ndarray:
    """A frequency level for each cell of tokens; its size is bounded, whatever the table's.

    Any order of the tokens gives a right join, so counts per cell are enough.
    Sketches are summed a few at a time, until one is left.
    """
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = 1 << min(int(math.log2(max_cells)), max(12, math.ceil(math.log2(chars / 6 / TOKENS_PER_CELL + 1))))
    found = merged(stored(docs.select("text").mapInArrow(count_cells(cells, k), "key long, cells binary"), "jaccard-cells"), add_cells)
    total = np.frombuffer(found, np.uint32) if found else np.zeros(cells, np.uint32)
    return np.minimum(255, np.log2(total + 1.0) * 4).astype(np.uint8)


def merged(counted: DataFrame, add: Callable[[pd.DataFrame], pd.DataFrame]) -> bytes | None:
    """The sum of the cells of a stored table of (key, cells), some rows at a time; nothing for an empty table."""
    rows = counted.count()
    while rows > 1:
        groups = max(1, rows // 8)
        counted = stored(
            counted.groupBy(bucket(groups, F.lit(rows), "key").alias("_g")).applyInPandas(add, "key long, cells binary"),
            "jaccard-cells",
        )
        rows = counted.count() if groups > 1 else 1
    found = counted.first()
    return found["cells"] if found else None


def seen_cells(cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Which cells hold a token, and which hold two or more, of the lists a task reads, as one row of bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, more = np.zeros(cells, bool), np.zeros(cells, bool)
        for batch in batches:
            at, often = np.unique(cells_of(batch.column("tokens").flatten(), cells), return_counts=True)
            more[at] |= once[at] | (often > 1)
            once[at] = True
        body = np.packbits(np.concatenate([once, more])).tobytes()
        yield pa.RecordBatch.from_pydict({"key": [mix_key(set_id(np.frombuffer(body, np.uint8)) % 2**64)], "cells": pa.array([body], pa.binary())})

    return run


def cells_of(tokens: pa.Array, cells: int) -> np.ndarray:
    return tokens.to_numpy(zero_copy_only=False).astype(np.int64) & (cells - 1)


def add_seen(rows: pd.DataFrame) -> pd.DataFrame:
    once = more = np.zeros((), np.uint8)
    for x in rows["cells"]:
        o, m = np.frombuffer(x, np.uint8).reshape(2, -1)
        once, more = once | o, more | m | (once & o)
    body = np.concatenate([once, more]).tobytes()
    return pd.DataFrame({"key": [mix_key(set_id(np.frombuffer(body, np.uint8)) % 2**64)], "cells": [body]})


def only_shared(seen: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Leave out of the lists the tokens that no other list holds; rows without any are left out as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more = np.unpackbits(np.frombuffer(seen, np.uint8)).astype(bool).reshape(2, -1)[1]
        for batch in batches:
            column = batch.column("tokens")
            tokens = column.flatten()
            keep = more[cells_of(tokens, len(more))]
            row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())[keep]
            kept = pa.ListArray.from_arrays(np.searchsorted(row, np.arange(len(column) + 1)).astype(np.int32), tokens.filter(pa.array(keep)))
            there = pa.array(np.bincount(row, minlength=len(column)) > 0)
            yield pa.RecordBatch.from_arrays([batch.column("node"), kept], ["node", "tokens"]).filter(there)

    return run


def prefix(tokens: np.ndarray, levels: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens of a set under one order, enough that linked sets share one."""
    n = len(tokens)
    take = n - -(-percent * n // 100) + 1 if n else 0
    rank = levels[(tokens & np.uint64(len(levels) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    rank |= mix64(tokens ^ SEEDS[order]) >> np.uint64(8)
    return tokens[np.argpartition(rank, take - 1)[:take]] if take < n else tokens


def first_prefixes(levels: np.ndarray, k: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in slices(batch, "text"):
                sets = token_sets(part, k)
                firsts = [prefix(s, levels, 0, percent).view(np.int64) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tid"), pa.array([set_id(s) for s in sets], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(firsts, pa.list_(pa.int64()))],
                    ["doc_id", "tid", "node", "n", "tokens"],
                )

    return run


def parity(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Which of ``bits`` buckets hold an odd number of tokens; differs in no more places than the sets do."""
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def sketched(levels: np.ndarray, k: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Parity sketch and the prefixes under the other orders, of which 32 bits are enough for a filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in slices(batch, "text"):
                sets = token_sets(part, k)
                sketches = [parity(s, 1 << max(6, (2 * len(s) - 1).bit_length())).tobytes() for s in sets]
                others = [
                    pa.array([prefix(s, levels, o, percent).astype(np.uint32).view(np.int32) for s in sets], pa.list_(pa.int32()))
                    for o in range(1, ORDERS + 1)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sketches, pa.binary()), *others],
                    ["node", "n", "sketch", *[f"other{o}" for o in range(1, ORDERS + 1)]],
                )

    return run


def whole_sets(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in slices(batch, "text"):
                sets = [s.tobytes() for s in token_sets(part, k)]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary())], ["node", "tokens"])

    return run


def linked(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compare the sets of each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for a, b in zip(batch.column("ta"), batch.column("tb")):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                shared = int((b[at] == a).sum())
                same.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v"), pa.array(same, pa.bool_())], ["u", "v", "same"]
            )

    return run


def near(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs whose parity sketches differ by no more than two linked sets can."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sizes = zip(batch.column("_n").to_pylist(), batch.column("_m").to_pylist())
            for (n, m), a, b in zip(sizes, batch.column("_sa"), batch.column("_sb")):
                a, b = np.frombuffer(a.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8)
                size = min(len(a), len(b))
                a, b = (np.bitwise_xor.reduce(x.reshape(-1, size)) for x in (a, b))
                keep.append(int(np.bitwise_count(a ^ b).sum(dtype=np.int64)) <= most_apart(n, m, percent))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of every two sets, as a product of 0-1 matrices, some columns at a time."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, at, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # A token of one set counts for no pair, a token of all sets for each.
    total = np.full((len(sets), len(sets)), float((often == len(sets)).sum()), np.float32)
    columns = np.where((often > 1) & (often < len(sets)), 0, -1)
    columns[columns == 0] = np.arange((columns == 0).sum())
    at = columns[at]
    rows, at = rows[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        a, b = np.searchsorted(at, [start, start + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[rows[a:b], at[a:b] - start] = 1
        total += held @ held.T
    return total.astype(np.int64)


def forest(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Links across components among the nodes of one block or two, as a spanning forest."""

    def run(given: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in given["tokens"]]
        node, root, block = (given[c].to_numpy() for c in ("node", "root", "_block"))
        n = np.array([len(x) for x in sets])
        shared = shared_counts(sets)
        same = 100 * shared >= percent * (n[:, None] + n[None, :] - shared)
        if given["_i"].iloc[0] != given["_j"].iloc[0]:
            # What lies in one block has been compared.
            same &= block[:, None] != block[None, :]
        tied = root[:, None] == root[None, :]
        same &= ~tied
        seen = np.zeros(len(node), bool)
        out = []
        for start in range(len(node)):
            queue = [] if seen[start] else [start]
            seen[start] = True
            while queue:
                x = queue.pop()
                for y in np.flatnonzero((same[x] | tied[x]) & ~seen).tolist():
                    seen[y] = True
                    queue.append(y)
                    if same[x, y]:
                        out.append((min(node[x], node[y]), max(node[x], node[y])))
        return pd.DataFrame(out, columns=["u", "v"]).astype({"u": "int64", "v": "int64"})

    return run


def compare(pairs: DataFrame, sets: DataFrame, whole: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """(u, v, same): whether each candidate pair is linked; pairs that a filter drops are left out.

    Filters are the sizes, a shared prefix token under each of the other orders, and the parity sketches.
    """
    a = sets.select(col("node").alias("u"), col("n").alias("_n"), col("sketch").alias("_sa"), *[col(f"other{o}").alias(f"_o{o}") for o in range(1, ORDERS + 1)])
    b = sets.select(col("node").alias("v"), col("n").alias("_m"), col("sketch").alias("_sb"), *[col(f"other{o}").alias(f"_p{o}") for o in range(1, ORDERS + 1)])
    sized = F.least("_n", "_m") * 100 >= F.greatest("_n", "_m") * percent
    shared = sized
    for o in range(1, ORDERS + 1):
        shared = shared & F.arrays_overlap(f"_o{o}", f"_p{o}")
    met = pairs.join(a, "u").join(b, "v").filter(shared).select("u", "v", "_n", "_m", "_sa", "_sb")
    return compare_all(met.mapInArrow(near(percent), "u long, v long"), whole, percent)


def similar_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, tid, n_shingles, component_id) of every row of (doc_id, text).

    ``tid`` tells texts under one id apart. A document without words has no
    shingles, no links, and is its own component. A repeated row has the same
    result; an id with several texts has a row for each, and they are linked
    only by their sets. A row without an id takes part in links, but names a
    component only if nobody else does. Shingles are compared by 64-bit
    hashes. An empty table gives an empty result. Extra columns are ignored.
    """
    given = docs.select(col("doc_id").cast("long"), "text").withColumn("tid", F.coalesce(F.xxhash64("text"), F.lit(0)))
    levels = token_levels(given, k)
    rows = stored(
        given.mapInArrow(first_prefixes(levels, k, percent), "doc_id long, tid long, node long, n long, tokens array<long>"),
        "jaccard-prefixes",
    )
    nodes = rows.filter(col("n") > 0)
    # Step by step: a token of at least two nodes, then a token and a range of sizes of at least two.
    postings = nodes.select("node", "n", F.explode("tokens").alias("token"))
    common = postings.groupBy("token").agg(F.min("node").alias("_a"), F.max("node").alias("_b")).filter(col("_a") < col("_b"))
    shared = stored(postings.join(common.select("token"), "token").distinct(), "jaccard-shared")
    # Linked sizes differ by a factor of at most 100 / percent, so they meet in one of two neighbouring ranges.
    step = math.log(100.0 / percent) + 1e-9
    band = F.floor(F.log(col("n").cast("double")) / F.lit(step)).cast("int")
    ranged = shared.withColumn("band", F.explode(F.array(band, band + 1)))
    groups = (
        ranged.groupBy("token", "band").agg(F.min("node").alias("hub"), F.max("node").alias("_b"), F.count(F.lit(1)).alias("size"))
        .filter(col("hub") < col("_b")).drop("_b")
    )
    members = stored(ranged.join(groups, ["token", "band"]), "jaccard-members")

    # The text of one document of each node that has a neighbour.
    number = F.coalesce("doc_id", F.lit(-(2**63))).alias("_doc")
    texts = nodes.select("node", "tid", number).groupBy("node").agg(F.min("_doc").alias("_doc"), F.min_by("tid", "_doc").alias("tid"))
    wanted = stored(members.select("node").distinct().join(texts, "node"), "jaccard-wanted")
    repeated = rows.select("doc_id", "tid").distinct().count() < rows.count()

    def texts(some: DataFrame) -> DataFrame:
        found = narrowed(given.select(number, "tid", "text"), some, ["_doc", "tid"]).select("node", "text")
        # Repeated rows: one of them is enough.
        return found.dropDuplicates(["node"]) if repeated else found

    def whole(some: DataFrame) -> DataFrame:
        """(node, tokens) of a table of distinct nodes. Sets are larger than their texts, so only those asked for are made."""
        asked = stored(wanted.join(some, "node"), "jaccard-asked")
        return stored(texts(asked).mapInArrow(whole_sets(k), "node long, tokens binary"), "jaccard-whole")

    sets = stored(
        texts(wanted).mapInArrow(
            sketched(levels, k, percent), "node long, n long, sketch binary, " + ", ".join(f"other{o} array<int>" for o in range(1, ORDERS + 1))
        ),
        "jaccard-sets",
    )

    star = members.filter(col("node") != col("hub")).select(col("hub").alias("u"), col("node").alias("v")).distinct()
    checked = stored(compare(star, sets, whole, percent), "jaccard-star")
    links = checked.filter("same").select("u", "v")
    roots = stored(components(links), "jaccard-roots")

    # Small groups: pairs across components.
    placed = with_roots(members.filter((col("size") > 2) & (col("size") <= SMALL)), roots)
    x = placed.select("token", "band", col("node").alias("u"), col("root").alias("_ru"), col("n").alias("_nu"))
    y = placed.select("token", "band", col("node").alias("v"), col("root").alias("_rv"), col("n").alias("_nv"))
    across = (
        x.join(y, ["token", "band"])
        .filter((col("u") < col("v")) & (col("_ru") != col("_rv")) & (F.least("_nu", "_nv") * 100 >= F.greatest("_nu", "_nv") * percent))
        .select("u", "v").distinct().join(checked.select("u", "v"), ["u", "v"], "left_anti")
    )
    found = stored(compare(across, sets, whole, percent).filter("same").select("u", "v"), "jaccard-small")
    links = links.unionByName(found)

    # Large groups: each block by itself, then blocks with one another.
    large = members.filter(col("size") > SMALL).select(F.xxhash64("token", "band").alias("key"), "node", "n")
    for step in (alone, together):
        roots = stored(components(links), "jaccard-roots")
        left = stored(open_groups(large, roots), "jaccard-large")
        if left.isEmpty():
            break
        paired = stored(step(left, sets), "jaccard-blocks")
        full = paired.join(whole(paired.select("node").distinct()), "node")
        found = full.groupBy("key", "_i", "_j").applyInPandas(forest(percent), "u long, v long")
        links = links.unionByName(stored(found.distinct(), "jaccard-forest"))
    roots = stored(components(links), "jaccard-roots")

    named = with_roots(nodes.select("node", "doc_id"), roots)
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_node = stored(with_roots(nodes.select("node").distinct(), roots).join(least, "root").select("node", "root", "component_id"), "jaccard-named")
    return rows.join(by_node, "node", "left").select(
        "doc_id", "tid", col("n").alias("n_shingles"), "root",
        F.when(col("n") > 0, col("component_id")).otherwise(col("doc_id")).alias("component_id"),
    )


def with_roots(df: DataFrame, roots: DataFrame) -> DataFrame:
    """Add the component of each node; a node without links is its own."""
    return df.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def compare_all(pairs: DataFrame, whole: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Like ``compare`` for pairs that passed the filters already."""
    pairs = stored(pairs, "jaccard-pairs")
    # Only the sets that take part are shuffled.
    some = whole(pairs.select(col("u").alias("node")).union(pairs.select("v")).distinct())
    full = pairs.join(some.select(col("node").alias("u"), col("tokens").alias("ta")), "u").join(
        some.select(col("node").alias("v"), col("tokens").alias("tb")), "v"
    )
    return full.select("u", "v", "ta", "tb").mapInArrow(linked(percent), "u long, v long, same boolean")


def block_count(size: str, volume: str) -> Column:
    return F.greatest(F.ceil(col(size) / F.lit(BLOCK)), F.ceil(col(volume) / F.lit(VOLUME))).cast("long")


def open_groups(members: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(key, node, n, root, blocks) of the groups that hold several components; of equal groups one."""
    placed = members if roots is None else with_roots(members, roots)
    placed = stored(placed.select("key", "node", "n", "root"), "jaccard-placed")
    mark = F.xxhash64("node")
    groups = (
        placed.groupBy("key")
        .agg(
            F.min("root").alias("_a"), F.max("root").alias("_b"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("volume"),
            F.bit_xor(mark).alias("_x"), F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("_y"),
        )
        .filter(col("_a") < col("_b"))
    )
    # The same members: the same number of them, and 128 bits of their marks.
    kept = groups.groupBy("size", "_x", "_y").agg(F.min("key").alias("key"), F.first("volume").alias("volume"))
    return placed.join(kept.select("key", block_count("size", "volume").alias("blocks"), "size"), "key")


def alone(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Every node in its own block."""
    block = F.pmod(F.xxhash64("node"), col("blocks")).cast("int")
    return groups.select("key", "node", "root", block.alias("_block"), block.alias("_i"), block.alias("_j"))


def shared_lists(lists: DataFrame) -> DataFrame:
    """(node, tokens) of the lists of distinct nodes, without tokens that only one of them holds.

    Rare tokens come first in a prefix, so most of its tokens divide nothing.
    Which ones may be held by two is known by cells of a sketch of fixed size:
    a cell that two tokens share keeps both, nothing shared is lost.
    """
    lists = stored(lists, "jaccard-lists")
    seen = merged(stored(lists.select("tokens").mapInArrow(seen_cells(SEEN), "key long, cells binary"), "jaccard-cells"), add_seen)
    return lists.mapInArrow(only_shared(seen), lists.schema) if seen else lists


def together(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Every node beside each other block of its group; groups are divided first where that leaves less to compare.

    Linked nodes share a prefix token under every order, so they stay together
    in one of the parts.
    """
    columns = ["key", "node", "n", "root", "size", "blocks", "_new"]
    groups = groups.filter(col("blocks") > 1).withColumn("_new", F.lit(False)).select(*columns)
    for o in range(1, ORDERS + 1):
        large = groups.filter(col("blocks") > 1)
        lists = shared_lists(sets.join(large.select("node").distinct(), "node").select("node", col(f"other{o}").alias("tokens")))
        # A member meets its list as one row, which is taken apart after that.
        met = large.select("key", "node", "n", "root").join(lists, "node")
        parts = met.select(col("key").alias("_of"), "node", "n", "root", F.explode("tokens").alias("_t"))
        parts = stored(parts.select("_of", F.xxhash64("_of", "_t").alias("key"), "node", "n", "root"), "jaccard-tokens")
        sizes = parts.groupBy("_of", "key").agg(F.count(F.lit(1)).alias("_s"), F.sum("n").alias("_v")).filter(col("_s") > 1)
        cost = sizes.groupBy("_of").agg(F.sum(col("_s") * block_count("_s", "_v")).alias("_cost"))
        costs = large.select(col("key").alias("_of"), "size", "blocks").distinct().join(cost, "_of", "left")
        divided = stored(costs.filter(F.coalesce("_cost", F.lit(0)) < col("size") * col("blocks")).select("_of"), "jaccard-divided")
        if divided.isEmpty():
            continue
        rest = groups.join(divided.withColumnRenamed("_of", "key"), "key", "left_anti").select(*columns)
        fresh = open_groups(parts.join(divided, "_of")).withColumn("_new", F.lit(True)).select(*columns)
        groups = stored(rest.unionByName(fresh), "jaccard-parts")
    met = groups.withColumn("_block", F.pmod(F.xxhash64("node"), col("blocks")).cast("int"))
    # A block meets every other block of its group once; blocks of a new part have not been compared by themselves.
    met = met.withColumn("_other", F.explode(F.sequence(F.lit(0), (col("blocks") - 1).cast("int"))))
    met = met.filter((col("_other") != col("_block")) | col("_new"))
    return met.select("key", "node", "root", "_block", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"))


def op10_jaccard(docs: DataFrame) -> DataFrame:
    return similar_components(docs).select("doc_id", "n_shingles", "component_id")
