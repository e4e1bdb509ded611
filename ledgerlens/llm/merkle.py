"""A Merkle manifest of a table: a tree per group of rows, a tree over the groups, and a proof for every row.

Rows of a group ascend by their order columns. Each leaf gets its place from a
range sort and running counts of its parts, so no task sees a whole group. A
block is an aligned range of ``BLOCK`` leaves; one task makes its subtree.

Above the blocks there is no walk up and down again, but a butterfly: in round
r the blocks of aligned groups of ``fanout`` partners, each at the same place
of its own subtree of fanout ** r blocks, swap the roots they hold. Every block
hashes them itself, so all blocks of a subtree hold its root, and each block
has collected its siblings of that level. After log(blocks) rounds each block
knows the root and the upper part of its leaves' proofs. Where the last
subtree has fewer blocks than its neighbours, its members answer in turn.

Nodes are lowercase hex sha256 of their children's hex digests; a run of fewer
nodes than ``fanout``, even of one, is hashed like any other as long as its
level has several nodes. Tables hold digests as 32 bytes.

Nulls anywhere are values of their own: a null group is a group and comes
first, a null order value comes first, null and empty texts differ. Rows that
are equal in all columns are counted before the sort and get neighbouring
leaves; equal order values with unlike content are ordered by their leaf. An
empty table gives an empty manifest. Texts of any length are hashed where they
are read and never moved. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import by_value, crc_mod, pieces, stored

by_value(__name__)

FANOUT = 2
# Leaves of a block, a power of the fanout at most this; rows of a sorted part.
BLOCK = 4096
PART_ROWS = 1_000_000


def height(leaves: int, fanout: int) -> int:
    levels, reach = 0, 1
    while reach < leaves:
        levels, reach = levels + 1, reach * fanout
    return levels


def largest_power(fanout: int, most: int) -> int:
    block = fanout
    while block * fanout <= most:
        block *= fanout
    return block


def value_part(value: Column) -> Column:
    """A value with its length in bytes, so that no two rows have one text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(value_part(v) for v in values)), 256))


def shown(node: str) -> Column:
    return F.lower(F.hex(node))


# Rows of a tree: group, order, leaf, and one more digest that travels with the leaf.
PLACED = "tree string, block long, first long, n long, total long, at {order}, leaf binary, changed binary"


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which part of the sorted rows this is, and how many leaves of the same tree come before each row in it."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        counts, trees = batch.column("n").to_numpy(zero_copy_only=False), batch.column("tree")
        names = trees.dictionary_encode()
        code = names.indices.to_numpy(zero_copy_only=False)
        sums = np.cumsum(counts) - counts
        first = np.flatnonzero(np.diff(code, prepend=-1))
        # A tree that goes on from the batch before keeps its count.
        carried = np.zeros(len(first), np.int64)
        carried[0] = seen if trees[0].as_py() == last else 0
        before = sums + np.repeat(carried - sums[first], np.diff(np.append(first, len(code))))
        last, seen = trees[len(code) - 1].as_py(), int(before[-1] + counts[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(code), part, np.int64)), pa.array(before)], [*batch.schema.names, "part", "before"]
        )


def placed_leaves(leaves: DataFrame, block: int) -> DataFrame:
    """Give every row (tree, at, leaf, changed) its place; equal rows are one row with a first place and a count."""
    counted = stored(leaves.groupBy("tree", "at", "leaf", "changed").agg(F.count(F.lit(1)).alias("n")), "merkle-leaves")
    order = [col("tree").asc(), col("at").asc_nulls_first(), col("leaf").asc()]
    schema = counted.select("*", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("before")).schema
    ordered = counted.repartitionByRange(pieces(counted.count(), PART_ROWS), *order).sortWithinPartitions(*order)
    ordered = stored(ordered.mapInArrow(numbered, schema), "merkle-order")
    # A row per part and tree.
    sums = ordered.groupBy("tree", "part").agg(F.sum("n").alias("_n"))
    by_tree = Window.partitionBy("tree")
    earlier = by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "tree", "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"), F.sum("_n").over(by_tree).alias("total")
    )
    met = ordered.join(stored(starts, "merkle-starts"), ["tree", "part"])
    first, stop = col("before") + col("_start"), col("before") + col("_start") + col("n")
    met = met.withColumns({"_first": first, "_stop": stop})
    touched = F.explode(F.sequence(F.expr(f"_first div {block}"), F.expr(f"(_stop - 1) div {block}")))
    met = met.withColumn("block", touched)
    begin = F.greatest("_first", col("block") * block)
    end = F.least("_stop", (col("block") + 1) * block)
    kept = met.select("tree", "block", begin.alias("first"), (end - begin).alias("n"), "total", "at", "leaf", "changed")
    return stored(kept, "merkle-placed")


def subtree(leaves: list[bytes], levels: int, fanout: int) -> list[list[bytes]]:
    """All levels of a block, leaves first."""
    made = [leaves]
    for _ in range(levels):
        below = [x.hex() for x in made[-1]]
        made.append([sha256("".join(below[i : i + fanout]).encode()).digest() for i in range(0, len(below), fanout)])
    return made


def expanded(table: pa.Table) -> tuple[pa.Table, list[bytes]]:
    """A row per leaf of a block, in order."""
    table = table.sort_by("first")
    counts = table.column("n").to_numpy()
    if (counts != 1).any():
        table = table.take(pa.array(np.repeat(np.arange(len(counts)), counts)))
    return table, table.column("leaf").to_pylist()


def block_roots(fanout: int, most: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        first = {c: table.column(c)[0].as_py() for c in ("tree", "block", "total")}
        _, leaves = expanded(table)
        [root] = subtree(leaves, min(most, height(first["total"], fanout)), fanout)[-1]
        row = {**first, "root": root, "siblings": b"", "turns": b""}
        return pa.Table.from_pylist([row], pa.schema([
            ("tree", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("root", pa.binary()), ("siblings", pa.binary()), ("turns", pa.binary()),
        ]))

    return run


BLOCKS = "tree string, block long, total long, root binary, siblings binary, turns binary"


def exchange(blocks: DataFrame, block: int, fanout: int, done: int) -> DataFrame:
    """One round of the butterfly; ``done`` rounds are over, so that a block holds the root of fanout ** done blocks."""
    span = fanout**done
    count = F.expr(f"(total + {block - 1}) div {block}")
    # Trees with no more blocks than that have their root.
    whole = blocks.filter(count <= span)
    base = F.expr(f"block div {span * fanout} * {span * fanout}")
    own, place = F.expr(f"block % {span * fanout} div {span}"), F.expr(f"block % {span}")
    run = F.least(F.lit(fanout).cast("long"), F.expr(f"(_count - _base + {span - 1}) div {span}"))
    asking = blocks.withColumn("_count", count).filter(col("_count") > span).withColumns({"_base": base, "_own": own, "_place": place})
    asking = asking.withColumn("_run", run).withColumn("_turn", F.explode(F.sequence(F.lit(0).cast("long"), col("_run") - 1)))
    start = col("_base") + col("_turn") * span
    # Members of a smaller subtree answer several askers each.
    asking = asking.withColumn("_partner", start + col("_place") % F.least(F.lit(span).cast("long"), col("_count") - start))
    held = blocks.select(col("tree"), col("block").alias("_partner"), col("root").alias("_theirs"))
    mine = col("_turn") == col("_own")
    met = asking.join(held, ["tree", "_partner"]).select(
        "tree", "block", "total", "_own", "_run", "_turn", "_theirs",
        F.when(mine, col("siblings")).alias("siblings"), F.when(mine, col("turns")).alias("turns"),
    )
    # At most ``fanout`` roots a block.
    swapped = met.groupBy("tree", "block", "total", "_own", "_run").agg(
        F.array_sort(F.collect_list(F.struct("_turn", "_theirs"))).alias("_roots"),
        F.max("siblings").alias("siblings"), F.max("turns").alias("turns"),
    )
    joined = F.array_join(F.transform("_roots", lambda x: F.lower(F.hex(x["_theirs"]))), "")
    others = F.array_join(F.transform(F.filter("_roots", lambda x: x["_turn"] != col("_own")), lambda x: F.hex(x["_theirs"])), "")
    turn = F.unhex(F.concat(F.lpad(F.hex("_own"), 2, "0"), F.lpad(F.hex("_run"), 2, "0")))
    after = swapped.select(
        "tree", "block", "total", F.unhex(F.sha2(joined, 256)).alias("root"),
        F.concat("siblings", F.unhex(others)).alias("siblings"), F.concat("turns", turn).alias("turns"),
    )
    return stored(whole.unionByName(after), "merkle-round")


def climbed(placed: DataFrame, block: int, fanout: int) -> DataFrame:
    """Every block with its tree's root and the siblings above it."""
    roots = placed.groupBy("tree", "block").applyInArrow(block_roots(fanout, height(block, fanout)), BLOCKS)
    blocks = stored(roots, "merkle-blocks")
    most = pieces(blocks.agg(F.max("total")).first()[0] or 1, block)
    for done in range(height(most, fanout)):
        blocks = exchange(blocks, block, fanout, done)
    return blocks


def block_paths(fanout: int, most: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Every leaf of a block with all its siblings, from the leaf to the block's root and on."""

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        table, leaves = expanded(table)
        levels = subtree(leaves, min(most, height(table.column("total")[0].as_py(), fanout)), fanout)
        siblings, turns = [above.column("siblings")[0].as_py()], [above.column("turns")[0].as_py()]
        for level in reversed(levels[:-1]):
            next_siblings, next_turns = [], []
            for start in range(0, len(level), fanout):
                some = level[start : start + fanout]
                up_siblings, up_turns = siblings[start // fanout], turns[start // fanout]
                for i in range(len(some)):
                    next_siblings.append(b"".join(some[:i] + some[i + 1 :]) + up_siblings)
                    next_turns.append(bytes([i, len(some)]) + up_turns)
            siblings, turns = next_siblings, next_turns
        n = table.num_rows
        same = [pa.array([above.column(c)[0].as_py()] * n, pa.binary()) for c in ("subroot", "root")]
        columns = {"at": table.column("at"), "leaf": table.column("leaf"), "changed": table.column("changed"), "subroot": same[0], "root": same[1]}
        return pa.table({**columns, "siblings": pa.array(siblings, pa.binary()), "turns": pa.array(turns, pa.binary())})

    return run


def manifest(leaves: DataFrame, fanout: int = FANOUT, block: int = BLOCK) -> DataFrame:
    """Proofs of rows (tree, at, leaf, changed): their order value, digests and all siblings.

    ``siblings`` are the digests of a path, level by level, each level from
    left to right; ``turns`` has two bytes a level: the node's place in its run
    and the run's length. ``changed`` is handed through. ``tree`` may not be
    null. ``fanout`` is 2 to 255.
    """
    if not 2 <= fanout <= 255:
        raise ValueError("a fanout from 2 to 255")
    block = largest_power(fanout, block)
    placed = placed_leaves(leaves, block)
    blocks = climbed(placed, block, fanout)
    # Block 0 of every tree knows its root.
    roots = blocks.filter("block = 0").select(F.lit("").alias("tree"), col("tree").alias("at"), col("root").alias("leaf"), F.lit(None).cast("binary").alias("changed"))
    top_leaves = placed_leaves(roots, block)
    top = top_leaves.groupBy("tree", "block").cogroup(
        climbed(top_leaves, block, fanout).select("*", col("root").alias("subroot")).groupBy("tree", "block")
    ).applyInArrow(
        block_paths(fanout, height(block, fanout)),
        "at string, leaf binary, changed binary, subroot binary, root binary, siblings binary, turns binary",
    )
    top = stored(top.select(col("at").alias("tree"), col("root").alias("_root"), col("siblings").alias("_s"), col("turns").alias("_t")), "merkle-top")
    above = blocks.join(top, "tree").select(
        "tree", "block", col("root").alias("subroot"), col("_root").alias("root"),
        F.concat("siblings", "_s").alias("siblings"), F.concat("turns", "_t").alias("turns"),
    )
    kind = leaves.schema["at"].dataType.simpleString()
    return placed.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(
        block_paths(fanout, height(block, fanout)),
        f"at {kind}, leaf binary, changed binary, subroot binary, root binary, siblings binary, turns binary",
    )


def folded(leaf: bytes, siblings: bytes, turns: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    at, node = 0, leaf.hex()
    for k in range(0, len(turns), 2):
        place, size = turns[k], turns[k + 1]
        left, right = at + 32 * place, at + 32 * (size - 1)
        node = sha256((siblings[at:left].hex() + node + siblings[left:right].hex()).encode()).hexdigest()
        at = right
    return bytes.fromhex(node)


def refold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("leaf", "changed", "siblings", "turns")))
        roots = [folded(leaf if changed is None else changed, s, t) for leaf, changed, s, t in rows]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.binary())], [*batch.schema.names, "folded"])


def verified(proofs: DataFrame) -> DataFrame:
    """Add ``folded``, the root recomputed from the changed leaf, if there is one, or the leaf."""
    return proofs.mapInArrow(refold, proofs.select("*", F.lit(b"").alias("folded")).schema)


def document_leaves(docs: DataFrame) -> DataFrame:
    """A leaf for every document, in a tree per language; some get a second one, with n_chars tampered with."""
    doc_id, n_chars = col("doc_id").cast("long"), col("n_chars").cast("long")
    # Wide enough for the largest count.
    more = (n_chars.cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    given = docs.select(doc_id.alias("at"), "source", "lang", n_chars.alias("n_chars"), more.alias("more"), "text", (crc_mod("doc_id", 7) == 0).alias("odd"))
    touched = col("odd") & col("at").isNotNull() & col("n_chars").isNotNull()
    leaf, other = (digest(col("at"), col("source"), col("lang"), n, col("text")) for n in (col("n_chars"), col("more")))
    # A null language sorts before all others.
    tree = F.coalesce(F.concat(F.lit("="), col("lang").cast("string")), F.lit("-"))
    return given.select(tree.alias("tree"), "at", leaf.alias("leaf"), F.when(touched, other).alias("changed"))


def op13_merkle(docs: DataFrame) -> DataFrame:
    proofs = verified(manifest(document_leaves(docs)))
    return proofs.select(
        col("at").alias("doc_id"), shown("leaf").alias("leaf"), shown("subroot").alias("subroot"), shown("root").alias("root"),
        F.sha2(shown("siblings"), 256).alias("proof_sha256"), shown("folded").alias("folded_root"), (col("folded") == col("root")).alias("verified"),
    )
