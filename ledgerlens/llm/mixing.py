"""Mixing sources to target weights by the cube method.

Every source has a target number of words. A document is taken ``floor(r)``
times for sure, r = target / size of its source, and once more with the
probability that is left over. Which documents get the extra copy is drawn by
the cube method: probabilities move along the null space of the balancing
constraints (number of documents, number of words) until they are 0 or 1.

The flight runs in blocks of bounded size, dealt by a hash within a source, so
that a source with any share of the rows is spread over tasks. A block leaves
two undecided documents at most; those of a source meet again in new blocks,
until one block per source is left, whose last documents land: constraints are
given up one after the other.

Nulls: a null source is a source of its own, sorted last; a null text has size
0; a null id is an id like any other. Repeated rows are drawn each on its own.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import bucket, by_value, stored, word_count

by_value(__name__)

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
# Documents of a block.
BLOCK = 512
EPS = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Target words of each source: (source, source_no, source_docs, source_size, target).

    ``share`` times all words are divided by weight; a target stops at ``most``
    times its source and the excess goes to the others by weight. With sources
    ordered by ``most * size / weight`` the full ones come first, so the level
    at which the others are filled follows from running sums over one row per
    source.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs")
    )
    number = F.row_number().over(Window.orderBy(col("source").asc_nulls_last()))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    numbered = by_source.withColumn("source_no", number).withColumn(
        "weight", F.element_at(listed, (col("source_no") - 1) % len(weights) + 1)
    )
    room = F.lit(most) * col("source_size")
    order = Window.orderBy(room / col("weight"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum(room).over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # The first source that isn't full sets the level for all behind it.
    levels = numbered.withColumn("_level", level).withColumn("_room", room)
    levels = levels.withColumn("_open", F.when(col("_room") >= col("_level") * col("weight"), col("_level")))
    found = levels.withColumn("_fill", F.first("_open", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ))
    target = F.when(col("_fill").isNull(), col("_room")).otherwise(F.least(col("_room"), col("_fill") * col("weight")))
    return found.select("source", "source_no", "source_docs", "source_size", target.alias("target"))


def null_vector(x: list[float]) -> list[float]:
    """A vector u with sum(u) = 0 and sum(u * x) = 0, for three or two numbers; not all zero."""
    if len(x) == 3:
        a, b, c = x
        u = [c - b, a - c, b - a]
        if any(u):
            return u
        return [1.0, -1.0, 0.0]
    return [1.0, -1.0]


def move(p: list[float], u: list[float], rng: random.Random) -> list[float]:
    """One step of the flight: along u or against it, with probabilities that keep the mean."""
    ahead = min(((1 - q) / v if v > 0 else q / -v) for q, v in zip(p, u) if v)
    back = min((q / v if v > 0 else (1 - q) / -v) for q, v in zip(p, u) if v)
    step = ahead if rng.random() * (ahead + back) < back else -back
    moved = [q + step * v for q, v in zip(p, u)]
    return [0.0 if q < EPS else 1.0 if q > 1 - EPS else q for q in moved]


def flight(p: list[float], size: list[float], rng: random.Random, land: bool) -> list[float]:
    """Probabilities after the flight; two may stay between 0 and 1, none if ``land``."""
    p = list(p)
    live: list[int] = []
    for i in [i for i, q in enumerate(p) if 0 < q < 1]:
        live.append(i)
        while len(live) == 3:
            live = advance(p, size, live, rng)
    if land:
        # The word total is given up, then the count.
        while len(live) == 2:
            live = advance(p, size, live, rng)
        for i in live:
            p[i] = 1.0 if rng.random() < p[i] else 0.0
    return p


def advance(p: list[float], size: list[float], live: list[int], rng: random.Random) -> list[int]:
    moved = move([p[i] for i in live], null_vector([size[i] for i in live]), rng)
    for i, q in zip(live, moved):
        p[i] = q
    return [i for i in live if 0 < p[i] < 1]


def fly(level: int, land: bool):
    """The flight of one block, for ``applyInPandas``."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # Large documents first, so that those undecided at the end are small and landing moves few words.
        rows = rows.sort_values(["size", "_order", "doc_id"], ascending=[False, True, True], kind="stable")
        rng = random.Random(f"{level}/{rows['source_no'].iloc[0]}/{rows['_block'].iloc[0]}")
        return rows.assign(p=flight(rows["p"].tolist(), rows["size"].astype(float).tolist(), rng, land))

    return run


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """How often each document is taken: (doc_id, tid, source, size, source_size, target, copies).

    ``tid`` tells texts under one id apart.

    The draw follows from hashes of the ids, so reruns agree.
    """
    sizes = stored(
        docs.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tid"), "source", word_count("text").alias("size")),
        "mix-sizes",
    )
    targets = stored(source_targets(sizes, weights, share, most), "mix-targets")
    ratio = F.when(col("source_size") > 0, col("target") / col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + EPS)
    units = (
        sizes.alias("s").join(targets.alias("t"), col("s.source").eqNullSafe(col("t.source")))
        .select("doc_id", "tid", "s.source", "size", "source_no", "source_docs", "source_size", "target", whole.cast("int").alias("sure"),
                F.greatest(F.lit(0.0), ratio - whole).alias("p"), F.xxhash64(F.lit("mix"), "doc_id", "tid").alias("_order"))
        .withColumn("p", F.when(col("p") < EPS, 0.0).otherwise(col("p")))
    )
    blocks = F.ceil(col("source_docs") / F.lit(block))
    dealt = units.withColumn("_block", bucket(blocks, F.lit(0), "_order")).drop("source_docs")
    done = None
    level, left = 0, None
    while left is None or left > 0:
        # One block per source is left once no source has more than a block of undecided documents.
        land = left is not None and left <= block
        if land:
            dealt = dealt.withColumn("_block", F.lit(0))
        flown = stored(dealt.groupBy("source_no", "_block").applyInPandas(fly(level, land), dealt.schema), f"mix-{level}")
        settled = flown.filter((col("p") == 0) | (col("p") == 1))
        done = settled if done is None else done.unionByName(settled)
        undecided = flown.filter((col("p") > 0) & (col("p") < 1))
        counts = stored(undecided.groupBy("source_no").agg(F.count(F.lit(1)).alias("_n")), f"mix-left-{level}")
        left = counts.agg(F.max("_n")).first()[0] or 0
        level += 1
        again = bucket(F.ceil(col("_n") / F.lit(block)), F.lit(level), "_order")
        dealt = undecided.join(counts, "source_no").withColumn("_block", again).drop("_n")
    return done.select(
        "doc_id", "tid", "source", "size", "source_size", "target", (col("sure") + col("p").cast("int")).alias("copies")
    )


def op9_source_mix(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", (col("size") * col("copies")).alias("taken"))
