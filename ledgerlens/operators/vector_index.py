"""A stored index of vectors: coarse cells, product-quantised residuals, exact re-rank, and syncs with its table.

Unit vectors are assigned to the nearest of some cells; what is left of a
vector beside its cell's centre is cut into parts, each replaced by the number
of the nearest of 256 code vectors. The index is a table of one row per vector,
in cell order, so a search reads the codes of a few cells' row groups, and of
the vectors themselves only the shortlist.

Centres and codes are fitted on a sample of at most ``sample`` vectors, drawn
by a hash of the id; every vector is indexed. A cell of any size is compared in
blocks, so a crowded one is many tasks.

A sync compares content ids of the table with those of the index: unchanged
rows are carried over, new and changed ones are embedded and coded, gone ones
left out. Centres and codes stay, so a synced index equals one built anew with
them.

Vectors that are null, empty, not finite or of another width are not indexed.
Ids must be unique and not null; rows and queries without one are left out.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.nearest import as_numpy, best, unit_rows
from ledgerlens.operators.retrieval import _block_topk, _ranked, similar, vector_problem
from ledgerlens.session import scratch_path, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CODES = 256
SAMPLE = 65_536
BLOCK_ROWS = 65_536


def clustered(rows: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of rows by Lloyd's rounds; a centre without rows moves to a row far from its own."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        near, off = assigned(rows, centres)
        sizes = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        full = sizes > 0
        centres[full] = sums[full] / sizes[full, None]
        far = np.argsort(-off, kind="stable")[: int((~full).sum())]
        centres[np.flatnonzero(~full)[: len(far)]] = rows[far]
    return centres


def assigned(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row and the squared distance, in slices."""
    near, off = np.zeros(len(rows), np.int64), np.zeros(len(rows))
    squares = (centres**2).sum(axis=1)
    for i in range(0, len(rows), 4096):
        some = rows[i : i + 4096]
        d = squares - 2 * some @ centres.T
        near[i : i + 4096] = d.argmin(axis=1)
        off[i : i + 4096] = d.min(axis=1) + (some**2).sum(axis=1)
    return near, off


@dataclass
class Codec:
    """Centres of cells, and code vectors of each part of a residual."""

    centres: np.ndarray
    codes: np.ndarray  # part, code, entry

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell, _ = assigned(rows, self.centres)
        left = (rows - self.centres[cell]).reshape(len(rows), len(self.codes), -1)
        parts = [assigned(np.ascontiguousarray(left[:, i]), c)[0] for i, c in enumerate(self.codes)]
        return cell, np.stack(parts, axis=1).astype(np.uint8)

    def estimates(self, queries: np.ndarray, cell: int, coded: np.ndarray) -> np.ndarray:
        """Estimated products of queries with coded rows of one cell."""
        tables = np.einsum("qpe,pce->qpc", queries.reshape(len(queries), len(self.codes), -1), self.codes)
        out = np.repeat((queries @ self.centres[cell])[:, None], len(coded), axis=1)
        for p in range(len(self.codes)):
            out += tables[:, p, coded[:, p]]
        return out


def fit_codec(vectors: DataFrame, cells: int, parts: int, sample: int = SAMPLE, seed: int = 42) -> Codec:
    """Fit on at most ``sample`` vectors, those with the smallest hashes of their ids."""
    drawn = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("embedding").toArrow()
    rows = unit_rows(drawn.column("embedding")) if drawn.num_rows else np.empty((0, 0))
    if not rows.size:
        raise ValueError("no vector to fit an index on")
    if rows.shape[1] % parts:
        raise ValueError("parts must divide the width of the vectors")
    centres = clustered(rows, cells, seed)
    left = (rows - centres[assigned(rows, centres)[0]]).reshape(len(rows), parts, -1)
    codes = [clustered(np.ascontiguousarray(left[:, i]), CODES, seed + 1 + i) for i in range(parts)]
    return Codec(centres, np.stack(codes))


@dataclass
class VectorIndex:
    """Where the rows (id, content, cell, code, embedding) are, and the codec they follow."""

    path: str
    codec: Codec
    version: int = 0

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows-{self.version}")


CODED = "id {id}, content string, cell int, code binary, embedding array<float>"


def coded(vectors: DataFrame, codec: Codec) -> DataFrame:
    """Rows of the index for usable vectors (id, content, embedding)."""
    width = codec.centres.shape[1]
    usable = vectors.filter(F.col("id").isNotNull() & vector_problem(F.col("embedding"), width).isNull())
    given = usable.select("id", F.col("content").cast("string").alias("content"), F.col("embedding").cast("array<float>").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, code = codec.encode(unit_rows(batch.column("embedding")))
                columns = [batch.column("id"), batch.column("content"), pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in code])]
                yield pa.RecordBatch.from_arrays([*columns, batch.column("embedding")], ["id", "content", "cell", "code", "embedding"])

    return given.mapInArrow(run, CODED.format(id=given.schema["id"].dataType.simpleString()))


def save_rows(rows: DataFrame, path: str) -> None:
    """In cell order, so that a filter on cells skips row groups."""
    rows.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id").write.mode("overwrite").parquet(path)


def build_index(vectors: DataFrame, path: str | None = None, cells: int = 64, parts: int = 16, sample: int = SAMPLE, codec: Codec | None = None) -> VectorIndex:
    """Index all rows (id, content, embedding); ``content`` tells whether a row has changed. ``codec`` is fitted if not given."""
    spark = vectors.sparkSession
    path = path or scratch_path(spark, "vector-index")
    if codec is None:
        widths = vectors.filter(F.size("embedding") > 0).groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
        if widths is None:
            raise ValueError("no vector to fit an index on")
        usable = vectors.filter(F.col("id").isNotNull() & vector_problem(F.col("embedding"), widths["n"]).isNull())
        codec = fit_codec(usable, cells, parts, sample)
    index = VectorIndex(path, codec)
    save_rows(coded(vectors, codec), f"{path}/rows-0")
    save_codec(spark, codec, path)
    return index


def save_codec(spark: SparkSession, codec: Codec, path: str) -> None:
    """Centres and codes as rows of a table; they are as large as cells and codes times the width."""
    rows = [("centre", 0, i, c.tolist()) for i, c in enumerate(codec.centres)]
    rows += [("code", p, i, c.tolist()) for p, part in enumerate(codec.codes) for i, c in enumerate(part)]
    spark.createDataFrame(rows, "kind string, part int, n int, entries array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/codec")


def load_index(spark: SparkSession, path: str, version: int = 0) -> VectorIndex:
    rows = spark.read.parquet(f"{path}/codec").orderBy("kind", "part", "n").collect()
    centres = np.array([r["entries"] for r in rows if r["kind"] == "centre"])
    parts = 1 + max(r["part"] for r in rows)
    codes = [np.array([r["entries"] for r in rows if r["kind"] == "code" and r["part"] == p]) for p in range(parts)]
    return VectorIndex(path, Codec(centres, np.stack(codes)), version)


def changes(index: VectorIndex, table: DataFrame) -> DataFrame:
    """(id, change): ``new``, ``changed`` or ``gone``, by content id."""
    held = index.rows(table.sparkSession).select("id", F.col("content").alias("_held"), F.lit(1).alias("_in"))
    now = table.filter(F.col("id").isNotNull()).select("id", F.col("content").cast("string").alias("_now"), F.lit(1).alias("_at"))
    kind = F.when(F.col("_in").isNull(), "new").when(F.col("_at").isNull(), "gone").when(~F.col("_held").eqNullSafe(F.col("_now")), "changed")
    return held.join(now, "id", "full_outer").select("id", kind.alias("change")).filter(F.col("change").isNotNull())


def sync_index(index: VectorIndex, table: DataFrame, embed: Callable[[DataFrame], DataFrame] | None = None) -> tuple[VectorIndex, DataFrame]:
    """Bring the index to the state of ``table`` (id, content, and an embedding or what ``embed`` makes one of).

    Only new and changed rows are embedded and coded. The rows go to a new
    version; readers of the old one are not disturbed. Returns the index and
    its stored changes.
    """
    spark = table.sparkSession
    found = written(changes(index, table), "index-changes")
    fresh = table.join(found.filter("change <> 'gone'").select("id"), "id")
    fresh = coded(embed(fresh) if embed else fresh, index.codec)
    kept = index.rows(spark).join(found.select("id"), "id", "left_anti")
    after = replace(index, version=index.version + 1)
    save_rows(kept.select(*fresh.columns).unionByName(fresh), f"{index.path}/rows-{after.version}")
    return after, found


def probed(queries: DataFrame, codec: Codec, probes: int) -> DataFrame:
    """(query_id, embedding, cell): each usable query with its nearest cells."""
    usable = queries.filter(F.col("query_id").isNotNull() & vector_problem(F.col("embedding"), codec.centres.shape[1]).isNull())
    given = usable.select("query_id", F.col("embedding").cast("array<float>").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = cell_order(unit_rows(batch.column("embedding")), codec.centres)[:, :probes].astype(np.int32)
                taken = batch.take(pa.array(np.repeat(np.arange(len(near)), near.shape[1])))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(near.ravel())], ["query_id", "embedding", "cell"])

    return given.mapInArrow(run, given.select("*", F.lit(0).alias("cell")).schema)


def search_index(index: VectorIndex, queries: DataFrame, k: int = 3, probes: int = 16, shortlist: int = 20, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Approximate top-k by cosine: query_id, id, score, rank.

    Codes of the nearest ``probes`` cells give estimates; the best
    ``shortlist`` times k of each query are scored exactly.
    """
    spark, codec = queries.sparkSession, index.codec
    asked = written(probed(queries, codec, probes), "probes")
    # At most as many as there are cells.
    cells = [r["cell"] for r in asked.select("cell").distinct().collect()]
    rows = index.rows(spark).filter(F.col("cell").isin(cells)) if cells else index.rows(spark).limit(0)

    def compare(some_queries: pa.Table, some_rows: pa.Table, n: int) -> pd.DataFrame:
        cell, unit = some_queries.column("cell")[0].as_py(), unit_rows(some_queries.column("embedding"))
        ids, query_ids = as_numpy(some_rows.column("id")), as_numpy(some_queries.column("query_id"))
        all_codes = np.frombuffer(b"".join(some_rows.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
        # Of equal estimates the smaller ids come first, as in the exact order.
        by_id = np.argsort(ids, kind="stable")
        ids, all_codes, found = ids[by_id], all_codes[by_id], []
        # A few queries at a time bound the estimates held.
        step = max(1, 4_000_000 // max(1, len(ids)))
        for i in range(0, len(unit), step):
            scores = codec.estimates(unit[i : i + step], cell, all_codes)
            top = np.argsort(-scores, axis=1, kind="stable")[:, :n]
            which = np.repeat(np.arange(len(top)), top.shape[1])
            found.append(pd.DataFrame({"query_id": query_ids[i : i + step][which], "id": ids[top.ravel()], "score": scores[which, top.ravel()]}))
        return best(pd.concat(found), n)

    estimated = _block_topk(asked, rows.select("id", "cell", "code"), ["cell"], k * shortlist, block_rows, compare)
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    short = estimated.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= k * shortlist).select("query_id", "id")
    # The shortlist is the small side; vectors are read from the probed cells only.
    met = written(short, "shortlist").join(rows.select("id", F.col("embedding").alias("_v")), "id")
    met = met.join(asked.dropDuplicates(["query_id"]).select("query_id", F.col("embedding").alias("_q")), "query_id")

    def product(a: str, b: str) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)

    norm = F.sqrt(product("_q", "_q") * product("_v", "_v"))
    return _ranked(met.select("query_id", "id", F.coalesce(F.try_divide(product("_q", "_v"), norm), F.lit(0.0)).alias("score")), k)


def choose_probes(index: VectorIndex, spark: SparkSession, k: int = 10, target: float = 0.95, sample: int = 64) -> int:
    """The fewest cells that hold ``target`` of the exact ``k`` nearest rows of a sample of the index's own rows.

    The sample is the ``sample`` rows with the smallest hashes of their ids;
    their exact neighbours come from one pass over the vectors.
    """
    rows = index.rows(spark)
    asked = written(rows.orderBy(F.xxhash64("id"), "id").limit(sample).select(F.col("id").alias("query_id"), "embedding"), "probe-sample")
    hits = similar(asked, rows, k, "id").join(rows.select("id", "cell"), "id").select("query_id", "cell").collect()
    if not hits:
        return len(index.codec.centres)
    drawn = asked.toArrow()
    place = {q: i for i, q in enumerate(as_numpy(drawn.column("query_id")).tolist())}
    rank = cell_order(unit_rows(drawn.column("embedding")), index.codec.centres).argsort(axis=1)
    needed = np.sort([rank[place[h["query_id"]], h["cell"]] + 1 for h in hits])
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])


def cell_order(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Cells of each row, the nearest first."""
    return ((centres**2).sum(axis=1) - 2 * unit @ centres.T).argsort(axis=1, kind="stable")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(query_id, k, recall): the share of the exact hits of each query (query_id, id) that were found."""
    held = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("_hit")), ["query_id", "id"], "left")
    return held.groupBy("query_id").agg(F.count("*").cast("int").alias("k"), (F.count("_hit") / F.count("*")).alias("recall"))


def scanned_share(index: VectorIndex, queries: DataFrame, probes: int = 16) -> DataFrame:
    """(query_id, scanned): the share of indexed rows whose codes a query reads."""
    spark = queries.sparkSession
    sizes = index.rows(spark).groupBy("cell").agg(F.count("*").alias("n"))
    total = index.rows(spark).agg(F.count("*")).scalar()
    return probed(queries, index.codec, probes).join(sizes, "cell").groupBy("query_id").agg((F.sum("n") / total).alias("scanned"))
