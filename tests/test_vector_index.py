"""The stored vector index: codes, recall, crowded cells, odd vectors, syncs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import retrieval, vector_index

SCHEMA = "id long, content string, embedding array<float>"


def vector(rng, centre=None, width=16):
    v = [rng.gauss(c, 0.25) for c in (centre or [0.0] * width)]
    return [float(x) for x in v]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(6)]
    # A third of all vectors is one vector.
    made = [(i, vector(rng, centres[i % 6])) for i in range(400)] + [(400 + i, centres[0]) for i in range(200)]
    return [(i, str(v), v) for i, v in made]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def index(table):
    return vector_index.build_index(table, cells=12, parts=4)


def test_estimates_are_products_with_decoded_rows():
    rng = np.random.default_rng(2)
    codec = vector_index.Codec(rng.normal(size=(3, 8)), rng.normal(size=(4, 5, 2)))
    rows = rng.normal(size=(40, 8))
    cell, code = codec.encode(rows)
    near = ((rows[:, None] - codec.centres) ** 2).sum(2).argmin(1)
    assert (cell == near).all()
    decoded = codec.centres[1] + np.concatenate([codec.codes[p][code[:, p]] for p in range(4)], axis=1)
    assert np.allclose(codec.estimates(rows[:6], 1, code), rows[:6] @ decoded.T)


def test_recall_and_blocks(spark, table, index):
    asked = table.filter("id % 20 = 0").select(F.col("id").alias("query_id"), "embedding")
    exact = retrieval.similar(asked, table, 5, "id")
    probes = vector_index.choose_probes(index, spark, 5)
    found = vector_index.search_index(index, asked, 5, probes)
    got = vector_index.recall(found, exact).collect()
    assert len(got) == 30 and np.mean([r.recall for r in got]) >= 0.9
    # All cells, and a shortlist of all rows: nothing is estimated away, and equal scores go by id.
    whole = vector_index.search_index(index, asked, 5, 12, 200, block_rows=50)
    assert whole.select("query_id", "id", "rank").exceptAll(exact.select("query_id", "id", "rank")).count() == 0
    shares = [r.scanned for r in vector_index.scanned_share(index, asked, 3).collect()]
    assert len(shares) == 30 and max(shares) < 1


def test_loaded_index_is_the_same(spark, index):
    again = vector_index.load_index(spark, index.path)
    assert np.array_equal(again.codec.centres, index.codec.centres) and np.array_equal(again.codec.codes, index.codec.codes)


def test_odd_vectors_are_left_out(spark, table):
    odd = spark.createDataFrame(
        [(900, "a", None), (901, "b", []), (902, "c", [1.0] * 15), (903, "d", [float("nan")] * 16), (None, "e", [1.0] * 16), (904, None, [0.0] * 16)], SCHEMA
    )
    index = vector_index.build_index(table.unionByName(odd), cells=4, parts=2)
    assert index.rows(spark).count() == 601
    asked = odd.select(F.col("id").alias("query_id"), "embedding")
    assert {r.query_id for r in vector_index.search_index(index, asked, 2, 4).collect()} == {904}
    none = vector_index.search_index(index, asked.limit(0), 2, 4)
    assert none.count() == 0
    with pytest.raises(ValueError):
        vector_index.build_index(odd.limit(0))


def test_syncs_equal_a_rebuild(spark, rows, index):
    """Only new and changed rows are embedded."""
    rng, held, seen = random.Random(3), {i: (c, v) for i, c, v in rows}, spark.sparkContext.accumulator(0)
    index = vector_index.build_index(spark.createDataFrame(rows, SCHEMA), codec=index.codec)
    for step in range(3):
        for i in rng.sample(sorted(held), 30):
            held[i] = (f"changed {step}", vector(rng))
        for i in rng.sample(sorted(held), 20):
            del held[i]
        for i in range(1000 + 50 * step, 1040 + 50 * step):
            held[i] = (f"new {step}", vector(rng))
        contents = spark.createDataFrame([(i, c) for i, (c, _) in held.items()], "id long, content string")
        vectors = spark.createDataFrame([(i, v) for i, (_, v) in held.items()], "id long, embedding array<float>")

        def embed(df):
            seen.add(df.count())
            return df.join(vectors, "id")

        index, changes = vector_index.sync_index(index, contents, embed)
        count = {r.change: r["count"] for r in changes.groupBy("change").count().collect()}
        assert count["new"] == 40 and count["gone"] == 20 and 0 < count["changed"] <= 30
    assert seen.value <= 3 * 70
    now = spark.createDataFrame([(i, c, v) for i, (c, v) in held.items()], SCHEMA)
    anew = vector_index.build_index(now, codec=index.codec).rows(spark)
    assert index.rows(spark).exceptAll(anew).count() == anew.exceptAll(index.rows(spark)).count() == 0
    assert vector_index.changes(index, now).count() == 0
