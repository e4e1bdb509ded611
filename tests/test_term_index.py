"""The term index against a plain scorer."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import term_index


def plain(rows, queries, k):
    bags = {i: Counter(t for t in re.split(r"[\W_]+", (x or "").lower()) if t) for i, x in rows if i is not None}
    bags = {i: b for i, b in bags.items() if b}
    df = Counter(t for b in bags.values() for t in b)
    rarity = {t: round(1000 * math.log(1 + len(bags) / n)) for t, n in df.items()}
    out = []
    for q, x in queries:
        asked = Counter(t for t in re.split(r"[\W_]+", (x or "").lower()) if t)
        scored = [(-sum(n * b[t] * rarity[t] for t, n in asked.items() if t in b), i) for i, b in bags.items() if asked.keys() & b.keys()]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])] if q is not None else []
    return sorted(out)


@pytest.mark.parametrize("per_block,first", [(64, 4), (3, 1), (1, 2)])
def test_hits_equal_a_plain_scorer(spark, per_block, first):
    rng = random.Random(per_block)
    text = lambda n: " ".join(rng.choice(["the", "Of", f"w{rng.randrange(60)}", f"é{rng.randrange(9)}", "x-y"]) for _ in range(n))
    rows = [(i, text(rng.randrange(1, 30))) for i in range(200)] + [(300 + i, "the same words") for i in range(60)]
    rows += [(400, None), (401, ""), (402, " .,"), (None, "w1 w2")]
    queries = [(i, text(rng.randrange(1, 8))) for i in range(12)] + [(50, "same"), (51, "unknown"), (52, None), (53, ""), (None, "the")]
    given = spark.createDataFrame(rows, "doc long, body string")
    asked = spark.createDataFrame(queries, "query_id long, body string")
    found = term_index.search_terms(term_index.build_terms(given, "doc", "body", per_block), asked, "body", 5, first)
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in found.hits.collect()) == plain(rows, queries, 5)
    effort = found.effort.collect()
    assert all(r.scored <= r.blocks for r in effort)
    assert per_block == 64 or sum(r.scored for r in effort) < sum(r.blocks for r in effort)


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], "doc long, body string")
    asked = spark.createDataFrame([(1, "a")], "query_id long, body string")
    assert term_index.search_terms(term_index.build_terms(none, "doc", "body"), asked, "body").hits.count() == 0


def test_queries_beyond_one_word_of_bits(spark):
    """Places of 150 queries take three words; open blocks and a large block of equal texts are scored in parts."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(6))) for i in range(150)] + [(1000 + i, "same few words w1") for i in range(90)]
    queries = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(3))) for i in range(149)] + [(900, "same w1")]
    given, asked = spark.createDataFrame(rows, "doc long, body string"), spark.createDataFrame(queries, "query_id long, body string")
    found = term_index.search_terms(term_index.build_terms(given, "doc", "body", 4), asked, "body", 3, 1)
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in found.hits.collect()) == plain(rows, queries, 3)


def test_terms_are_counted_where_their_text_is(spark):
    given = spark.createDataFrame([(1, "a b a"), (1, "a c"), (2, "b")], "doc long, body string")
    found = term_index.counted(given, "doc", "body")
    assert sorted(map(tuple, found.collect())) == [(1, "a", 3), (1, "b", 1), (1, "c", 1), (2, "b", 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(doc#\d+L?, term", plan)


@pytest.mark.parametrize("size", [1, 30, 4_000_000])
def test_piles_count_rows_of_a_key_together(spark, size):
    """Also where a key's rows are in several batches, and for keys that are not numbers."""
    rng = random.Random(size)
    rows = [(f"k{rng.randrange(25)}", rng.choice([None, "", " .", *[" ".join(rng.choice(["É", "b-c", "Ab", "x1"]) for _ in range(5)) for _ in range(9)]])) for _ in range(90)]
    rows += [("many", "b b a")] * 9 + [(None, "a"), ("none", None)]
    given = spark.createDataFrame(rows, "doc string, body string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        piles = term_index.piles(given, "doc", "body", size).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = []
    for p in piles:
        sizes, places, n = (np.frombuffer(p[c], kind) for c, kind in (("sizes", np.int32), ("places", np.int32), ("counts", np.int64)))
        found += zip(np.repeat(p["ids"], sizes).tolist(), [p["words"][i] for i in places], n.tolist())
        assert p["first"] == p["ids"][0] and p["held"] == np.bincount(places, minlength=len(p["words"])).tolist()
    assert sorted(found) == sorted(map(tuple, term_index.counted(given, "doc", "body").collect()))
    assert len({p["first"] for p in piles}) == len(piles) and ("many", "b", 18) in found


def test_maxima_are_those_of_the_postings(spark):
    """They are read from the postings, so that no posting is shuffled for them."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(20)}" for _ in range(8))) for i in range(120)]
    index = term_index.build_terms(spark.createDataFrame(rows, "doc long, body string"), "doc", "body", 8)
    largest = {(r.term, r.block): r.m for r in index.postings.groupBy("term", "block").agg(F.max("weight").alias("m")).collect()}
    held = index.maxima.groupBy("term", "block").agg(F.max("most").alias("m")).collect()
    assert {(r.term, r.block): r.m for r in held} == largest
    assert "Exchange" not in index.maxima._jdf.queryExecution().executedPlan().toString()
