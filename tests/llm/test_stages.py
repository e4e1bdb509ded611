"""Filtering stages of the pipeline on nulls, repeated rows, several texts under one id, and extra columns."""

import random
from collections import Counter

import corpus_pipeline as pipeline
from test_operators import SCHEMA, odd_texts, sentence


def table(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, 0.5, 7, "t", 1) for i, t in pairs], SCHEMA)


def listed(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_clean_rows_stay(spark, smoke_dir):
    """Neither toxic nor from the benchmark: every row stays, as often as it was given."""
    docs = table(spark, odd_texts())
    for stage in (pipeline.drop_toxic, pipeline.drop_leaks):
        kept = stage(spark, docs, smoke_dir)
        assert kept.columns == docs.columns and listed(kept) == listed(docs)


def test_leaks_go_by_text(spark, smoke_dir):
    rng = random.Random(21)
    item = pipeline.table(spark, "benchmark", smoke_dir).orderBy("item_id").first().text
    leak, clean = f"{sentence(rng, 30)} {item} {sentence(rng, 30)}", sentence(rng, 60)
    given = [(1, leak), (1, clean), (1, clean), (2, leak), (2, leak), (None, leak), (None, clean), (3, item), (4, None), (5, "")]
    kept = listed(pipeline.drop_leaks(spark, table(spark, given), smoke_dir))
    assert kept == Counter({(1, clean): 2, (None, clean): 1, (4, None): 1, (5, ""): 1})


def test_ids_of_every_row(spark, smoke_dir):
    given = [*odd_texts(), (7, "Two words"), (7, "Two words")]
    found = pipeline.write_ids(spark, table(spark, given), smoke_dir).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in given)
    assert {r.n_tokens for r in found if r.doc_id in (0, 1)} == {1}
