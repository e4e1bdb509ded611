"""Each stage of the corpus pipeline against a plain version, and the whole on the smallest tables."""

import random
from collections import Counter

import corpus_pipeline as pipeline
from test_operators import SCHEMA, brute_components, odd_texts, sentence

from ledgerlens.llm import mixing, token_files, toxicity


def documents(spark):
    rows = [(i, t, "en", f"s{(i or 0) % 3}", 0, 1, 0.5, 7, "t", 1) for i, t in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA)


def listed(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_the_stages(spark, smoke_dir):
    assert [name for name, _ in pipeline.STAGES] == [
        "toxicity", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output",
    ]
    assert pipeline.ORACLE_SQL is None
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, smoke_dir).count() == 0


def test_toxic_documents_go(spark, smoke_dir):
    docs = pipeline.table(spark, "documents", smoke_dir)
    labels = pipeline.table(spark, "labels", smoke_dir)
    gone = {r.doc_id for r in toxicity.op5_toxicity(docs, labels).collect() if r.predicted}
    kept = pipeline.drop_toxic(spark, docs, smoke_dir)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - gone


def test_one_document_of_each_group_stays(spark, smoke_dir):
    docs = documents(spark)
    kept = pipeline.one_of_similar(spark, docs, smoke_dir)
    assert kept.columns == docs.columns
    rows = odd_texts()
    by_id = {}
    for i, n, root in brute_components(rows):
        by_id.setdefault((i, n), root)
    want = {(i, t) for i, t in rows if not n_shingles(t) or by_id[i, n_shingles(t)] == i}
    assert listed(kept) == Counter(want)


def test_unlike_texts_without_an_id_or_under_one_id_stay(spark, smoke_dir):
    rng = random.Random(11)
    texts = [sentence(rng, 40) for _ in range(6)]
    near = texts[0].split() + ["tail"]
    # Two unlike texts without an id, a near copy of one and a repeated row; two unlike texts under id 1, one of them again under id 5.
    pairs = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, " ".join(near)), (1, texts[2]), (1, texts[3]), (5, texts[3]), (None, texts[2])]
    rows = [(i, t, "en", "s", 0, 1, 0.5, 7, "t", 1) for i, t in pairs]
    kept = listed(pipeline.one_of_similar(spark, spark.createDataFrame(rows, SCHEMA), smoke_dir))
    one = {(None, texts[0]), (None, " ".join(near))} & set(kept)
    assert len(one) == 1
    assert kept == Counter([*one, (None, texts[1]), (1, texts[2]), (1, texts[3])])


def n_shingles(text):
    words = (text or "").encode().lower().split()
    return len({tuple(words[p : p + 3]) for p in range(len(words) - 2)}) if len(words) >= 3 else int(bool(words))


def test_leaks_go_and_clean_documents_stay(spark, tmp_path):
    rng = random.Random(3)
    items = [(i, sentence(rng, 30)) for i in range(5)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, sentence(rng, 20) + (" " + items[i % 5][1] if i % 2 else ""), "en", None, 0, 1, 0.5, 7, "t", 1) for i in range(40)]
    kept = pipeline.drop_leaks(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 40, 2))


def test_the_mix_is_taken(spark, smoke_dir):
    docs = documents(spark)
    taken = {}
    for r in mixing.mix(docs).collect():
        taken[r.doc_id, r.tid] = taken.get((r.doc_id, r.tid), 0) + r.copies
    mixed = pipeline.mix_sources(spark, docs, smoke_dir)
    assert mixed.columns == docs.columns
    found = Counter((r["__doc_id"], r["__text_id"]) for r in pipeline.keyed(mixed).collect())
    assert found == Counter({(pipeline.NO_ID if i is None else i, t): n for (i, t), n in taken.items() if n})


def test_the_last_stage_lists_the_files(spark, smoke_dir):
    docs = documents(spark)
    found = pipeline.write_ids(spark, docs, smoke_dir).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, token_files.op3_token_files(docs).collect()))


def test_the_whole(spark, smoke_dir):
    rows = pipeline.run(spark, smoke_dir).collect()
    starts = sorted((r.start, r.n_tokens) for r in rows)
    assert rows and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
