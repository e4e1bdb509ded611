import datetime
import hashlib

import pytest
from helpers import by, plan, rows

from ledgerlens.operators.documents import bronze, gold_chunks, gold_eval, silver
from ledgerlens.plans.documents import build_layers
from ledgerlens.sources.tables import layer_counts

TRAIN = "document string, filename string, regulation_area string, applicable_to string, issued_on string, key_topics string, chunks_text string, is_table boolean, question string, answer string"
EVAL = "document string, issued_on string, question string, answer string, rephrased_question string, rephrased_answer string, evaluation_criteria string, category string, estimated_difficulty string"


@pytest.fixture(scope="module")
def raw(spark):
    train = spark.createDataFrame(
        [
            (" a ", "f", "\tx ", " y", "2024-01-31", "k", "one\n\t two", False, "q  1", "a\r\n1"),
            ("a", "f", "b", "y", "2023-05-01", "k", "one two", True, "q 2", "a 2"),
            ("a", "f", "a", "y", "12-Jan-2024", "k", "one two", True, "q 3", "a 3"),
            ("a", "g", None, None, "2024-13-01", None, "one two", None, None, None),
            (None, "g", "r", "t", None, None, "lost", None, "q", "a"),
        ],
        TRAIN,
    )
    questions = spark.createDataFrame([("e", "2024-06-01", "q?", "a!", "rq", "ra", "crit", "c", "hard")], EVAL)
    return bronze(train, questions, "t1", "t2")


def test_bronze_keeps_rows_and_fills_missing_columns(raw):
    got = rows(raw)
    assert len(got) == 6 and {g["split"] for g in got} == {"train", "eval"}
    assert {g["source_table"] for g in got} == {"t1", "t2"}
    item = next(g for g in got if g["split"] == "eval")
    assert item["chunks_text"] is None and item["filename"] is None and item["category"] == "c"
    assert all(isinstance(g["ingested_at"], datetime.datetime) for g in got)


def test_silver(raw):
    clean = silver(raw)
    got = {g["question"]: g for g in rows(clean)}
    first = got["q 1"]
    assert first["document"] == "a" and first["chunks_text"] == "one two" and first["answer"] == "a 1"
    # Only spaces are trimmed.
    assert first["regulation_area"] == "\tx" and first["applicable_to"] == "y"
    assert first["issued_on"] == datetime.date(2024, 1, 31)
    assert got["q 3"]["issued_on"] is None and got[None]["issued_on"] is None
    assert first["qa_id"] == hashlib.sha256(b"train||a||f||q 1||a 1").hexdigest()
    assert got[None]["qa_id"] == hashlib.sha256(b"train||a||g||||").hexdigest()
    assert "Exchange" not in plan(clean)


def test_gold_keeps_one_copy_and_the_smallest_metadata(raw):
    got = by(gold_chunks(silver(raw)), "filename")
    assert set(got) == {"f", "g"}
    kept = got["f"]
    # NULL sorts first, so the copy with an unreadable date is the smallest.
    assert kept["issued_on"] is None and kept["regulation_area"] == "a"
    assert kept["chunk_id"] == hashlib.sha256(b"a||f||one two").hexdigest()
    assert kept["retrieval_text"] == "Document: a\nFilename: f\nRegulation area: a\nApplicable to: y\nIssued on: \nChunk: one two"
    assert got["g"]["retrieval_text"].startswith("Document: a\nFilename: g\nRegulation area: \n")


def test_gold_eval(raw):
    got = rows(gold_eval(silver(raw)))
    assert len(got) == 1 and got[0]["estimated_difficulty"] == "hard" and len(got[0]) == 9


def test_layers_are_stored_once(raw, spark):
    train = raw.filter("split = 'train'").drop("split", "source_table", "ingested_at", *EVAL_ONLY)
    questions = raw.filter("split = 'eval'").select(*[c.split()[0] for c in EVAL.split(", ")])
    layers = build_layers(train, questions)
    counts = {r["layer"]: r["n_rows"] for r in layer_counts(bronze=layers.bronze, silver=layers.silver, gold=layers.gold_chunks, eval=layers.gold_eval).collect()}
    assert counts == {"bronze": 6, "silver": 6, "gold": 2, "eval": 1}
    assert "regexp_replace" not in plan(layers.gold_chunks)


EVAL_ONLY = ["rephrased_question", "rephrased_answer", "evaluation_criteria", "category", "estimated_difficulty"]


def test_a_third_of_all_rows_may_be_one_chunk(spark):
    copies = [("hot", "f", "r", "t", "2024-01-01", "k", "same", False, f"q{i}", "a") for i in range(300)]
    others = [(f"d{i}", "f", "r", "t", "2024-01-01", "k", "text", False, "q", "a") for i in range(600)]
    clean = silver(bronze(spark.createDataFrame(copies + others, TRAIN).repartition(8), spark.createDataFrame([], EVAL)))
    chunks = gold_chunks(clean)
    assert chunks.count() == 601
    # Copies are merged before they are sent.
    assert plan(chunks).count("SortAggregate") + plan(chunks).count("HashAggregate") >= 2
