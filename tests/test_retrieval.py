import numpy as np
import pytest
from helpers import by, plan, rows
from pyspark.sql import functions as F

from ledgerlens.functions import nearest as nearest_module
from ledgerlens.functions import prompts
from ledgerlens.operators import retrieval
from ledgerlens.operators.evaluation import eval_results, judge_prompts, judge_summary, parse_judgement
from ledgerlens.plans import answers

Q = "query_id int, embedding array<float>"


def random_vectors(n, dim, seed):
    m = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def data(spark):
    v, q = random_vectors(700, 16, 1), random_vectors(25, 16, 2)
    vectors = spark.createDataFrame([(f"v{i:04d}", x.tolist()) for i, x in enumerate(v)], "vec_id string, embedding array<float>")
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], Q)
    scores = q.astype(float) @ v.astype(float).T
    want = {i: [f"v{j:04d}" for j in np.argsort(-scores[i], kind="stable")] for i in range(25)}
    return vectors.repartition(6), queries, want


def ranked(df, id_col="vec_id"):
    out = {}
    for r in sorted(rows(df), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r[id_col])
    return out


@pytest.mark.parametrize("k", [1, 3, 10])
@pytest.mark.parametrize("limit", [retrieval.SLICE_ROWS, 2])
def test_exact_topk_equals_brute_force(data, k, limit):
    vectors, queries, want = data
    got = ranked(retrieval.similar(queries, vectors, k, slice_rows=limit))
    assert got == {q: ids[:k] for q, ids in want.items()}


def test_ties_go_to_the_smaller_id(spark):
    vectors = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(50)], "vec_id bigint, embedding array<float>").repartition(5)
    queries = spark.createDataFrame([(1, [2.0, 0.0])], Q)
    for limit in (retrieval.SLICE_ROWS, 1):
        assert ranked(retrieval.similar(queries, vectors, 3, slice_rows=limit)) == {1: [0, 1, 2]}


def test_fewer_vectors_than_k_and_no_queries(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [])], "vec_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(1, [0.5, 0.5])], Q)
    assert ranked(retrieval.similar(queries, vectors, 3)) == {1: [1]}
    assert retrieval.similar(queries.filter("false"), vectors, 3).count() == 0
    assert retrieval.similar_lsh(queries.filter("false"), vectors, 3).count() == 0


@pytest.mark.parametrize("cells", [10, 4_000_000])
def test_one_task_gives_k_rows_per_query_whatever_the_ties(monkeypatch, cells):
    monkeypatch.setattr(nearest_module, "MAX_CELLS", cells)
    rng = np.random.default_rng(7)
    for _ in range(30):
        n, q, k = rng.integers(1, 40), rng.integers(1, 5), rng.integers(1, 6)
        rows_, queries = rng.integers(0, 2, (n, 3)).astype(float), rng.integers(0, 2, (q, 3)).astype(float)
        ids = rng.permutation(n)
        got = nearest_module.nearest(np.arange(q), queries, ids, rows_, k)
        scores = rows_ @ queries.T
        for i in range(q):
            want = sorted(range(n), key=lambda j: (-scores[j, i], ids[j]))[:k]
            assert got[got.query_id == i]["id"].tolist() == [ids[j] for j in want]


def test_copies_of_one_id_are_dealt_into_several_blocks(spark):
    """A third of all rows under one id: they count as rows, and the other ids are still found."""
    hot = [(0, [1.0, 0.0])] * 300
    others = [(i, [1.0, i / 1000]) for i in range(1, 600)]
    vectors = spark.createDataFrame(hot + others, "vec_id bigint, embedding array<float>").repartition(6)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], Q)
    for limit in (retrieval.SLICE_ROWS, 1):
        got = retrieval.similar(queries, vectors, 302, slice_rows=limit)
        assert ranked(got)[1] == [0] * 300 + [1, 2]


def test_uneven_and_broken_vectors_are_rejected(spark):
    rows_ = [(1, [1.0, 0.0, 0.0, 1.0]), (2, [1.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0, 0.0, 1.0]), (4, [float("nan"), 0.0, 0.0, 1.0])]
    rows_ += [(5, [None, 0.0, 0.0, 1.0]), (6, [float("inf"), 0.0, 0.0, 1.0]), (7, None), (8, [])]
    vectors = spark.createDataFrame(rows_, "vec_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 1.0])], Q)
    assert ranked(retrieval.similar(queries, vectors, 5)) == {1: [1]}
    found = {r["id"]: r["reason"] for r in rows(retrieval.rejected(queries, vectors))}
    assert found == {"2": "width", "3": "width", "4": "not finite", "5": "not finite", "6": "not finite", "7": "missing", "8": "missing"}
    with pytest.raises(ValueError, match="several widths"):
        retrieval.similar(queries.union(spark.createDataFrame([(2, [1.0])], Q)), vectors)


def test_lsh_finds_most_of_the_neighbours(spark):
    """Queries close to a stored vector: their own vector must be found, and most of the top ten."""
    v = random_vectors(1500, 16, 3)
    q = v[:40] + 0.05 * random_vectors(40, 16, 4)
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], Q)
    exact = ranked(retrieval.similar(queries, vectors, 10))
    near = ranked(retrieval.similar_lsh(queries, vectors, 10, block_rows=100))
    assert all(near[i][0] == i for i in range(40))
    recall = sum(len(set(exact[i]) & set(near[i])) for i in range(40)) / 400
    assert recall > 0.6
    scores = {(r["query_id"], r["vec_id"]): r["score"] for r in rows(retrieval.similar_lsh(queries, vectors, 10))}
    for (i, j), s in scores.items():
        assert s == pytest.approx(float(q[i] @ v[j] / np.linalg.norm(q[i])), abs=1e-5)


def test_lsh_splits_a_bucket_that_holds_everything(spark):
    """All vectors in one bucket: dealt into blocks, and the result is the exact one."""
    v = random_vectors(400, 4, 5) * 0.01 + np.array([1, 0, 0, 0], dtype=np.float32)
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0])], Q)
    near = retrieval.similar_lsh(queries, vectors, 5, tables=2, width=1, bucket_length=100.0, block_rows=50)
    assert ranked(near) == ranked(retrieval.similar(queries, vectors, 5))


def test_lexical_search_equals_brute_force(spark):
    texts = ["alpha beta beta gamma", "beta delta", "gamma gamma epsilon", "Alpha, ALPHA! zeta", "eta theta"]
    chunks = spark.createDataFrame(list(enumerate(texts)), "chunk_id int, retrieval_text string")
    model = retrieval.embedder(features=4096).fit(chunks)
    embedded = retrieval.embed_text(chunks, model)
    questions = spark.createDataFrame([(0, "alpha"), (1, "gamma beta"), (2, "theta")], "query_id int, text string")
    hits = ranked(retrieval.similar(retrieval.embed_text(questions, model, "text"), embedded, 2, "chunk_id"), "chunk_id")

    import math
    import re

    words = [re.findall(r"\w+", t.lower()) for t in texts]
    idf = {w: math.log((len(texts) + 1) / (sum(w in d for d in words) + 1)) for d in words for w in d}

    def vector(ws):
        out = {}
        for w in ws:
            out[w] = out.get(w, 0) + idf.get(w, 0)
        norm = math.sqrt(sum(x * x for x in out.values())) or 1.0
        return {w: x / norm for w, x in out.items()}

    for query, text in ((0, "alpha"), (1, "gamma beta"), (2, "theta")):
        q = vector(text.split())
        scores = [sum(q.get(w, 0) * x for w, x in vector(d).items()) for d in words]
        assert hits[query] == sorted(range(5), key=lambda i: (-round(scores[i], 6), i))[:2]


def test_questions_to_prompts(spark):
    texts = ["kyc rules for banks", "loan limits for farmers", "kyc renewal dates", "interest on deposits"]
    chunks = spark.createDataFrame(
        [(f"c{i}", f"doc {i}", t, None, "area", "all", f"Chunk: {t}") for i, t in enumerate(texts)],
        "chunk_id string, document string, chunks_text string, issued_on date, regulation_area string, "
        "applicable_to string, retrieval_text string",
    )
    model = retrieval.embedder().fit(chunks.select("retrieval_text"))
    questions = spark.createDataFrame(
        [(1, "What about KYC?", "tamil"), (2, "loan for farmers", "Hindi"), (3, "", "tamil")],
        "query_id int, question string, target_language string",
    )
    got = by(answers.question_prompts(questions, chunks, model, 2), "query_id")
    assert got[1]["num_chunks_retrieved"] == 2 and got[1]["target_language"] == "tamil"
    assert {"kyc rules for banks", "kyc renewal dates"} <= set(got[1]["context"].replace("Text: ", "").split("\n"))
    assert got[2]["context"].startswith("[Chunk ID: c1]\nDocument: doc 1\nIssued on: None\n")
    assert got[2]["messages"][1]["content"].startswith("Question:\nloan for farmers\n\nRBI Context:\n[Chunk ID: c1]")
    none = by(answers.question_prompts(questions, chunks.filter("false"), model, 2), "query_id")
    assert none[1]["num_chunks_retrieved"] == 0 and none[1]["context"] == ""


HIT = "query_id int, rank int, chunk_id string, document string, chunks_text string, issued_on date, regulation_area string, applicable_to string"


def test_context_is_in_rank_order_and_reads_like_formatted_text(spark):
    import datetime

    day = datetime.date(2024, 1, 2)
    hits = spark.createDataFrame(
        [(1, 10, "c10", "d", "t", None, "r", "a"), (1, 2, "c2", "d", "t", day, None, "a"), (2, 1, "c1", "d", "t", day, "r", "a")],
        HIT,
    )
    got = by(retrieval.context_text(hits), "query_id")
    assert got[1]["context"] == (
        "[Chunk ID: c2]\nDocument: d\nIssued on: 2024-01-02\nRegulation area: None\nApplicable to: a\nText: t\n\n"
        "[Chunk ID: c10]\nDocument: d\nIssued on: None\nRegulation area: r\nApplicable to: a\nText: t"
    )
    assert by(retrieval.context_text(hits, compact=True), "query_id")[2]["context"] == "Document: d\nIssued on: 2024-01-02\nText: t"


def test_prompts(spark):
    df = spark.createDataFrame([("Q?", "C")], "question string, context string")
    for style, system, user in (
        ("hindi", prompts.HINDI_SYSTEM, prompts.HINDI_USER),
        ("simple", prompts.SIMPLE_SYSTEM, prompts.SIMPLE_USER),
        ("compact", prompts.COMPACT_SYSTEM, prompts.COMPACT_USER),
    ):
        chat = rows(retrieval.answer_prompt(df, style))[0]["messages"]
        assert chat == [
            {"role": "system", "content": system},
            {"role": "user", "content": user.replace("{question}", "Q?").replace("{context}", "C")},
        ]
    plain = rows(retrieval.answer_prompt(df, "plain"))[0]["prompt"]
    assert plain.startswith("\nYou are an RBI circular explainer") and plain.endswith("4. Source chunk IDs used\n")
    with pytest.raises(KeyError):
        retrieval.answer_prompt(df, "other")


def test_translation_and_final_answer(spark):
    df = spark.createDataFrame(
        [(1, "h1", "Hindi"), (2, "h2", "TAMIL"), (3, "h3", "klingon")], "query_id int, hindi_answer string, target_language string"
    )
    asked = retrieval.translation_prompts(df)
    got = by(asked, "query_id")
    assert set(got) == {2, 3} and got[3]["language"] == "English"
    assert got[2]["messages"][0]["content"].startswith("You are a professional Hindi to Tamil translator.")
    assert got[2]["messages"][1]["content"] == "Translate the following Hindi text to Tamil:\n\nh2"
    answered = asked.withColumn("translated_answer", F.concat(F.lit("x "), "hindi_answer"))
    final = by(retrieval.final_answers(df, answered), "query_id")
    assert [final[i]["translated_answer"] for i in (1, 2, 3)] == ["h1", "x h2", "x h3"]


def reply(a, c, l, r, overall=0):
    return f'{{"accuracy": {a}, "completeness": {c}, "clarity": {l}, "relevance": {r}, "overall_score": {overall}, "reasoning": "ok"}}'


def test_published_judge_scores(spark):
    replies = [reply(9, 8, 7, 9), "```json\n" + reply(8, 9, 7, 9) + "\n```", "```\n" + reply(8, 6, 7, 9) + "```  "]
    parsed = parse_judgement(spark.createDataFrame([(x,) for x in replies], "evaluation string"))
    assert [r["overall_score"] for r in rows(parsed)] == [8.25, 8.25, 7.5]
    got = judge_summary(parsed).first()
    assert [round(got[f"avg_{c}"], 2) for c in ("accuracy", "completeness", "clarity", "relevance", "overall_score")] == [
        8.33, 7.67, 7.00, 9.00, 8.00,
    ]


@pytest.mark.parametrize("text", [None, "", "fine", reply(11, 1, 1, 1), reply(-1, 1, 1, 1), '{"accuracy": 5}', reply(5, 5, 5, '"x"'), reply(5, 5, 5, 5)[:-30]])
def test_unusable_replies_are_kept_but_not_counted(spark, text):
    parsed = parse_judgement(spark.createDataFrame([(text,)], "evaluation string"))
    got = parsed.first()
    assert got["evaluation"] == text and got["valid"] is False and got["accuracy"] is None and got["overall_score"] is None
    assert judge_summary(parsed).first()["replies"] == 1


def test_eval_results_keep_every_answer_with_its_own_verdict(spark):
    questions = spark.createDataFrame(
        [("a", "q1", "x1", "c", "easy"), ("b", "q2", "x2", "c", "hard")],
        "qa_id string, question string, answer string, category string, estimated_difficulty string",
    )
    answers = spark.createDataFrame(
        [("a", 1, "g1"), ("a", 2, "g2"), ("a", 3, "g0"), ("z", 1, "g")], "qa_id string, answer_id int, generated_answer string"
    )
    verdicts = spark.createDataFrame([("a", 2, "v"), ("a", 3, "a verdict")], "qa_id string, answer_id int, evaluation string")
    got = eval_results(questions, answers, verdicts)
    found = {(r["qa_id"], r["answer_id"], r["generated_answer"], r["evaluation"]) for r in rows(got)}
    assert found == {("a", 1, "g1", None), ("a", 2, "g2", "v"), ("a", 3, "g0", "a verdict"), ("b", None, None, None)}
    assert {r["difficulty"] for r in rows(got)} == {"easy", "hard"}
    chat = by(judge_prompts(got), "qa_id")["b"]["messages"]
    assert "Generated Answer:\nNone\n" in chat[1]["content"] and "Expected Answer:\nx2\n" in chat[1]["content"]


def test_only_winners_are_shuffled(data):
    vectors, queries, _ = data
    text = plan(retrieval.similar(queries, vectors, 3))
    assert "MapInArrow" in text and "WindowGroupLimit" in text and "Cartesian" not in text


def test_equal_rows_have_equal_scores():
    """Wherever they stand in a matrix product, so that equal scores go by id."""
    rng = np.random.default_rng(1)
    for n in range(6, 80):
        row, asked = (v / np.linalg.norm(v) for v in rng.normal(size=(2, 16)))
        found = nearest_module.nearest(np.array([1]), asked[None], np.arange(n), np.repeat(row[None], n, axis=0), 5)
        assert found["score"].nunique() == 1 and found["id"].tolist() == [0, 1, 2, 3, 4]
