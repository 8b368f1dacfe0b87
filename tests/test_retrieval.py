import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierline.operators import retrieval

HIT = "id STRING, text STRING, metadata STRUCT<customer_id: STRING, orders: BIGINT, lifetime_revenue: DOUBLE>, distance DOUBLE"


@pytest.fixture
def ltv(spark):
    rows = [
        (f"C-{i}", 100.0 * i + 0.5, i, datetime(2025, 1, 1, 10), datetime(2025, 1, i, 11)) for i in range(1, 9)
    ]
    return spark.createDataFrame(
        rows, "customer_id STRING, lifetime_revenue DOUBLE, orders BIGINT, first_seen TIMESTAMP, last_seen TIMESTAMP"
    )


def test_sentence(ltv):
    row = retrieval.customer_documents(ltv).filter("id = 'C-2'").first()
    assert row["text"] == (
        "Customer C-2 has placed 2 orders totaling 200.50 in revenue. "
        "First seen 2025-01-01 10:00:00; last seen 2025-01-02 11:00:00."
    )
    assert row["metadata"].asDict() == {"customer_id": "C-2", "orders": 2, "lifetime_revenue": 200.5}


def test_answer_names_the_closest_hit(spark):
    hits = spark.createDataFrame(
        [("K-8", "K-8 buys jars", ("K-8", 2, 61.25), 0.7), ("K-3", "K-3 buys tea", ("K-3", 14, 908.75), 0.0625)], HIT
    )
    answer = retrieval.compose_answer("Who buys tea?", hits).first()["answer"]
    assert answer == (
        "Question: Who buys tea?\n\nGrounding context:\n"
        "  - K-3 buys tea  (distance=0.063)\n"
        "  - K-8 buys jars  (distance=0.700)\n\n"
        "Answer (grounded): customer K-3 is the closest match with 14 orders and 908.75 lifetime revenue."
    )


def test_no_hits(spark):
    answer = retrieval.compose_answer("anything", spark.createDataFrame([], HIT)).first()["answer"]
    assert answer == "I couldn't find any matching customers in Gold."


def test_nearest_against_brute_force(spark):
    import random

    rng = random.Random(3)
    vectors = {f"d{i}": [rng.choice([0.0, 0.5, 1.0]) for _ in range(4)] for i in range(60)}
    query = [0.5, 0.5, 1.0, 0.0]
    df = spark.createDataFrame(list(vectors.items()), "id STRING, embedding ARRAY<FLOAT>").repartition(5)
    got = [(r["id"], r["distance"]) for r in retrieval.nearest(df, F.lit(query), 7).collect()]
    expected = sorted((sum((a - b) ** 2 for a, b in zip(v, query)), k) for k, v in vectors.items())[:7]
    assert got == [(k, d) for d, k in expected]


def test_index_and_ask(spark, ltv, table):
    assert retrieval.build_index(ltv, table) == 0
    hits = retrieval.retrieve(spark, table, "customer C 5 with 5 or 6 orders", k=2).collect()
    assert hits[0]["id"] == "C-5" and hits[1]["id"] == "C-6"
    assert hits[0]["distance"] <= hits[1]["distance"]
    assert retrieval.build_index(ltv.filter("orders < 4"), table) == 1  # a rebuild replaces
    assert retrieval.retrieve(spark, table, "seen 2025 01 03", k=20).count() == 1  # only the third of January tells customers apart


def test_a_question_that_nothing_matches_gets_no_customer(spark, ltv, table):
    retrieval.build_index(ltv, table)
    assert retrieval.retrieve(spark, table, "any", k=20).count() == 0
    # Its only known word is in every document.
    assert retrieval.ask(spark, table).first()["answer"] == "I couldn't find any matching customers in Gold."
    assert retrieval.ask(spark, table, "").first()["answer"] == "I couldn't find any matching customers in Gold."


def test_many_questions_at_once(spark, ltv, table):
    retrieval.build_index(ltv, table)
    asked = [(1, "customer C 5 with 5 orders"), (2, "nothing known"), (3, "seen on 2025 01 07"), (4, None), (5, "C 5"), (6, "C 5")]
    questions = spark.createDataFrame(asked, "question_id INT, question STRING")
    hits = retrieval.retrieve_all(spark, table, questions, 2)
    got = {}
    for r in sorted(hits.collect(), key=lambda r: (r["question_id"], r["rank"])):
        got.setdefault(r["question_id"], []).append((r["id"], r["distance"]))
    assert set(got) == {1, 3, 5, 6} and got[5] == got[6] and got[3][0][0] == "C-7"
    for number, question in asked:
        if question is not None:
            alone = [(r["id"], r["distance"]) for r in retrieval.retrieve(spark, table, question, 2).collect()]
            assert alone == got.get(number, [])
    answers = {r["question_id"]: r["answer"] for r in retrieval.ask_all(spark, table, questions, 2).collect()}
    assert len(answers) == 6 and answers[2] == "I couldn't find any matching customers in Gold."
    assert "customer C-5 is the closest match" in answers[1]


def test_embeddings_are_unit_vectors(ltv):
    docs = retrieval.customer_documents(ltv)
    vectors = retrieval.embedded(docs, retrieval.fit_embedder(docs)).select("embedding").collect()
    for (v,) in vectors:
        assert len(v) == retrieval.DIMENSIONS
        assert math.isclose(sum(x * x for x in v), 1.0, rel_tol=1e-5)


def test_words_found_in_every_document_weigh_nothing(spark):
    docs = spark.createDataFrame([("same words",), ("same words",)], "text STRING")
    vectors = retrieval.embedded(docs, retrieval.fit_embedder(docs)).select("embedding").collect()
    assert all(sum(v) == 0.0 for (v,) in vectors)


def test_empty_index(ltv, table):
    with pytest.raises(RuntimeError):
        retrieval.build_index(ltv.limit(0), table)


def test_many_customers_are_told_apart_by_exact_words(spark, table):
    """More customers than hash buckets: every one asked for comes first, at the distance of brute force."""
    import re
    from collections import Counter

    rows = [(f"C-{i:07d}", i + 0.25, i % 50 + 1, datetime(2025, 1, 1, 10), datetime(2025, 1, i % 28 + 1, 11)) for i in range(3000)]
    many = spark.createDataFrame(
        rows, "customer_id STRING, lifetime_revenue DOUBLE, orders BIGINT, first_seen TIMESTAMP, last_seen TIMESTAMP"
    )
    retrieval.build_index(many, table)
    texts = {r["id"]: r["text"] for r in retrieval.customer_documents(many).collect()}
    tokens = {i: Counter(re.findall(r"\w+", t.lower())) for i, t in texts.items()}
    df = Counter(w for c in tokens.values() for w in c)

    def vector(c):
        v = {w: n * math.log((len(texts) + 1) / (df[w] + 1)) for w, n in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / norm for w, x in v.items()}

    for asked in (17, 1234):
        question = f"What did customer C-{asked:07d} buy?"
        q = vector(Counter(re.findall(r"\w+", question.lower())))
        exact = sorted((2 - 2 * sum(x * q.get(w, 0.0) for w, x in vector(c).items()), i) for i, c in tokens.items())[:3]
        exact = [e for e in exact if e[0] < 2 - 1e-12]
        hits = retrieval.retrieve(spark, table, question).collect()
        assert hits[0]["id"] == f"C-{asked:07d}" == exact[0][1]
        assert [h["id"] for h in hits] == [i for _, i in exact]
        assert all(math.isclose(h["distance"], d, abs_tol=1e-9) for h, (d, _) in zip(hits, exact))
