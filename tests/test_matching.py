"""Retrieval of many queries against plain Python, and how often it reads the texts."""

import random
import re

import pytest

from inkspan.operators import articles


def held_against_all(queries, records, top):
    out = set()
    for i, question in queries:
        keys = [w for w in re.split(r"\W+", (question or "").lower()) if len(w) > 2]
        scores = [(-sum(w in " ".join(x or "" for x in r[1:4]).lower() for w in keys), r[0]) for r in records]
        out |= {(i, seq, -s, k + 1) for k, (s, seq) in enumerate(sorted(x for x in scores if x[0])[:top])}
    return out


def frames(spark, queries, records, parts=3):
    q = spark.createDataFrame(queries, "query_id int, question string")
    return q, spark.createDataFrame([(*r, f"r{r[0]}") for r in records], "seq int, newspaper string, issue_date string, raw_text string, record_id string").repartition(parts)


def test_many_queries_read_the_texts_once(spark):
    """Ties, repeated and overlapping keywords, several hundred in a question; no join with the texts at any number of queries."""
    rng = random.Random(4)
    words = ["cat", "concat", "scatter", "the", "theatre", "äther", "ünder", "1915", "x_1", "x_12", "ﬁre", "улица", "it"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "-", "", "—", "\n", "'"]) for _ in range(n))
    records = [(k, rng.choice(["The Cat", None]), rng.choice(["1915-01-02", None]), rng.choice([None, "", text(3), text(3), text(30)])) for k in range(1500)]
    rng.shuffle(records)
    queries = [(k, text(rng.randint(0, 4))) for k in range(4100)] + [(-1, None), (-2, "a ?"), (-3, "cat " * 300), (-4, "nowhere"), (-5, "Cat cat THE")]
    q, r = frames(spark, queries, records)
    found = articles.retrieve(q, r)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("LogicalRDD") == 1
    some = [x for x in queries if x[0] < 60]
    assert {tuple(x) for x in found.where("query_id < 60").collect()} == held_against_all(some, records, 5)


@pytest.mark.parametrize("queries, records", [([], [(1, "A", None, "some text")]), ([(1, "some text")], []), ([(1, "some text")], [(1, None, None, None)])])
def test_nothing_is_found(spark, queries, records):
    q, r = frames(spark, queries, records)
    assert articles.retrieve(q, r).count() == 0
    assert [(x.query_id, x.records) for x in articles.excerpts_prompt(articles.retrieve(q, r), q, r).collect()] == [(i, 0) for i, _ in queries]


def test_preview_and_fewer_than_wanted(spark):
    q, r = frames(spark, [(1, "late word")], [(k, None, None, "early " * k + "late") for k in range(3)], 1)
    assert {tuple(x) for x in articles.retrieve(q, r).collect()} == {(1, 0, 1, 1), (1, 1, 1, 2), (1, 2, 1, 3)}
    assert {tuple(x) for x in articles.retrieve(q, r, preview=8).collect()} == {(1, 0, 1, 1)}
    assert {tuple(x) for x in articles.retrieve(q, r, top=1).collect()} == {(1, 0, 1, 1)}


def test_excerpts_are_not_shuffled(spark):
    """The hits go to the records, however large they are held to be."""
    q, r = frames(spark, [(1, "late word"), (2, None)], [(k, None, None, "late") for k in range(7)])
    found = articles.excerpts_prompt(articles.retrieve(q, r), q, r)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = found.select("*")._jdf.queryExecution().executedPlan().toString()
        got = {x.query_id: (x.records, x.prompt.count("ark_id: r")) for x in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [seq" in plan and got == {1: (5, 5), 2: (0, 0)}
