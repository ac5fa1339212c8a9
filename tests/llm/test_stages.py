"""Every stage of the pipeline on awkward tables."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

import corpus_pipeline
from punctuality.llm import minhash

LAYOUT = "doc_id long, text string, lang string, source string, n_chars int, piece int, length string, row_key long, node string, key int, kept boolean"


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n)) + "."


def rows():
    near = prose(1).split()
    near[60] = "other"
    texts = [
        (1, prose(1)), (2, " ".join(near)), (2, prose(2)), (3, None), (4, ""), (5, " \n\t "), (6, "one two"), (None, prose(3)),
        (None, prose(3)), (None, prose(1)), (7, prose(4)), (7, prose(4)), (8, "mail a.b@c.example " + prose(5)), (None, None), (9, "word " * 30_000),
    ]
    return [(n, text, "en", f"s{i}", i, i % 3, "x", None, "n", 5, True) for i, (n, text) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), LAYOUT).repartition(3)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stage_on_awkward_rows(spark, docs, name, stage):
    after = stage(spark, docs, "")
    none = stage(spark, docs.limit(0), "")
    assert none.collect() == [] and none.columns == after.columns
    if name == "best_fit_packing":
        assert {r.doc_id for r in after.collect()} == {r.doc_id for r in docs.collect()}
        assert after.groupBy("doc_id", "start").count().filter("doc_id = 7").first()["count"] == 2
        return
    assert after.columns == docs.columns
    held = {(r.doc_id, r.source): r for r in after.collect()}
    assert set(held) <= {(r.doc_id, r.source) for r in docs.collect()}
    untouched = [(r.doc_id, r.source, *r[4:]) for r in docs.collect()]
    assert all((r.doc_id, r.source, *r[4:]) in untouched for r in held.values())
    if name in ("substring_duplicates", "personal_data"):
        assert len(held) == docs.count()
        assert held[(3, "s3")].text is None and held[(6, "s6")].text == "one two"
    if name == "personal_data":
        assert "<EMAIL>" in held[(8, "s12")].text


def test_near_duplicates_lose_no_text(spark, docs):
    kept = {(r.doc_id, r.source) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    # 2's first text and a nameless row are copies of 1; the second rows of 7 and of the nameless text are the first again.
    gone = {(2, "s1"), (None, "s9"), (None, "s8"), (7, "s11")}
    assert kept == {(r.doc_id, r.source) for r in docs.collect()} - gone


def test_texts_under_one_id_are_told_apart(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (1, "completely other words are here now")], "doc_id long, text string")
    assert rows_of(corpus_pipeline.near_duplicates(spark, docs, "")) == rows_of(docs)
    named = docs.withColumn("doc_id", F.concat(F.lit("x"), "doc_id")).union(docs.withColumn("doc_id", F.lit("a")))
    assert rows_of(corpus_pipeline.near_duplicates(spark, named, "").select("doc_id")) == [("a",), ("a",)]


def test_unique_ids_give_the_operators_own_groups(spark):
    texts = [prose(n % 40, 50 + n % 40) for n in range(200)]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    kept = rows_of(minhash.near_duplicates(docs).filter("kept").select("doc_id"))
    assert rows_of(corpus_pipeline.near_duplicates(spark, docs, "").select("doc_id")) == kept and len(kept) == 40
