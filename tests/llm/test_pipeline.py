"""The pipeline over a small table, stage by stage against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from test_operators import brute_components, brute_repeats, texts

import corpus_pipeline
from tidemark.llm.common import prepare, stored, table
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    prepare(spark)
    docs = [table(spark, SMALL, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], SMALL), name))
    return docs


def test_columns_stay_but_for_the_last(stages):
    assert all(d.columns == stages[0].columns for d in stages[:-1])


def test_rules_keep_what_the_operator_keeps(spark, stages):
    kept = {r.doc_id for r in QUERIES["op6_rules"](spark, SMALL).where("kept").collect()}
    assert {r.doc_id for r in stages[1].collect()} == kept


def test_one_document_of_each_group(stages):
    want = {row[0] for row in brute_components(texts(stages[1]), 5, 80) if row[3]}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(want)


def test_passages_are_removed(stages):
    want = {row[0]: row[4] for row in brute_repeats(texts(stages[2]), corpus_pipeline.PASSAGE)}
    for r in stages[3].collect():
        if len(r.text.encode()) == 0 or hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id]:
            assert r.n_chars == len(r.text)
        else:  # a character lost a byte and went whole
            assert "�" not in r.text


def test_mix_takes_whole_documents_three_times_at_most(stages):
    times = stages[4].groupBy("doc_id").count()
    assert times.agg(F.max("count")).first()[0] <= 3
    assert stages[4].join(stages[3], stages[3].columns, "left_anti").count() == 0


def test_ids_decode_to_the_texts(stages):
    assert stages[5].count() == stages[4].count()
    assert stages[5].where("not intact or n_tokens != size(ids)").count() == 0


def test_passages_of_more_than_fifty_words_go(spark):
    """Passages that two or more otherwise different documents share, short words and long ones, with other neighbours."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    passages = [" ".join(word(rng.choice((3, 4, 5, 6, 7))) for _ in range(51 + i)) for i in range(12)]
    rows = []
    for i in range(60):
        own = [" ".join(word(rng.randint(2, 9)) for _ in range(80)) for _ in range(2)]
        middle = passages[i % 12] if i < 36 else " ".join(word(5) for _ in range(51))
        rows.append((i, f"{own[0]} {middle} {own[1]}", "en", "a", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r for r in corpus_pipeline.repeated_passages(spark, docs, SMALL).collect()}
    for i, text, *_ in rows:
        if i < 36:
            # at most the first and last letters that chance gives both neighbours differ
            gone = len(text) - len(left[i].text)
            assert passages[i % 12] not in left[i].text and 0 <= gone - len(passages[i % 12]) <= 4
        else:
            assert left[i].text == text and left[i].n_chars == len(text)


def test_pipeline_on_an_empty_table_and_without_a_class_of_labels(spark, folder):
    for name in ("documents", "labels"):
        full = table(spark, SMALL, name)
        full.limit(0).write.parquet(f"{folder}/empty/{name}.parquet")
        kept = full if name == "documents" else full.where("quality = 1")
        kept.write.parquet(f"{folder}/good/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/empty").count() == 0
    assert corpus_pipeline.run(spark, f"{folder}/good").count() > 0
