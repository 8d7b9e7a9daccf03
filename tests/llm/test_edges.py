"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import (
    bag_minhash,
    cube_mix,
    decontaminate,
    html_blocks,
    katz,
    license_join,
    passages,
    pii,
    quality_forest,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
LONG = " ".join(f"word{i} of the long text" for i in range(30_000))
ROWS = [
    (1, WORDS, "en", "a", 100),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, LONG, "en", None, len(LONG)),
    (5, WORDS, "en", "b", 100),
    (5, WORDS, "en", "b", 100),
    (None, "you idiot, write to a.b@c.org or 1.2.3.4\n\nÄ\U0001f600 x", None, "a", 30),
    (7, " \n\t ", "de", "a", 4),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("score", "row", "key", "payload", "chunk", "size", "kept", "words", "base", "labels", "toxic", "_key", "_id"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, None), (3, None, 1), (4, 1, 0), (5, 0, 1), (None, 1, 1), (99, 1, 1), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, " ".join(WORDS.split()[2:15])), (2, None), (3, ""), (None, WORDS), (4, "x"), (4, "x"), (10, "no such words")]
    return spark.createDataFrame(rows, "item_id long, text string")


def operators(docs, labels, benchmark):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return {
        "quality": lambda d: quality_forest.judge_quality(d, labels),
        "licenses": lambda d: license_join.scan_licenses(d),
        "benchmark": lambda d: decontaminate.find_benchmark_words(d, benchmark),
        "toxicity": lambda d: toxicity.score_toxicity(d, labels),
        "passages": lambda d: passages.repeated_passages(d, min_words=15),
        "near": lambda d: bag_minhash.near_duplicate_classes(d),
        "katz": lambda d: katz.score_texts(d, held),
        "mix": lambda d: cube_mix.mix_sources(d),
        "pii": lambda d: pii.digest(pii.find_personal_data(d)),
    }


NAMES = ["quality", "licenses", "benchmark", "toxicity", "passages", "near", "katz", "mix", "pii"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each_document(name, docs, labels, benchmark):
    out = operators(docs, labels, benchmark)[name](docs)
    got = [r["doc_id"] for r in out.collect()]
    assert sorted(got, key=str) == sorted([r[0] for r in ROWS], key=str)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(name, docs, labels, benchmark):
    assert operators(docs, labels, benchmark)[name](docs.limit(0)).count() == 0


def test_other_tables_empty(docs, labels, benchmark):
    assert quality_forest.judge_quality(docs, labels.limit(0)).count() == len(ROWS)
    assert {r["score"] for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert not decontaminate.find_benchmark_words(docs, benchmark.limit(0)).where("contaminated").count()


def test_values_on_edges(docs, labels, benchmark):
    found = {r["doc_id"]: r for r in decontaminate.find_benchmark_words(docs, benchmark).collect()}
    assert (found[1]["n_hit"], found[1]["n_items"], found[None]["n_hit"]) == (13, 1, 1)
    assert found[2]["n_words"] == found[3]["n_words"] == 0 and not found[2]["contaminated"]
    judged = {r["doc_id"]: r for r in quality_forest.judge_quality(docs, labels).collect()}
    assert all(judged[i]["base_failed"] and not judged[i]["kept"] for i in (2, 3, 7))
    spans = {r["doc_id"]: r for r in pii.digest(pii.find_personal_data(docs)).collect()}
    assert spans[None]["spans"] == "email:20:29,ip:33:40" and spans[2]["spans"] == ""
    same = {r["doc_id"]: r for r in bag_minhash.near_duplicate_classes(docs).collect()}
    assert same[5]["class_id"] == 1 and same[1]["class_size"] == 3 and same[3]["class_size"] == 1
    again = {r["doc_id"]: r for r in passages.repeated_passages(docs, min_words=15).collect()}
    assert again[5]["spans"] == "0:20" and again[2]["n_copies"] == 1 and again[3]["spans"] == ""
    mixed = {r["doc_id"]: r for r in cube_mix.mix_sources(docs).collect()}
    assert mixed[2]["taken"] == 0 and mixed[7]["taken"] == 0


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<p>" + "long text " * 20_000), (4, "w", "<article><p>a &lt; b</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r for r in html_blocks.extract_main_text(pages).collect()}
    assert got[1]["text"] == got[2]["text"] == "" and got[4]["text"] == "a < b"
    assert got[None]["n_chars"] == 20_000 * 10 - 1
    assert html_blocks.extract_main_text(pages.limit(0)).count() == 0


def test_stages(spark, docs, labels, benchmark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, docs.limit(0)):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            now = corpus_pipeline.stored(stage(spark, now, str(tmp_path)), name)
            if name != "mixing":
                assert now.columns == list(corpus_pipeline.COLUMNS)
        assert now.count() <= rows.count()
