"""The pipeline on the smallest given tables, stage by stage, against plain Python."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from ticketloom.llm import decontaminate, ngram_jaccard, poisson_mix, toxicity
from ticketloom.llm.common import read


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    out = [docs.collect()]
    kept = docs
    for _, step in corpus_pipeline.STAGES:
        done = step(spark, kept, sf_dir)
        out.append(done.collect())
        kept = spark.createDataFrame(out[-1], done.schema)
    return out


def ids(rows):
    return {r.doc_id for r in rows}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"]
    columns = stages[0][0].__fields__
    for rows in stages[1:-1]:
        assert rows[0].__fields__ == columns
    assert set(stages[-1][0].__fields__) == {*columns, "copy_no"}


def test_each_stage_takes_effect(spark, sf_dir, stages):
    schema = read(spark, sf_dir, "documents").schema
    labels, bench = read(spark, sf_dir, "labels"), read(spark, sf_dir, "benchmark")
    first = spark.createDataFrame(stages[0], schema)
    toxic = {r.doc_id for r in toxicity.predict(first, labels).where("predicted = 1").collect()}
    assert toxic and ids(stages[1]) == ids(stages[0]) - toxic
    seen, kept = set(), set()
    for r in sorted(stages[1], key=lambda r: r.doc_id):
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        if text not in seen:
            kept.add(r.doc_id)
        seen.add(text)
    assert ids(stages[2]) == kept and len(kept) < len(stages[1])
    third = spark.createDataFrame(stages[2], schema)
    heads = {r.component_id for r in ngram_jaccard.join(third).collect()}
    assert ids(stages[3]) == heads and len(heads) < len(stages[2])
    fourth = spark.createDataFrame(stages[3], schema)
    leaks = {r.doc_id for r in decontaminate.report(fourth, bench).where("contaminated").collect()}
    assert leaks and ids(stages[4]) == ids(stages[3]) - leaks
    fifth = spark.createDataFrame(stages[4], schema)
    rate = {r.source: r.rate for r in poisson_mix.rates(fifth).collect()}
    assert abs(sum(rate[r.source] for r in stages[4]) - len(stages[4])) < 1e-6
    assert ids(stages[5]) <= ids(stages[4])


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    rows = sorted((r.doc_id, r.copy_no) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert rows == sorted((r.doc_id, r.copy_no) for r in stages[-1])
