"""Registered queries of the package against their SQL, and the pipeline against plain Python where it can be."""

import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_llm_operators import brute_components
from tests.oracle import compare, connect
from wxrisk.llm import common, mixing, queries, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name, entry.queries(), entry.oracle_sql()) == []


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}


def test_pipeline_keeps_rows_of_documents_and_obeys_each_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        kept = step(spark, kept, FOLDER)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        after = {r.doc_id for r in kept.select("doc_id").collect()}
        assert after <= before and after, name
        if name != "mixing":
            assert kept.columns == columns
            assert kept.count() == len(after)
    copies = {r.doc_id: r["count"] for r in kept.groupBy("doc_id").count().collect()}
    assert max(copies.values()) <= 2


def asked(docs, name, wanted):
    """The rows of an operator's SQL over ``docs`` in place of the documents."""
    db = connect(FOLDER)
    db.execute("drop view documents")
    db.register("documents", docs.toArrow())
    return db.execute(f"select {wanted} from ({queries.ORACLES[name]})").fetchall()


def harmless(spark, docs):
    """doc_ids below the threshold, by cosines to all examples."""
    model = toxicity.fitted(docs, common.table(spark, FOLDER, "labels"))
    index, kept = model.index, set()
    dense = np.zeros((len(index.ids), len(index.values)))
    for k, (a, b) in enumerate(zip(index.begins[:-1], index.begins[1:], strict=True)):
        dense[k, index.columns[a:b]] = index.weights[a:b]
    for r in docs.collect():
        at, weights = index.vector(r.text)
        cosines = dense[:, at] @ weights
        near = np.lexsort((np.arange(len(cosines)), -np.round(cosines, 12)))[:toxicity.NEIGHBOURS]
        near = near[cosines[near] > 0]
        score = model.none_rate
        if len(near):
            raw = toxicity.vote(cosines[near], index.labels[near], model.base)
            score = model.rates[min(int(np.searchsorted(model.ends, raw - 1e-12)), len(model.rates) - 1)]
        if score < toxicity.THRESHOLD:
            kept.add(r.doc_id)
    return kept


def test_run_keeps_what_each_stage_keeps_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        made = step(spark, docs, FOLDER)
        made = spark.createDataFrame(made.collect(), made.schema)
        before, after = ([r.doc_id for r in d.select("doc_id").collect()] for d in (docs, made))
        if name == "quality_rules":
            want = {i for i, kept in asked(docs, "op7_line_rules", "doc_id, kept") if kept}
        elif name == "toxicity":
            want = harmless(spark, docs)
        elif name == "ngram_jaccard_join":
            want = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in docs.collect()], 5, 80)}
        elif name == "benchmark_decontamination":
            want = set(before) - {i for i, in asked(docs, "op8_decontamination", "doc_id")}
        else:
            copies = {i: taken // size for i, size, taken in asked(docs, "op10_mixing", "doc_id, size, taken") if taken}
            want = set(copies)
            assert Counter(after) == copies
        assert set(after) == want, name
        docs = made
    ran = corpus_pipeline.run(spark, FOLDER).select("doc_id", "text", "copy").collect()
    assert sorted(ran) == sorted(docs.select("doc_id", "text", "copy").collect())


def test_listed_urls_outside_the_rules_are_blocked(spark):
    found = queries.op6_url_filter(spark, "/root/testdata/sf0.01").where("host like '%-%'").collect()
    families = {re.search(r"[a-z]+-[a-z]+", r.host)[0] for r in found if r.is_listed}
    assert families == {"spam-farm", "cheap-pills", "adult-x", "ads-track", "casino-win", "free-bets"}
    outside = [r for r in found if r.rule is None]
    assert {"adult-x", "ads-track", "casino-win"} <= {re.search(r"[a-z]+-[a-z]+", r.host)[0] for r in outside}
    assert all(r.verdict == "block" for r in outside)


def test_sources_come_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixing.mixed(docs).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    for r in rows:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 0.1 * r["max(target)"]
