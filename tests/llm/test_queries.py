"""Registered queries against their SQL, the pipeline against plain stages, and the plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from carelake.llm import decontaminate, near_dedup, oracle, quality_rules, queries, sentencepiece_bpe
from tests.conftest import SF_SMALL
from tests.harness import compare, duck
from tests.llm.test_operators import exact_components, plain_lines

SF = SF_SMALL.replace("0.001", "0.01")


@pytest.mark.parametrize("name", sorted(oracle.build()))
def test_query_matches_sql(spark, name):
    r = compare(E.queries()[name](spark, SF), duck(SF), E.oracle_sql()[name])
    assert r["ok"], r


def test_all_queries_are_registered():
    have = E.queries()
    assert [sum(bool(re.match(rf"op{n}_", k)) for k in have) for n in range(1, 14)] == [1] * 13 and "pipeline" in have


@pytest.mark.parametrize("name", sorted(set(queries.REGISTRY) - set(oracle.build())))
def test_query_covers_its_table(spark, name):
    got = E.queries()[name](spark, SF_SMALL)
    table = "pages" if name.startswith(("op7", "op8")) else "documents"
    n = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
    assert got.count() <= n * 40 if name.startswith("op5") else got.count() == n


@pytest.mark.parametrize("name", ["op3_line_dedup", "op4_pii_boost", "op6_quality_rules"])
def test_native_plans_run_no_python(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_quality_plan_has_no_shuffle(spark):
    plan = E.queries()["op6_quality_rules"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("row", F.lit("clash")).withColumn("kept", F.lit(1))
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "sentencepiece"]
    kept = {r["doc_id"] for r in quality_rules.measure(docs).where("kept").select("doc_id").collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = [(i, text[i]) for i in sorted(kept)]
    for name, fn in corpus_pipeline.STAGES[:-1]:
        docs = fn(spark, docs, SF).checkpoint()
        if name == "line_dedup":
            want = [(i, t) for i, _, _, t in plain_lines(want)]
        elif name == "near_dedup":
            comp = exact_components(want, near_dedup.STAGE)
            want = [(i, t) for i, t in want if comp[i] == i]
        elif name == "decontaminate":
            items = [(r["item_id"], r["text"].encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            m = decontaminate.Matcher(items)
            want = [(i, t) for i, t in want if not m.search(t.encode())]
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars", "row", "kept"}
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == want
        assert docs.where("n_chars <> char_length(text)").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    back = sentencepiece_bpe.decode(last, sentencepiece_bpe.load_vocabulary(spark))
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == want and len(want) > 100
