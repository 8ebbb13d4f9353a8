"""Registered queries of the package and the corpus pipeline."""

import os
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from shelfwatch.llm import decontam, queries, simhash, toxicity
from tests.conftest import TESTDATA
from tests.llm.test_operators import awkward, empty, slow_match_bounded, slow_simhash, slow_targets
from tools.oracle_check import digest

SF = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest([d[0] for d in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", ["op2_kd_shards", "op3_suffixes", "op5_phrases", "op7_licenses", "op10_simhash"])
def test_one_row_per_document(spark, name):
    ids = [r["doc_id"] for r in queries.QUERIES[name](spark, SF).collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = dict(P.STAGES)["toxicity"](spark, docs, SF)
    rows, kept = docs.collect(), out.collect()
    scorer = toxicity.Scorer(*toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in rows if scorer.score(r["text"])[0] < 0.7}
    assert out.columns == docs.columns and len(kept) < len(rows)

    docs, rows = out, kept
    out = dict(P.STAGES)["near_dedup"](spark, docs, SF)
    fps = {r["doc_id"]: slow_simhash(r["text"]) for r in rows}
    group = {i: i for i in fps}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((top(a), top(b)))
                group[y] = x
    assert {r["doc_id"] for r in out.collect()} == {i for i in fps if top(i) == i}

    docs, rows = out, out.collect()
    out = dict(P.STAGES)["decontaminate"](spark, docs, SF)
    bench = [decontam.normal(r["text"]).decode() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in rows if not any(slow_match_bounded(b, decontam.normal(r["text"]).decode()) for b in bench)}
    assert {r["doc_id"] for r in out.collect()} == clean

    docs, rows = out, out.collect()
    out = dict(P.STAGES)["mix"](spark, docs, SF)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(r["text"].split())
    for r in out.collect():
        taken[r["source"]] += len(r["text"].split())
    target = slow_targets(sizes)
    longest = max(len(r["text"].split()) for r in rows)
    assert all(abs(taken[s] - target[s]) <= longest / 2 for s in sizes)

    shards = dict(P.STAGES)["shard"](spark, out, SF)
    assert sorted(map(str, shards.select(*out.columns).collect())) == sorted(map(str, out.collect()))
    assert shards.select("shard", "slot").distinct().count() == out.count()


def test_run_and_awkward_tables(spark):
    assert P.run(spark, SF).count() > 0
    for docs in (awkward(spark, 30), empty(spark)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert [c for c in out.columns if c not in ("shard", "slot")] == [c for c in docs.columns if c not in ("shard", "slot")]
            docs = spark.createDataFrame(out.collect(), out.schema)


def test_keep_one_keeps_a_document_of_every_group(spark):
    docs = awkward(spark, 20)
    kept = simhash.keep_one(docs).collect()
    groups = simhash.near_duplicates(docs).select("component_id").distinct().count()
    assert len({r["doc_id"] for r in kept}) == groups


def test_near_dedup_sends_no_table_of_documents_through_the_driver(spark):
    docs = spark.createDataFrame([(i, f"text {i} of words {i * i} unlike others {-i}") for i in range(20)], "doc_id long, text string")
    plan = P.near_dedup(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
