"""The registered queries over the small tables, and the pipeline against its stages by hand."""

import collections
import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tidewright.llm import components, queries


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and [n for n, _ in pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "substring dedup", "source mixing", "packing"]


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if not n.startswith(("op4", "op7", "op8"))])
def test_a_row_for_each_document(spark, sf_dir, name):
    ids = sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect())
    assert sorted(r[0] for r in queries.QUERIES[name](spark, sf_dir).select("doc_id").collect()) == ids


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, sf_dir)
    cur = con.execute(queries.ORACLES[name])
    said = [d[0] for d in cur.description]
    assert sorted(said) == sorted(df.columns)
    assert sorted((tuple(r) for r in df.select(*said).collect()), key=str) == sorted(cur.fetchall(), key=str)


def test_stages(spark, sf_dir, tmp_path):
    from tidewright.llm.quality import quality_scores

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for i, (name, stage) in enumerate(pipeline.STAGES):
        before, out = docs, stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept[name] = docs
        if i < 4:
            assert docs.columns == before.columns
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = {r.doc_id for r in quality_scores(source, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept["quality classifier"].collect()} == good
    from tests.llm.test_edges import linked, removed

    data = [(r.doc_id, r.text) for r in kept["quality classifier"].collect()]
    assert {r.doc_id for r in kept["n-gram Jaccard join"].collect()} == {i for i, _, c in linked(data, (80, 100), 5) if i == c}
    data = [(r.doc_id, r.text) for r in kept["n-gram Jaccard join"].collect()]
    text = dict(data)
    want = {i: (text[i] if gone == 0 else k) for i, n, gone, k in removed(data) if gone == 0 or gone < n}
    assert {r.doc_id: r.text for r in kept["substring dedup"].collect()} == want
    n = lambda df: df.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert n(kept["source mixing"]) == pytest.approx(n(kept["substring dedup"]), rel=0.02)
    assert collections.Counter(r.doc_id for r in kept["packing"].where("start = 0").collect()) == collections.Counter(r.doc_id for r in kept["source mixing"].collect())
    whole = lambda df: sorted(tuple(r) for r in df.select("doc_id", "start", "length", "ids_crc32").collect())
    total = lambda df: df.agg(F.sum("length")).first()[0]
    assert total(pipeline.run(spark, sf_dir)) == total(kept["packing"]) and whole(kept["packing"])


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (5, 6), (6, 5), (7, 7), (20, 21), (21, 22), (22, 23), (23, 24), (24, 25), (25, 26)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5, **dict.fromkeys(range(20, 27), 20)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
