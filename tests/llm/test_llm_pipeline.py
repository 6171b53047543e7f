"""The registered queries against their SQL, and each stage of the pipeline against brute force on its own input."""

import hashlib
from collections import Counter

import duckdb
import pytest
from test_llm_operators import SCHEMA, brute_classes

import corpus_pipeline
from tabular_spark.llm import common, quality
from tabular_spark.llm.queries import ORACLES, QUERIES


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    want = connection.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, sf)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())


def test_stages(spark, sf):
    from tabular_spark.llm.common import stored

    docs, columns = spark.read.parquet(f"{sf}/documents.parquet"), None
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.toPandas()
        columns = columns or docs.columns
        scores = {r["doc_id"]: r["score"] for r in quality.scored(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()} if number == 0 else {}
        docs = stored(stage(spark, docs, sf), f"test-{number}")
        after = docs.toPandas()
        if number < 4:
            assert docs.columns == columns and set(after["doc_id"]) <= set(before["doc_id"])
        if number == 0:
            assert set(after["doc_id"]) == {i for i, s in scores.items() if s >= quality.THRESHOLD}
        if number == 1:
            assert set(after["doc_id"]) == set(before.assign(text=before["text"].fillna("")).groupby("text")["doc_id"].max())
        if number == 2:
            assert Counter(after["doc_id"]) == Counter({c for c, _ in brute_classes(before["doc_id"].tolist(), before["text"].tolist()).values()})
        if number == 3:
            times, text = Counter(after["doc_id"]), before["text"].fillna("")
            sizes = {i: len(t.split()) for i, t in zip(before["doc_id"], text)}
            totals = before.assign(size=[sizes[i] for i in before["doc_id"]]).groupby("source", dropna=False)["size"].sum().to_dict()
            assert max(times.values()) <= 3 and abs(sum(times[i] * sizes[i] for i in sizes) / sum(totals.values()) - 1) < 0.25
        if number == 4:
            assert sorted(after["doc_id"]) == sorted(before["doc_id"]) and (after["n_tokens"] > 0).all()
            digest = before.assign(digest=[hashlib.sha256((t or "").encode()).hexdigest() for t in before["text"]])
            assert sorted(zip(after["doc_id"], after["decoded_sha256"])) == sorted(zip(digest["doc_id"], digest["digest"]))
            assert all(len(ids) == n for ids, n in zip(after["ids"], after["n_tokens"]))


def test_stages_on_no_documents(spark, sf):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_tables_written_on_the_way_are_removed(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    got = corpus_pipeline.run(spark, sf)
    left = [x.name.rpartition("-")[0] for x in next(tmp_path.iterdir()).iterdir()]
    assert left == [f"pipeline-{len(corpus_pipeline.STAGES) - 2}"] and got.count() > 0
