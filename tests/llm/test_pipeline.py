from __future__ import annotations

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from sluiceworks.llm import queries
from tests.llm.conftest import SF, TEXTS, frame, words
from tests.llm.test_dedup import expected_components, expected_rest
from tests.llm.test_quality_and_text import spans_of
from tests.llm.test_tokens import check_pieces, ids_of, BYTES
from sluiceworks.llm.pii import KINDS, mask


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_that_sql_can_say(spark, duck, name):
    found = queries.QUERIES[name](spark, SF)
    want = duck.execute(queries.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(found.columns) == sorted(names)
    rows = [tuple(r[c] for c in names) for r in found.collect()]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr)


def test_all_queries_are_registered():
    names = set(contract.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.ORACLE) <= set(contract.oracle_sql())


def test_stages_one_by_one(spark):
    """Each stage of the whole table against its definition on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = corpus_pipeline.stored(spark, stage(spark, docs, SF), "stage")
        if name == "packing":
            rows = {d: [*ids, 0] for d, ids in zip(before, ids_of(BYTES, list(before.values())), strict=True)}
            check_pieces(after.collect(), rows)
            break
        assert after.columns == columns
        text = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "quality classifier":
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            good = [d for d in before if labels.get(d) == 1]
            assert sum(d in text for d in good) >= 0.97 * len(good) and len(text) < len(before)
        elif name == "MinHash near-dedup":
            kept = {d for d, _, c in expected_components(before.items(), percent=80) if d == c}
            assert text == {d: t for d, t in before.items() if d in kept}
        elif name == "substring dedup":
            want = {d: w for d, _, _, w in expected_rest(before.items())}
            assert {d: t.split() for d, t in text.items()} == {d: " ".join(w).split() for d, w in want.items()}
        else:
            for d, t in before.items():
                spans = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans_of(t))
                assert text[d] == mask(t, spans)
        docs = after


def test_stages_on_odd_rows(spark, tmp_path, monkeypatch):
    """Nulls, empty and long texts, repeated rows and clashing columns pass through every stage."""
    monkeypatch.setattr("sluiceworks.llm.byte_cnn.STEPS", 5)
    spark.createDataFrame([(1, 1), (5, 0), (7, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [*TEXTS, *[(50 + i, words(30, 70) + f" mail{i}@x.org") for i in range(4)]]
    for given in (rows, []):
        docs = frame(spark, given)
        for name, stage in corpus_pipeline.STAGES:
            if name == "quality classifier":  # so little is learned that any verdict is possible
                assert set(stage(spark, docs, str(tmp_path)).columns) == set(docs.columns)
                continue
            after = corpus_pipeline.stored(spark, stage(spark, docs, str(tmp_path)), "stage")
            if name != "packing":
                assert after.columns == docs.columns
                ids = {d for d, _ in given if d not in (6, 7, 8, 51, 52, 53)}
                assert ids <= {r["doc_id"] for r in after.collect()}
                assert after.where("doc_id IS NULL").count() == sum(d is None for d, _ in given)
                assert after.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()
                docs = after
            else:
                assert after.where("start = 0").count() == docs.count()


def test_the_pipeline_runs_whole(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert packed.columns[:2] == ["doc_id", "start"]
    assert packed.agg(F.countDistinct("doc_id")).first()[0] > 100


def test_the_pipeline_ends_with_tokens(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    last = dict(corpus_pipeline.STAGES)["packing"](spark, docs, SF)
    assert last.where("octet_length(ids) <> 4 * length OR crc32(ids) <> ids_crc32").isEmpty()
    assert last.where("start = 0").count() == 20 and dict(last.dtypes)["ids"] == "binary"
