"""The registered queries over the small tables, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as registered
import corpus_pipeline
from snapline.llm.registry import QUERIES, SQL
from snapline.llm.decontaminate import decontaminate
from snapline.llm.pii import redact
from snapline.llm.simhash import near_duplicates
from snapline.llm.toxicity import toxicity
from tests.conftest import SMALL

TABLES = ("documents", "benchmark", "pages", "labels", "embeddings")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield connection
    connection.close()


def test_all_are_registered():
    names = registered.queries()
    assert set(QUERIES) < set(names) and "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, db, name):
    df, result = QUERIES[name](spark, SMALL), db.execute(SQL[name])
    columns = sorted(c[0] for c in result.description)
    order = [[c[0] for c in result.description].index(c) for c in columns]
    assert columns == sorted(df.columns)
    assert sorted(str([row[i] for i in order]) for row in result.fetchall()) == sorted(str([r[c] for c in columns]) for r in df.collect())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op9_pack"}))
def test_one_row_for_each_input_row(spark, name):
    source = {"op8_url_filter": "pages", "op11_clusters": "embeddings", "op12_warc": "pages"}.get(name, "documents")
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{source}.parquet").count()


def test_pipeline(spark, tmp_path):
    """Each stage against its operator's own answers on the stage's input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "personal_data", "packing"]

    def step(name, docs):
        stages[name](spark, docs, SMALL).write.parquet(str(tmp_path / name))
        made = spark.read.parquet(str(tmp_path / name))
        assert made.columns == docs.columns
        return made, {r.doc_id: r for r in made.collect()}

    toxic = {r.doc_id for r in toxicity(docs, labels).where("predicted = 1").collect()}
    docs, kept = step("toxicity", docs)
    assert len(kept) == 200 - len(toxic) and not toxic & set(kept)
    groups = {r.component_id for r in near_duplicates(docs).collect()}
    docs, kept = step("near_dedup", docs)
    assert set(kept) == groups
    hit = {r.doc_id for r in decontaminate(docs, items).where("contaminated").collect()}
    docs, kept = step("decontamination", docs)
    assert set(kept) == groups - hit
    texts = {r.doc_id: r.text for r in redact(docs).collect()}
    docs, kept = step("personal_data", docs)
    assert {i: r.text for i, r in kept.items()} == texts and all(r.n_chars == len(r.text) for r in kept.values())
    packed = stages["packing"](spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == set(kept)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "doc_tokens").distinct().collect())) == sorted({(r.doc_id, r.doc_tokens) for r in packed})


def test_pipeline_on_messy_and_empty_documents(spark, messy, nothing):
    for docs in (messy, nothing):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SMALL)
            if name != "packing":
                assert made.columns == docs.columns
            made.count()
