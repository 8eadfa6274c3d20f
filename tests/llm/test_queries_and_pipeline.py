"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from compare import difference, duck

import corpus_pipeline
from dailypanel.llm.queries import LICENSES_SQL, ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, small, con, name):
    assert difference(QUERIES[name](spark, small).toPandas(), con.execute(ORACLES[name]).df()) is None


def test_license_base_against_sql(spark, small, con):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    got = sorted(tuple(r) for r in QUERIES["op4_license_scan"](spark, small).select(columns).collect())
    assert got == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({LICENSES_SQL})").fetchall())


def test_pipeline(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns[: len(columns)] == columns and (k == 4 or docs.columns == columns)
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] > counts[3] and counts[4] == counts[5] > 0
    assert corpus_pipeline.run(spark, small).count() == counts[5]


def test_pipeline_takes_an_empty_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0
