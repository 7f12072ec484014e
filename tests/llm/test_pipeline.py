import duckdb
import pytest

import corpus_pipeline
from claimloom.llm.common import table
from claimloom.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL
from tests.llm.helpers import awkward, empty


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SMALL, "documents")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, SMALL)
        assert result.columns == docs.columns
        counts.append(result.count())
        docs = result
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]


def test_run_packs_what_the_stages_keep(spark):
    pieces = corpus_pipeline.run(spark, SMALL).toPandas()
    whole = pieces.groupby("doc_id").agg(n=("length", "sum"), total=("doc_tokens", "first"))
    assert (whole["n"] == whole["total"]).all() and 0 < len(whole) < table(spark, SMALL, "documents").count()


@pytest.mark.parametrize("make", [awkward, empty])
def test_stages_take_awkward_rows(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SMALL)
        result.count()
        docs = result if "text" in result.columns else docs


def test_every_query_runs(spark):
    for name, query in QUERIES.items():
        assert query(spark, SMALL).count() > 0 or name == "op8_decontamination"


def test_search_agrees_with_sql(spark):
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
        wanted = connection.execute(ORACLES["op10_nearest_vectors"]).fetchall()
    found = [tuple(r) for r in QUERIES["op10_nearest_vectors"](spark, SMALL).collect()]
    key = lambda r: r[:2]
    for a, b in zip(sorted(found, key=key), sorted(wanted, key=key), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-12
