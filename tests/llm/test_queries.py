import pytest

import corpus_pipeline
from millrace.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(name, spark, data, duck, same):
    same(queries.queries()[name](spark, data), duck.sql(queries.oracle_sql()[name]))


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))


def test_pipeline(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    seen, at = [docs.count()], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, data).cache()
        assert at.columns == docs.columns
        seen.append(at.count())
    assert seen[0] > seen[1] > seen[2] >= seen[3] == seen[4] > 0
    from tests.llm.test_llm_operators import groups

    left = [(r.doc_id, r.text) for r in corpus_pipeline.quality(spark, docs, data).collect()]
    assert seen[2] == sum(k[3] for k in groups(left, corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT))
    assert corpus_pipeline.run(spark, data).count() == seen[4]
