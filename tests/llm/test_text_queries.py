"""The pipeline's stages end to end; queries with SQL are compared by the general query test."""

import corpus_pipeline
from quantloom.llm import queries


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(queries.ORACLES) <= set(queries.QUERIES) and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_packs_what_the_stages_keep(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    filled = rows.groupBy("sequence_id").sum("length").collect()
    assert sorted(r.sequence_id for r in filled) == list(range(len(filled)))
    assert all(r["sum(length)"] == 2048 for r in filled if r.sequence_id < len(filled) - 1)
