"""The registered corpus queries and the pipeline over whole small tables."""

import oracle
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_over_its_table(spark, name):
    query = QUERIES[name]
    if query.sql is not None:
        assert oracle.compare(query.run(spark, SF.replace("0.001", "0.01")), oracle.connect(SF.replace("0.001", "0.01")), query.sql) > 0
        return
    rows = query.run(spark, SF).count()
    whole = {"op5_tree_scoring": "pages", "op13_heap_bounds": "embeddings"}.get(name, "documents")
    if name not in ("op6_containment_search", "op10_best_fit_packing", "op12_truncation_peeling"):
        assert rows == spark.read.parquet(f"{SF}/{whole}.parquet").count()
    assert rows > 0


def test_pipeline_stages_by_brute_force(spark):
    """What each stage takes out, held against the operators' own brute-force rules."""
    import brute

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = stage(spark, docs, SF).persist()
        assert docs.columns == columns
        now = {r.doc_id: r.text for r in docs.collect()}
        assert now.items() <= kept.items()
        if number == 0:
            assert not any(brute.base_rules(t)[-1] for t in now.values())
        if number == 2:
            assert set(now) == {i for i, (_, root) in brute.groups(kept, 5, 80).items() if i == root}
        if number == 3:
            parts = [brute.shingles(t, 5, brute.PLAIN_WORD) for t in items]
            dirty = {
                i
                for i, t in kept.items()
                if any(p and 100 * len(p & brute.shingles(t, 5, brute.PLAIN_WORD)) >= 80 * len(p) for p in parts)
            }
            assert set(now) == set(kept) - dirty
        kept = now
    packed = corpus_pipeline.packing(spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(kept)


def test_run_equals_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
