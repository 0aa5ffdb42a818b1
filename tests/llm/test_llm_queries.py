import pytest
from compare import compare
from test_ops import similar_groups

import corpus_pipeline
from quillspan.llm import decontamination, pii, quality
from quillspan.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    compare(spark, QUERIES[name], ORACLES[name], SMALL)


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    benchmark = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    columns = docs.columns
    kept = corpus_pipeline.quality(spark, docs, SMALL)
    rows = {r.doc_id: r for r in quality.op4_quality(spark, SMALL).collect()}
    assert {r.doc_id for r in kept.collect()} == {k for k, r in rows.items() if r.kept} and kept.columns == columns
    once = corpus_pipeline.near_dedup(spark, kept, SMALL)
    groups = similar_groups({r.doc_id: r.text for r in kept.collect()})
    assert sorted(r.doc_id for r in once.collect()) == sorted(set(groups.values())) and once.columns == columns
    clean = corpus_pipeline.decontamination(spark, once, SMALL)
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in (once, clean))
    hits = {k: v for k, v in decontamination.brute_force(after, benchmark).items() if v[-1]}
    dirty = {k for k, v in decontamination.brute_force(before, benchmark).items() if v[-1]}
    assert not hits and dirty and all(after[k] == before[k] for k in before if k not in dirty) and clean.columns == columns
    private = corpus_pipeline.pii(spark, clean, SMALL)
    assert private.columns == columns and {r.doc_id: r.text for r in private.collect()} == {r.doc_id: r.text for r in pii.pseudonymise(clean).collect()}
    packed = corpus_pipeline.packing(spark, private, SMALL)
    assert {r.doc_id for r in packed.collect()} == set(after)


def test_run_and_registry(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "packing"]
    assert corpus_pipeline.run(spark, SMALL).count() > 0
