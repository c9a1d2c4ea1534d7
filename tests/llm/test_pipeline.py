"""The corpus pipeline and its registration."""

import __spark_entry__ as entry
import corpus_pipeline
from tierone.llm import decontam, exact_dedup, simhash
from tierone.llm.common import documents


def test_stages_take_effect(spark, sf):
    docs = documents(spark, sf)
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == columns, name
        path_ids = {r.doc_id for r in after.collect()}
        assert path_ids <= ids and path_ids, name
        docs, ids = after.checkpoint(), path_ids
    assert exact_dedup.exact_groups(docs).filter("NOT kept").count() == 0
    assert simhash.near_groups(docs).filter("doc_id != component_id").count() == 0
    assert decontam.contamination(docs, decontam.benchmark_of(spark, sf)).filter("contaminated").count() == 0


def test_run_returns_the_mix(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "exact_dedup", "simhash", "decontamination", "mixing"]


def test_all_ten_are_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
