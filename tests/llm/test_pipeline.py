"""The pipeline over a small table, and the registered queries."""

import corpus_pipeline

import __spark_entry__ as entry
from rows import CLASHES, clashing, documents

SMALL = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert {n for n in entry.oracle_sql() if n.startswith("op")} == {"op2_quality_rules", "op11_importance_resampling", "op12_centroid_clustering", "op13_warc"}


def test_stages_keep_columns_and_take_effect(spark):
    docs = clashing(documents(spark))
    schema = docs.schema
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.schema.simpleString() == schema.simpleString(), name
        seen.append({r.doc_id for r in docs.collect()})
    assert {1, 7, 8, 9} <= seen[0] and not {4, 5, 6, 15} & seen[0]
    assert 1 in seen[1] and not {2, 3} & seen[1]
    assert seen[1] == seen[2] == seen[3]
    first = {r.doc_id: r for r in docs.collect()}
    assert first[1].n_chars == len(first[1].text) and first[1].ids == "mine"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == seen[3]
    assert set(CLASHES) <= set(schema.names)


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        if "piece" not in docs.columns:
            docs = docs.cache()
    assert docs.count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert rows and max(used.values()) <= 4096
