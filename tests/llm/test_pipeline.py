"""The pipeline's stages against plain versions of their rules, and on odd and empty tables."""

from tests.llm.conftest import FOLDER
from tests.llm.test_operators import brute_components

import corpus_pipeline as pipeline
from tidemill.llm import decontamination, secrets
from tidemill.sinks.layers import store


def test_stages_take_effect(spark, docs):
    kept, seen = docs, []
    for name, stage in pipeline.STAGES:
        before, kept = kept, store(stage(spark, kept, FOLDER), name.replace(" ", "-"))
        seen.append((before, kept))
    for before, after in seen[:-1]:
        assert after.columns == docs.columns
    groups = brute_components([(r.doc_id, r.text) for r in seen[1][0].collect()], 5, 80)
    assert {r.doc_id for r in seen[1][1].collect()} == {d for d, (n, c) in groups.items() if d == c}
    items = [decontamination.normalise(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert not [r for r in seen[2][1].collect() if any(i in decontamination.normalise(r.text) for i in items)]
    assert seen[3][1].count() == seen[3][0].count() and secrets.find_secrets(seen[3][1]).filter("size(base) > 0").count() == 0
    packed = {r.doc_id: r.doc_tokens for r in seen[4][1].collect()}
    assert set(packed) == {r.doc_id for r in seen[4][0].collect()}
    run = pipeline.run(spark, FOLDER)
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in run.collect()) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in seen[4][1].collect())


def test_stages_on_odd_and_empty_tables(spark, odd, none):
    for frame in (odd, none):
        for name, stage in pipeline.STAGES:
            out = stage(spark, frame, FOLDER)
            assert out.count() <= frame.count() * 200
            assert name == "packing" or out.columns == frame.columns
