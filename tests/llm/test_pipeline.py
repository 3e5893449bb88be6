"""The pipeline's stages, each against what it was given."""

from __future__ import annotations

import corpus_pipeline
from vialflow.llm import decontam, simhash

SF = "/root/testdata/sf0.01"


def test_stages_keep_what_they_should(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(path := f"file://{tmp_path}/{i}")
        made = spark.read.parquet(path)
        if name == "quality":
            y = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            kept = {r.doc_id for r in made.collect()}
            assert sum(i in kept for i, q in y.items() if q == 1) > 0.97 * sum(y.values())
            assert sum(i in kept for i, q in y.items() if q == 0) < 0.3 * sum(q == 0 for q in y.values())
        elif name == "simhash":
            judged = simhash.near_duplicates(docs).collect()
            assert sorted(r.doc_id for r in made.collect()) == sorted({r.component_id for r in judged})
        elif name == "decontamination":
            bad = {r.doc_id for r in decontam.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert bad and {r.doc_id for r in made.collect()} == {r.doc_id for r in docs.collect()} - bad
        elif name == "mixing":
            before = {tuple(r) for r in docs.collect()}
            rows = [tuple(r) for r in made.collect()]
            assert set(rows) <= before and max(map(rows.count, set(rows))) == 2
        else:
            assert made.count() == docs.count() and made.agg({"n_tokens": "min"}).first()[0] >= 1
        assert name == "tokens" or made.columns == names
        docs, seen[name] = made, made.count()
    assert seen["quality"] > seen["simhash"] > seen["decontamination"]
