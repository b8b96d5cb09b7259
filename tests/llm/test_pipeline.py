"""The pipeline's stages against brute force on the smallest tables, and the registered queries."""

import brute
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from limelight.llm import decontamination, secrets

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == first.columns
        out.write.parquet(str(tmp_path / name))
        docs = held[name] = spark.read.parquet(str(tmp_path / name))
    texts = {name: {r.doc_id: r.text for r in held[name].select("doc_id", "text").collect()} for name in list(held)[:4]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in texts["quality"] for d in good) >= 0.97 * len(good)
    assert sum(labels.get(d) == 0 for d in texts["quality"]) <= 2
    want = brute.near_duplicates(list(texts["quality"].items()), 5, 80)
    assert set(texts["near_dedup"]) == {d for d, r in want.items() if r[3]}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    dirty = {r.doc_id for r in decontamination.op9(held["near_dedup"], bench).where("contaminated").collect()}
    assert set(texts["decontamination"]) == set(texts["near_dedup"]) - dirty
    assert set(texts["secrets"]) == set(texts["decontamination"])
    assert not any(secrets.base_spans(t or "") for t in texts["secrets"].values())
    assert {r.doc_id for r in held["packing"].collect()} == set(texts["secrets"])


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("op") and n[2].isdigit()))
def test_registered_query_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0
