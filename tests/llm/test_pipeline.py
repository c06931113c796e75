import re

import numpy as np
from .conftest import SF

import corpus_pipeline as C
from trailfeat.llm import decontamination as D
from trailfeat.llm import pii
from trailfeat.llm import quality_rules as R
from trailfeat.llm import simhash as M


def test_stages_and_result(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    seen = {}
    for name, stage in C.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()} if name != C.STAGES[-1][0] else None
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before, docs)
        if name != C.STAGES[-1][0]:
            assert docs.columns == names
    before, after = seen["quality_rules"]
    kept = {r["doc_id"] for r in after.collect()}
    assert kept < set(before) and all(R.statistics(before[d])[0] >= 20 for d in kept)
    before, after = seen["simhash_dedup"]
    found = M.near_duplicates(seen["quality_rules"][1]).collect()
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({r["component_id"] for r in found})
    before, after = seen["decontamination"]
    finder = D.Finder([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert {r["doc_id"] for r in after.collect()} == {d for d, t in before.items() if not finder.hits(t)}
    before, after = seen["pii"]
    clean = {r["doc_id"]: r["text"] for r in after.collect()}
    assert clean.keys() == before.keys() and any(clean[d] != before[d] for d in clean)
    assert all(not pii.base_spans(t) for t in clean.values())
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
    packed = docs.collect()
    assert {r["doc_id"] for r in packed} == set(clean)
    rooms = {}
    for r in packed:
        rooms[r["sequence_id"]] = rooms.get(r["sequence_id"], 0) + r["length"]
    assert max(rooms.values()) <= 2048
    ids = np.frombuffer(packed[0]["ids"], "<u2")
    assert len(ids) == packed[0]["length"]


def test_run_equals_the_stages(spark):
    out = C.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0


def test_names():
    assert [n for n, _ in C.STAGES] == ["quality_rules", "simhash_dedup", "decontamination", "pii", "packing"]
    assert C.ORACLE_SQL is None and all(re.fullmatch(r"\w+", n) for n, _ in C.STAGES)


def test_odd_rows(spark, odd, none):
    for name, stage in C.STAGES:
        out = stage(spark, odd, SF)
        if name != "packing":
            assert out.columns == odd.columns
        assert len(out.collect()) >= 0 and stage(spark, none, SF).collect() == []
