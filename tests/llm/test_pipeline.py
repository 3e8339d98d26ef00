"""The pipeline, stage by stage, against what each operator is for."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline as c
from reelhouse.llm import quality_rules, secrets, simhash


def test_stages_take_effect(spark, folder, small):
    docs = small["documents"]
    seen = {}
    for name, stage in c.STAGES:
        docs = c.written(stage(spark, docs, folder), name)
        seen[name] = docs
        if name != c.STAGES[-1][0]:
            assert docs.columns == small["documents"].columns
    good = quality_rules.judged(small["documents"], small["labels"]).where("kept").select("doc_id")
    assert sorted(r.doc_id for r in seen["quality_rules"].collect()) == sorted(r.doc_id for r in good.collect())
    groups = {r.component_id for r in simhash.near_groups(seen["quality_rules"]).collect()}
    assert {r.doc_id for r in seen["simhash_near_dedup"].collect()} <= groups
    for r in seen["secret_scan"].collect():
        assert not any(k in ("access", "hex") for k, _, _ in secrets.base_spans(r.text))
    known = {r.doc_id for r in seen["secret_scan"].collect()}
    assert {r.doc_id for r in seen["source_mix"].collect()} <= known
    by = defaultdict(list)
    for r in seen["best_fit_packing"].collect():
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096


def test_edge_rows(spark, folder, edge_docs, no_docs):
    for start in (edge_docs, no_docs):
        docs = start
        for name, stage in c.STAGES:
            stage_of_all = stage(spark, start, folder)
            stage_of_all.count()
            docs = c.written(stage(spark, docs, folder), name)
        docs.count()


def test_queries_are_registered():
    import __spark_entry__ as registered

    names = registered.queries()
    assert "pipeline" in names and {f"op{i}" for i in range(1, 14)} <= {n.split("_")[0] for n in names}


def test_stages_need_id_source_and_text_only(spark, folder, small):
    """Tables without ``n_chars`` pass the stages that change texts."""
    docs = small["documents"].drop("n_chars")
    for stage in (c.mask_secrets, c.mix_sources):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() > 0
