"""The pipeline against brute-force versions of its stages, each on its predecessor's rows."""

import os

import corpus_pipeline
from llm_cases import edge_docs
from test_decontaminate import brute as leaks
from test_packing import check_packed
from test_simhash import brute_components

from tillroll.llm import secret_scan, simhash
from tillroll.llm.quality_rules import text_counts

SF = "/root/testdata/sf0.001"


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(os.path.join(SF, "documents.parquet"))
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(os.path.join(SF, "benchmark.parquet")).collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.cut(stage(spark, docs, SF), "test_stage")
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "quality rules":                 # too few labels here to certify a rule: the base check decides
            def good(t):
                n = text_counts(t)
                return n[0] >= 10 and 100 * n[4] <= 20 * n[0]
            want = [r for r in before if good(r.text)]
        elif name == "near duplicates":
            comp = brute_components([r.doc_id for r in before], [simhash.fingerprint(r.text) for r in before])
            want = [r for r, c in zip(before, comp) if r.doc_id == c]
            assert len(want) < len(before)
        elif name == "decontamination":
            want = [r for r in before if not leaks(r.text, items)[1]]
            assert len(want) < len(before)
        elif name == "secret scan":
            want = [(r.doc_id, secret_scan.redacted(r.text, secret_scan.LEAST)) for r in before]
            assert sorted((r.doc_id, r.text) for r in after) == sorted(want)
            continue
        else:
            check_packed(after, [(r.doc_id or -1, r.text) for r in before])
            continue
        assert sorted(after, key=lambda r: r.doc_id) == sorted(want, key=lambda r: r.doc_id)


def test_stage_decisions_on_edge_rows(spark):
    docs = edge_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        empty = stage(spark, docs.where("false"), SF)
        assert empty.count() == 0
        if name != "packing":
            assert out.columns == docs.columns
            docs = corpus_pipeline.cut(out, "test_edges")
    assert out.count() > 0


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "decontamination", "secret scan",
                                                      "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())
