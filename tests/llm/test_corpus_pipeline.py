"""The corpus pipeline against a brute-force version of its five stages."""

import brute

import corpus_pipeline
from ledgermatch.llm import pii

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark, small_docs, small_bench):
    rows = [r for r in small_docs.collect() if brute.quality_kept(r.text)]
    roots = brute.components([brute.simhash(r.text) for r in rows])
    heads = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        heads.setdefault(roots[brute.simhash(r.text)], r)
    wins = brute.windows([(r.item_id, r.text) for r in small_bench.collect()])
    clean = [r for r in heads.values() if not brute.contamination(r.text, wins)[1]]
    find = pii.finder()
    masked = [(r.doc_id, pii.mask(r.text, find(r.text)), r.source) for r in clean]
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*small_docs.columns, "block", "slot", "place"]
    assert sorted(map(str, brute.mix(masked))) == \
        sorted(str(tuple(r)) for r in got.select("doc_id", "text", "block", "slot", "place").collect())


def test_stages_on_hard_and_no_rows(spark, hard, nothing, tmp_path):
    for name, docs in (("hard", hard), ("nothing", nothing)):
        columns = docs.columns
        for stage, function in corpus_pipeline.STAGES:
            out = function(spark, docs, SF)
            assert out.columns[:len(columns)] == columns
            path = f"{tmp_path}/{name}-{stage}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() <= 10
