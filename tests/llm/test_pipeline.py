"""The pipeline's stages: columns kept, decisions in effect; the queries' registration."""
import __spark_entry__ as entry
import corpus_pipeline
from ledgerflow.llm.common import components

SF = "/root/testdata/sf0.01"


def test_stages_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF).cache()
        counts.append(docs.count())
        if n < 4:
            assert docs.columns == columns
        if name == "quality":
            kept = {r.doc_id for r in docs.collect()}
            assert all((d in kept) == (q == 1) for d, q in quality.items())
    assert counts[0] > counts[1] == counts[2] > counts[3] and counts[4] == counts[5]
    assert docs.where("decoded_sha256 IS NULL OR n_tokens != size(ids)").count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "ids" in out.columns


def test_ten_operators_and_pipeline_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 100), (95, 95), (200, 300), (300, 250)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 90: 90, 100: 90, 95: 95, 200: 200, 250: 200, 300: 200}
    assert components(df.limit(0)).count() == 0
