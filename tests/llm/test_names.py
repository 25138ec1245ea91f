"""Documents whose extra columns are named like the operators' own."""
from ledgerflow.llm import line_dedup, minhash_forest, mixing
from ledgerflow.llm.common import unused

NAMES = ["_llm_id", "_llm_keys", "_llm_lines", "_llm_dropped", "_llm_of", "_llm_rate", "_LLM_COPY", "_llm_kept", "_llm_rn"]


def documents(spark):
    rows = [(i, f"{'often said' if i < 12 else 'rare'} {i if i >= 12 else ''}\nbody {i} " + "w " * i, f"s{i % 3}", *range(len(NAMES)))
            for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} long" for n in NAMES))


def test_unused_names(spark):
    df = spark.range(1).selectExpr("1 AS A", "2 AS a_")
    assert unused(df, "a", "b", "b") == ["a__", "b", "b_"]


def test_clashing_names(spark):
    docs = documents(spark)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "_llm_lines_", "_llm_dropped_"] == [*docs.columns, *line_dedup.counts(docs)]
    got = {r.doc_id: (r.text, r["_llm_dropped_"], r["_llm_rn"]) for r in out.collect()}
    assert got[3] == ("body 3 w w w ", 1, len(NAMES) - 1) and got[15][0].startswith("rare 15\n")
    mixed = mixing.mix(docs)
    plain = mixing.mix(docs.select("doc_id", "text", "source"))
    assert mixed.columns == docs.columns and sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in plain.collect())
    kept = minhash_forest.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in minhash_forest.keep_one(docs.select("doc_id", "text")).collect())
