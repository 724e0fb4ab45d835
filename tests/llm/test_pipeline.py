import corpus_pipeline
from ledgerlens.session import materialize
from test_jaccard import brute
from test_text_operators import brute_base, brute_hits

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Every stage on what its predecessor kept; the classifier's scores are taken as they are."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        rows = docs.collect()
        kept[name] = {r["doc_id"]: r["text"] for r in rows}
        if name != "mixing":
            assert docs.columns == columns and len(rows) == len(kept[name])
        if name == "near_duplicates":
            assert set(kept[name]) == {i for i, (_, c) in brute(before.items()).items() if c == i}
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(kept[name]) == {i for i, x in brute_hits(before.items(), items).items() if not x[-1]}
        if name == "secrets":
            assert set(kept[name]) == set(before)
            assert all((kept[name][i] == t) == (not brute_base(t)) for i, t in before.items())
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        if name == "mixing":
            assert set(kept[name]) <= set(before) and {"epoch", "n_tokens", "domain"} <= set(docs.columns)


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_columns_of_the_names_that_mixing_adds_give_way(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clashing = docs.selectExpr("*", "'mine' as domain", "-1 as N_Tokens", "'kept' as other")
    mixed = materialize(corpus_pipeline.mixing(spark, clashing, SF), "clashing")
    assert mixed.columns == [*docs.columns, "other", "domain", "n_tokens", "epoch"]
    assert mixed.where("n_tokens < 0 or domain = 'mine' or other <> 'kept'").isEmpty() and not mixed.isEmpty()
