import corpus_pipeline
import __spark_entry__ as contract
from derrick.llm import jaccard_forest, quality_gam, quality_trees
from tests.llm.cases import empty, frame
from tests.llm.test_join import brute as brute_classes

FOLDER = "/root/testdata/sf0.01"


def test_stages_apply_their_decisions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    (_, classify), (_, rules), (_, dedupe), (_, pack) = corpus_pipeline.STAGES

    good = classify(spark, docs, FOLDER).cache()
    want = quality_gam.classify(docs, quality_gam.train(docs, labels)).where("predicted = 1")
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == {r.doc_id for r in want.collect()}

    passing = rules(spark, good, FOLDER).cache()
    want = quality_trees.verdicts(good, quality_trees.train(good, labels)).where("kept")
    assert passing.columns == docs.columns and {r.doc_id for r in passing.collect()} == {r.doc_id for r in want.collect()}

    single = dedupe(spark, passing, FOLDER).cache()
    rows = [(r.doc_id, r.text) for r in passing.collect()]
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == {c for _, c, _, _ in brute_classes(rows)}

    packed = pack(spark, single, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in single.collect()}


def test_run_and_names(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "jaccard_join", "best_fit_packing"]
    rows = contract.queries()["pipeline"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(0 < r.length <= 1024 for r in rows)


def test_stages_take_edge_cases(spark):
    for docs in (frame(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, docs, "/root/testdata/sf0.001")
            assert name == "best_fit_packing" or kept.columns == docs.columns
            assert (kept.count() > 0) == (docs.count() > 0)


def test_all_queries_are_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert jaccard_forest.THRESHOLD == (4, 5)
