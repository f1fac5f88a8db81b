"""The stages of the corpus pipeline on awkward rows and on the smallest tables."""

import corpus_pipeline
from tests.llm.checks import jaccard_classes, passages
from tests.llm.test_operators import FOLDER, ODD, frame


def test_stages_on_odd_rows(spark, tmp_path):
    docs = frame(spark, ODD).repartition(2)
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if number == 0:
            kept = docs.count()
            assert docs.where("text is null or text = ''").count() == 0
    assert docs.select("doc_id").distinct().count() <= kept and docs.count() > 5


def test_stages_on_empty_table(spark, tmp_path):
    docs = frame(spark, [])
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
    assert docs.count() == 0


def test_stage_decisions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    kept = {r["doc_id"] for r in stages["n-gram Jaccard join"](spark, docs, FOLDER).collect()}
    assert kept == {d for d, _, c in jaccard_classes(rows) if d == c}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    cut = {r["doc_id"]: r["text"] for r in stages["benchmark decontamination"](spark, docs, FOLDER).collect()}
    for d, n, hit, _ in passages(rows, items):
        if not hit:
            assert cut[d] == dict(rows)[d]
    left = passages(sorted(cut.items()), items)
    assert len(cut) == len(rows) and sum(h for _, _, h, _ in left) <= 0.02 * sum(h for _, _, h, _ in passages(rows, items))
    assert corpus_pipeline.run(spark, FOLDER).count() > 100


def test_documents_pass_where_no_language_can_be_learnt(spark):
    rows = [(1, "some words of a text", None, "a", 20), (2, None, None, "a", 0), (3, "others", None, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()) == [1, 2, 3]
