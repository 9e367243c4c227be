from odd import no_documents, odd_documents, saved
from pyspark.sql import functions as F

import corpus_pipeline
from noteloom.llm import pii, simhash, toxicity

FOLDER = "/root/testdata/sf0.01"


def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        results.append(docs)
    return results


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_each_stage_takes_effect_on_what_the_one_before_kept(spark):
    raw, clean, single, masked, mixed, packed = stages(spark, FOLDER)
    for df in (clean, single, masked, mixed):
        assert df.columns == raw.columns
    model = toxicity.learn(raw, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    score = {r["doc_id"]: model.score(r["text"]) for r in raw.collect()}
    assert ids(clean) == {i for i, s in score.items() if s < 0.5}
    groups = {r["id"]: r["component_id"] for r in simhash.near_duplicates(clean, "doc_id", "text").collect()}
    assert ids(single) == {i for i, c in groups.items() if i == c}
    assert ids(masked) == ids(single)
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for row in masked.collect():
        assert not pii.base_spans(row["text"])
        assert row["n_chars"] == len(row["text"])
        assert row["text"] == before[row["doc_id"]] or "[" in row["text"]
    assert ids(mixed) < ids(masked)
    assert ids(packed) == ids(mixed)
    # The mix drops the most from the source that is largest against its target.
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns)
    assert rows.count() > 0


def test_odd_documents(spark, tmp_path):
    folder = saved(odd_documents(spark), tmp_path)
    saved(spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    results = stages(spark, folder)
    for df in results[:-1]:
        assert df.columns == results[0].columns
    assert ids(results[2]) == {1, 2, 6, 7, 8, 9, None}


def test_no_documents(spark, tmp_path):
    folder = saved(no_documents(spark), tmp_path)
    saved(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    assert corpus_pipeline.run(spark, folder).collect() == []
