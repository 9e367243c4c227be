import uuid

import duckdb
import pytest
from odd import no_documents, odd_documents, saved
from pyspark.sql import functions as F

from noteloom.llm import mixing as m

FOLDER = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    found = m.op3_mixing(spark, FOLDER).toPandas()
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = connection.execute(m.oracle()).df()
    order = sorted(found.columns)
    assert sorted(want.columns) == order
    one, other = (x[order].sort_values("doc_id").reset_index(drop=True) for x in (found, want))
    assert (one == other).all().all()


def test_margins_meet_their_targets(spark):
    documents = m.measured(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    cells = documents.groupBy(*m.DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    targets = {d: m.targets_of(cells, d, m.TEMPER[d]) for d in m.DIMENSIONS}
    for row in m.margins(m.rake(cells, targets), targets).collect():
        assert row["weight"] == pytest.approx(row["target"], abs=2e-5)


def test_given_weights(spark):
    cells = spark.createDataFrame(
        [("a", "x", "t", 10), ("a", "y", "t", 30), ("b", "x", "t", 50), ("b", "y", "t", 10)],
        "source string, lang string, topic string, tokens long",
    )
    given = {"source": {"a": 3.0, "b": 1.0, "absent": 9.0}, "lang": {"x": 0.5, "y": 0.5}}
    targets = {d: m.targets_of(cells, d, 1.0, given.get(d)) for d in m.DIMENSIONS}
    raked = {(r["source"], r["lang"]): r["weight"] for r in m.rake(cells, targets, 60).collect()}
    assert raked["a", "x"] + raked["a", "y"] == pytest.approx(0.75)
    assert raked["a", "x"] + raked["b", "x"] == pytest.approx(0.5)
    # Raking keeps the odds ratio of the cells.
    odds = raked["a", "x"] * raked["b", "y"] / (raked["a", "y"] * raked["b", "x"])
    assert odds == pytest.approx(10 * 10 / (30 * 50))


def test_sample_is_what_the_query_keeps(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = m.sample(documents)
    assert kept.columns == documents.columns
    want = {r["doc_id"] for r in m.op3_mixing(spark, FOLDER).where("kept").select("doc_id").collect()}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == want


def test_shares_of_the_sample_come_near_the_targets(spark):
    rows = m.op3_mixing(spark, "/root/testdata/sf0.1").where("kept").groupBy("lang").agg(F.sum("n_tokens").alias("n")).collect()
    documents = m.measured(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    cells = documents.groupBy(*m.DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    target = {r["value"]: r["target"] for r in m.targets_of(cells, "lang", m.TEMPER["lang"]).collect()}
    total = sum(r["n"] for r in rows)
    for row in rows:
        assert row["n"] / total == pytest.approx(target[row["lang"]], abs=0.02)


def test_odd_documents(spark, tmp_path):
    df = odd_documents(spark)
    rows = m.op3_mixing(spark, saved(df, tmp_path)).collect()
    assert len(rows) == df.count()
    assert all(r["probability"] is not None and r["kept"] is not None for r in rows)
    assert {r["source"] for r in rows if r["doc_id"] is None} == {"(none)"}
    assert m.sample(df).columns == df.columns


def test_clashing_columns(spark):
    df = odd_documents(spark).withColumn("mix_probability", F.lit(0.0)).withColumn("probability", F.lit("p"))
    assert m.sample(df).columns == df.columns


def test_no_documents(spark, tmp_path):
    assert m.op3_mixing(spark, saved(no_documents(spark), tmp_path)).collect() == []
    assert m.sample(no_documents(spark)).collect() == []


@pytest.mark.parametrize("odd", [("own", "own", "five words of its own"), (None, "en", "five words of no source")])
def test_a_rare_cell_does_not_change_the_share_of_the_others(spark, odd):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "lang", "text")
    rare = spark.createDataFrame([(-1, *odd)], documents.schema)

    found = m.measured(documents.unionByName(rare))
    cells = found.groupBy(*m.DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    targets = {d: m.targets_of(cells, d, m.TEMPER[d]) for d in m.DIMENSIONS}
    rows = m.to_budget(cells, targets, 0.7, rounds=2).collect()
    (small,) = [r for r in rows if r["source"] == (odd[0] or "(none)")]
    assert small["weight"] == small["tokens"]
    others = [r for r in rows if r != small]
    assert sum(r["weight"] for r in others) / sum(r["tokens"] for r in others) == pytest.approx(0.7, abs=1e-3)


def test_budget_keeps_small_cells_whole_and_rakes_the_rest(spark):
    cells = spark.createDataFrame(
        [("a", "x", "t", 10), ("b", "x", "t", 1000), ("b", "y", "t", 500), ("c", "y", "t", 490)],
        "source string, lang string, topic string, tokens long",
    )
    targets = {d: m.targets_of(cells, d, 1.0, {"source": {"a": 0.4, "b": 0.4, "c": 0.2}}.get(d)) for d in m.DIMENSIONS}
    rows = m.to_budget(cells, targets, 0.5).collect()
    weight = {(r["source"], r["lang"]): r["weight"] for r in rows}
    assert sum(weight.values()) == pytest.approx(1000)
    assert weight["a", "x"] == 10
    assert all(r["weight"] <= r["tokens"] for r in rows)
    assert sum(r["weight"] for r in m.to_budget(cells, targets, 1.0).collect()) == 2000


def test_budget_margins(spark):
    documents = m.measured(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    for row in m.budget_margins(documents, 0.5).collect():
        assert row["weight"] == pytest.approx(row["target"], abs=1e-3)


def test_sample_takes_target_weights_and_a_topic(spark):
    rows = [(i, "s", "en", "a" if i % 2 else "b", "same words") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, subject string, text string")
    kept = m.sample(df, given={"topic": {"a": 1.0, "b": 0.0}}, topic=F.col("subject"))
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(1, 20, 2))


def jobs_of(spark, work) -> int:
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, group)
    try:
        work()
        return len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)


def test_the_number_of_jobs_does_not_follow_the_cells(spark):
    # Every source has half the tokens of the one before: with passes, one more cell would fill in each.
    rows = [
        (i, f"s{s}", f"l{i % 4}", "t", 2 ** (12 - s)) for s in range(12) for i in range(4)
    ]
    geometric = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n_tokens long")
    one = jobs_of(spark, lambda: m.rates(geometric, share=0.7).collect())
    other = jobs_of(spark, lambda: m.rates(geometric.where("source in ('s0', 's1')"), share=0.7).collect())
    assert one == other <= 12
    assert jobs_of(spark, lambda: m.op3_mixing(spark, FOLDER).collect()) <= 12


def test_many_cells_have_the_same_weights(spark, monkeypatch):
    documents = m.measured(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    one = {tuple(r[:3]): r[3] for r in m.rates(documents).collect()}
    monkeypatch.setattr(m, "CELLS_OF_ONE_TASK", 0)
    other = {tuple(r[:3]): r[3] for r in m.rates(documents).collect()}
    assert one == pytest.approx(other)


def test_one_odd_row_changes_nothing_for_the_others(spark, tmp_path):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(-1, "five words of its own", "own", "own", 21)], documents.schema)
    before = {r["doc_id"]: r["probability"] for r in m.op3_mixing(spark, FOLDER).collect()}
    after = {r["doc_id"]: r for r in m.op3_mixing(spark, saved(documents.unionByName(odd), tmp_path)).collect()}
    assert after.pop(-1)["kept"]
    assert max(abs(before[i] - row["probability"]) for i, row in after.items()) < 0.02
