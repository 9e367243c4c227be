import pytest
from support import plan_of
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.operators import notes, prompts


def test_row_ids_are_dense_and_ordered(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("k"), F.lit("x").alias("Note"))
    rows = notes.with_row_id(df, [F.desc("k")]).orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(1000))
    assert [r.k for r in rows] == list(range(999, -1, -1))


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_row_ids_do_not_depend_on_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(200).select(F.xxhash64("id").alias("k"), "id")
        found = notes.with_row_id(df, [F.asc("k")]).orderBy("row_id").select("id").collect()
        assert [r.id for r in found] == [r.id for r in df.orderBy("k").select("id").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_copies_spread_over_partitions(spark):
    """Half of the rows are equal; numbered with unique=False they do not share a task."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"))
        found = notes.with_row_id(df, [F.asc("k")], unique=False)
        assert found.agg(F.count_distinct("row_id"), F.max("row_id")).first()[:] == (4000, 3999)
        assert [r.k for r in found.orderBy("row_id").collect()] == sorted(r.k for r in df.collect())
        placed = notes._placed(df, [F.asc("k")], unique=False)
        assert placed.filter("k = 7").select("_partition").distinct().count() > 2
        together = notes._placed(df, [F.asc("k")], unique=True)
        assert together.filter("k = 7").select("_partition").distinct().count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_no_note_is_numbered_or_written_twice(spark, monkeypatch):
    written = {}

    def stored(df, name):
        written[name] = df.columns
        return real(df, name)

    real = notes.stored
    monkeypatch.setattr(notes, "stored", stored)
    monkeypatch.setattr(notes, "LEAST_BYTES", 1)
    df = spark.createDataFrame([(2, "b"), (1, "a"), (1, "a"), (3, None)], "k int, Note string")
    rows = notes.numbered(notes.as_text(df), batch_size=1).orderBy("row_id").collect()
    assert [(r.row_id, r.k, r.Note) for r in rows] == [(0, 1, "a"), (1, 1, "a"), (2, 2, "b"), (3, 3, "")]
    assert "Note" in written["notes"] and "Note" not in written["row-ids"]


def dated_notes(spark, n=3000):
    """Rows with days that tie or are missing, null keys, and many copies of one row."""
    i = F.col("id")
    rows = spark.range(0, n, 1, 7).select(
        F.when(i % 11 != 0, F.expr("timestampadd(DAY, id % 5, TIMESTAMP_NTZ '2020-01-01 00:00:00')")).alias("FormattedDate"),
        F.when(i % 7 != 0, F.concat(F.lit("d"), i % 13)).alias("doctor"),
        F.concat(F.lit("text "), F.xxhash64("id").cast("string")).alias("Note"),
    )
    copies = spark.range(0, n // 3, 1, 3).select(F.lit(None).cast("timestamp_ntz"), F.lit("d1"), F.lit("copy"))
    return rows.union(copies)


@pytest.mark.parametrize("size", [1, 3, 7])
def test_parts_hold_whole_batches_in_order(spark, monkeypatch, size):
    monkeypatch.setattr(notes, "LEAST_BYTES", 1 << 10)
    monkeypatch.setattr(notes, "PART_BYTES", 1 << 11)
    df = dated_notes(spark)
    found = notes.with_batches(notes.numbered(df, batch_size=size, part=notes.PART), size).collect()
    found.sort(key=lambda r: r.row_id)
    digest = F.sha2("Note", 256)
    wanted = df.orderBy(F.desc_nulls_last("FormattedDate"), F.asc_nulls_last("doctor"), digest).collect()
    assert [r.row_id for r in found] == list(range(4000))
    assert [(r.FormattedDate, r.doctor, r.Note) for r in found] == [tuple(r) for r in wanted]
    parts = [r[notes.PART] for r in found]
    assert parts == sorted(parts) and set(parts) == set(range(max(parts) + 1)) and max(parts) > 16
    rows_of = [parts.count(p) for p in range(max(parts) + 1)]
    assert len(set(rows_of[:-1])) == 1 and rows_of[0] % size == 0


def test_one_move_of_the_notes_from_rows_to_prompts(spark, monkeypatch):
    monkeypatch.setattr(notes, "LEAST_BYTES", 1 << 10)
    placed = notes.with_batches(notes.numbered(dated_notes(spark), part=notes.PART))
    rendered = prompts.batch_prompts(placed)
    plan = plan_of(rendered)
    moves = [part for part in plan.split("\n\n") if "Exchange\nInput" in part]
    assert sum("Note" in move or "block" in move for move in moves) == 1, plan
    assert "MergeJoin" not in plan and "HashJoin" not in plan.split("===== Subqueries =====")[0]
    plain = prompts.batch_prompts(placed.drop(notes.PART))
    assert sorted(rendered.collect()) == sorted(plain.collect())


def test_a_part_is_of_bounded_bytes():
    assert notes._rows_of_part(0, 0, 3, 200) == 3
    assert notes._rows_of_part(10, 1000, 3, 200) == 12  # one part
    assert notes._rows_of_part(3_000_000, 64 << 30, 3, 200) == 2931  # 1,024 parts
    assert notes._rows_of_part(600, 100 << 20, 3, 8) == 75


def test_empty_input(spark):
    df = spark.createDataFrame([], "k int, Note string")
    assert notes.with_row_id(df, [F.asc("k")]).count() == 0
    assert notes.numbered(df).count() == 0
    assert prompts.batch_prompts(notes.with_batches(notes.numbered(df, part=notes.PART))).count() == 0


@pytest.mark.parametrize("size", [1, 3, 5, 100])
def test_batches(spark, size):
    df = notes.with_batches(spark.range(11).withColumnRenamed("id", "row_id"), size)
    rows = df.orderBy("row_id").collect()
    assert [(r.batch_id, r.pos_in_batch) for r in rows] == [divmod(i, size) for i in range(11)]


def test_text_and_missing_column(spark):
    df = spark.createDataFrame([(1, None), (2, 3.5)], "id int, Note double")
    assert [r.Note for r in notes.as_text(df).collect()] == ["", "3.5"]
    with pytest.raises(ValueError, match="Clinical_Notes"):
        notes.as_text(df, "Clinical_Notes")


def test_merge_pads_the_shorter_side(spark):
    left = spark.createDataFrame([(0, "a"), (1, "b")], "row_id long, x string")
    right = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "row_id long, y int")
    merged = notes.merge_by_row(left, right).orderBy("row_id").collect()
    assert [tuple(r) for r in merged] == [(0, "a", 1), (1, "b", 2), (2, None, 3)]
    with pytest.raises(ValueError, match="x"):
        notes.merge_by_row(left, left)


def test_prompt_of_a_batch_and_of_a_list(spark):
    texts = ["a", " ", " b "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, Note string")
    [row] = prompts.batch_prompts(notes.with_batches(df)).collect()
    assert "**Note 1:**\na\n\n**Note 3:**\nb\n\n" in row.user_prompt
    assert "Note 2" not in row.user_prompt
    assert row.user_prompt == prompts.prompt_of(texts)
    assert prompts.prompt_of([]) == C.NO_NOTES_PROMPT


def test_own_wording_can_be_replaced(spark):
    df = spark.createDataFrame([(0, "a")], "row_id long, Note string")
    [row] = prompts.batch_prompts(notes.with_batches(df), header="H", footer="F").collect()
    assert row.user_prompt == "H\n\n**Note 1:**\na\n\nF"
