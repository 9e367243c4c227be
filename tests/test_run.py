import datetime as dt
import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.operators import cohort, extract, notes, prompts, quality, records
from noteloom.plans import note_run
from noteloom.plans.queries import END, START
from noteloom.schemas import RESPONSES, RESULTS, STAR_TABLES
from noteloom.session import fresh_path, work_folder
from noteloom.sources import sinks

# The backends below run inside tasks, which cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUICK = extract.CallSettings(backoff_seconds=0, rate_limit_seconds=0)


def batches_of(spark, texts, size=3):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, Note string")
    return notes.with_batches(df, size)


def answering(system, user, max_tokens):
    """One record per note whose complaint is the note's text."""
    texts = [block.split("\n", 1)[1].split("\n\n")[0] for block in user.split("**Note ")[1:]]
    return json.dumps({"results": [{"Chief_Complain": t} for t in texts]})


def test_work_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert work_folder(spark) == named.rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_calls_and_attempts(spark):
    def backend(system, user, max_tokens):
        if "boom" in user:
            raise RuntimeError("no connection")
        if "blank" in user:
            return "  "
        if "words" in user:
            return "I cannot do that"
        return extract.Reply(answering(system, user, max_tokens), 10, 5)

    todo = prompts.batch_prompts(batches_of(spark, ["ok", "boom", "blank", "words"], 1))
    found = extract.call_backend(todo, backend, QUICK).orderBy("batch_id", "attempt").collect()
    assert found[0].asDict() | {"elapsed_ms": 0} == {
        "batch_id": 0, "prompt_digest": todo.filter("batch_id = 0").first().prompt_digest, "attempt": 1,
        "raw": '{"results": [{"Chief_Complain": "ok"}]}', "error": None,
        "prompt_tokens": 10, "completion_tokens": 5, "elapsed_ms": 0,
    }
    assert [(r.batch_id, r.attempt) for r in found[1:]] == [(b, a) for b in (1, 2, 3) for a in (1, 2, 3)]
    assert {r.error for r in found[1:]} == {"RuntimeError: no connection", "empty response", "no records"}


def test_second_attempt_succeeds(spark, tmp_path):
    seen = str(tmp_path / "seen")

    def backend(system, user, max_tokens):
        import os

        if not os.path.exists(seen):
            open(seen, "w").close()
            return '{"results":[{"Unknown":"x"}]}'
        return answering(system, user, max_tokens)

    todo = prompts.batch_prompts(batches_of(spark, ["a"]))
    settings = extract.CallSettings(backoff_seconds=0, rate_limit_seconds=0, extras="observed")
    path = fresh_path(spark, "responses")
    responses = note_run.gather_responses(todo, backend, path, settings)
    assert [(r.attempt, r.error) for r in responses.orderBy("attempt").collect()] == [(1, "unknown key"), (2, None)]
    attempts = records.parsed_attempts(responses, "observed")
    assert [(r.attempt, r.ok) for r in attempts.orderBy("attempt").collect()] == [(1, False), (2, True)]


def test_rate_holds_over_all_tasks_and_attempts(spark, tmp_path):
    rate = lambda s, n: s.tasks(n) / s.delay(s.tasks(n))
    for limit in (0.1, 4, 1000):
        for seconds in (0, 0.5, 2):
            settings = extract.CallSettings(max_batches_per_second=limit, rate_limit_seconds=seconds)
            assert rate(settings, 100) <= limit * 1.000001
    assert extract.CallSettings().tasks(100) == 100
    assert extract.CallSettings(parallelism=7).tasks(100) == 7
    todo = prompts.batch_prompts(batches_of(spark, ["a"] * 9))
    assert extract.call_backend(todo, answering, QUICK).rdd.getNumPartitions() == 8

    def backend(system, user, max_tokens):
        import time
        import uuid

        (tmp_path / uuid.uuid4().hex).write_text(str(time.time()))
        raise RuntimeError("down")

    settings = extract.CallSettings(
        parallelism=1, max_batches_per_second=10, rate_limit_seconds=0, backoff_seconds=0
    )
    assert extract.call_backend(todo, backend, settings).count() == 9
    times = sorted(float(p.read_text()) for p in tmp_path.iterdir())
    assert len(times) == 9
    assert min(b - a for a, b in zip(times, times[1:])) >= 0.09


def test_rerun_calls_only_what_is_missing(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def backend(system, user, max_tokens):
        import uuid

        (log / uuid.uuid4().hex).touch()
        return answering(system, user, max_tokens)

    path = fresh_path(spark, "responses")
    todo = prompts.batch_prompts(batches_of(spark, [f"n{i}" for i in range(12)]))
    note_run.gather_responses(todo.filter("batch_id < 2"), backend, path, QUICK)
    assert len(list(log.iterdir())) == 2
    found = note_run.gather_responses(todo, backend, path, QUICK, slices=3)
    assert len(list(log.iterdir())) == 4
    assert found.select("batch_id").distinct().count() == found.count() == 4


def test_failed_batches_are_called_again(spark, tmp_path):
    down = tmp_path / "down"
    down.touch()

    def backend(system, user, max_tokens):
        if "n1" in user and down.exists():
            raise RuntimeError("outage")
        return answering(system, user, max_tokens)

    path = fresh_path(spark, "responses")
    batched = batches_of(spark, ["n0", "n1"], 1)
    todo = prompts.batch_prompts(batched)
    first = note_run.gather_responses(todo, backend, path, QUICK)
    assert [r.Chief_Complain for r in note_run.records_to_results(batched, first).results.orderBy("row_id").collect()] == ["n0", ""]
    down.unlink()
    again = note_run.gather_responses(todo, backend, path, QUICK)
    assert again.count() == 5
    run = note_run.records_to_results(batched, again)
    assert [r.Chief_Complain for r in run.results.orderBy("row_id").collect()] == ["n0", "n1"]
    assert run.totals().first()[:] == (2, 2, 0)


def test_another_days_answers_reach_no_note(spark, small):
    """The same folder of responses on two days: batch numbers are the same, prompts are not."""
    path = fresh_path(spark, "responses")
    calls = extract.CallSettings(rate_limit_seconds=0, backoff_seconds=0)

    def run(day, respond):
        settings = note_run.RunSettings.for_day_before(day)
        return note_run.run_notes(small.star(), settings, respond)

    dates = cohort.cohort(small.star(), START, END).select(F.to_date("FormattedDate").alias("d")).distinct()
    days = [r.d + dt.timedelta(days=1) for r in dates.orderBy("d").limit(2).collect()]
    monday = run(days[0], note_run.model_responder(answering, path, calls))
    assert monday.results.filter("Chief_Complain <> ''").count() == monday.results.count() > 0
    replayed = run(days[1], lambda asked: spark.read.schema(RESPONSES).parquet(path))
    assert replayed.results.filter("Chief_Complain <> ''").count() == 0
    assert replayed.unmatched.count() == monday.responses.count()
    tuesday = run(days[1], note_run.model_responder(answering, path, calls))
    for row in tuesday.results.collect():
        assert row.Chief_Complain.strip() == row.Note.strip().split("\n\n")[0]
    with pytest.raises(ValueError, match="prompt_digest"):
        run(days[1], lambda asked: spark.createDataFrame([(0, 1, "[]")], "batch_id long, attempt int, raw string"))


def _responses(spark, rows):
    return spark.createDataFrame(rows, "batch_id long, attempt int, raw string")


def test_alignment_after_a_blank_note(spark):
    batched = batches_of(spark, ["a", " ", "b"])
    responses = _responses(spark, [(0, 1, answering("", prompts.prompt_of(["a", " ", "b"]), 0))])
    found = records.normalized_records(records.repaired_records(records.first_ok(records.parsed_attempts(responses))))

    def complaints(align):
        rows = records.records_for_notes(batched, found, align).orderBy("row_id").collect()
        return [r.Chief_Complain for r in rows]

    assert complaints("position") == ["a", "b", ""]
    assert complaints("nonblank") == ["a", "", "b"]


def test_every_note_gets_one_record(spark):
    """Short, long, failed and absent responses: the count is always that of the notes."""
    batched = batches_of(spark, [f"n{i}" for i in range(14)])
    record = '{"Chief_Complain":"c"}'
    responses = _responses(
        spark,
        [
            (0, 1, f"[{record}]"),
            (1, 1, f"[{','.join([record] * 9)}]"),
            (2, 1, "nothing"), (2, 2, "nothing"), (2, 3, "nothing"), (2, 4, f"[{record}]"),
            (3, 1, "nothing"), (3, 2, f"[{record}]"), (3, 3, f"[{record},{record}]"),
            (9, 1, f"[{record}]"),
        ],
    )
    run = note_run.records_to_results(batched, responses)
    rows = run.results.orderBy("row_id").collect()
    assert [r.Chief_Complain for r in rows] == ["c", "", "", "c", "c", "c", "", "", "", "c", "", "", "", ""]
    assert [r[C.SCORE_COLUMN] for r in rows][:2] == [0.2, 0.0]
    report = {r.batch_number: (r.ok, r.attempts, r.n_records) for r in run.report.collect()}
    assert report == {1: (True, 1, 1), 2: (True, 1, 9), 3: (False, 3, 0), 4: (True, 2, 1), 5: (False, 0, 0)}
    assert run.totals().first()[:] == (5, 3, 2)
    assert run.metrics().first().success_rate == pytest.approx(100 * 9 / 14)
    assert run.metrics().first().notes_per_minute is None
    assert run.usage().first()[:] == (10, 0, 0)


def test_unknown_key_blanks_the_batch_only_as_observed(spark):
    batched = batches_of(spark, ["a", "b", "c"])
    responses = _responses(spark, [(0, 1, '[{"Diagnosis":"x"},{"Diagnosis":"y","Allergies":"NKDA"}]')])
    merged = note_run.records_to_results(batched, responses).results.orderBy("row_id").collect()
    assert [(r.Diagnosis, r.Plan_Text) for r in merged] == [("x", ""), ("y", "Allergies: NKDA"), ("", "")]
    observed = note_run.records_to_results(batched, responses, note_run.RunSettings(extras="observed"))
    assert {r.Diagnosis for r in observed.results.collect()} == {""}


def test_run_with_a_model_and_as_a_replay(spark, small):
    settings = note_run.RunSettings(START, END, max_rows=20, batch_size=4)
    path = fresh_path(spark, "responses")
    calls = extract.CallSettings(rate_limit_seconds=0, backoff_seconds=0)
    run = note_run.run_notes(small.star(), settings, note_run.model_responder(answering, path, calls))
    rows = sorted(map(tuple, run.results.drop("falsy_fields", "nan_fields").collect()))
    assert len(rows) == 20 and run.totals().first()[:] == (5, 5, 0)
    assert {r[7] is not None for r in rows}
    assert run.usage().first().calls == 5
    metrics = run.metrics().first()
    assert (metrics.notes, metrics.success_rate) == (20, 100.0)
    assert metrics.completion_rate == pytest.approx(100 / 7) and metrics.mean_score == pytest.approx(0.2)
    responses = spark.read.schema(RESPONSES).parquet(path)
    replay = note_run.run_notes(small.star(), settings, lambda asked: responses)
    assert sorted(map(tuple, replay.results.drop("falsy_fields", "nan_fields").collect())) == rows


def test_results_do_not_depend_on_partitions(spark, small):
    def rows(partitions):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            run = note_run.run_notes(small.star(), note_run.RunSettings(START, END))
            return sorted(map(str, run.results.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    assert rows("3") == rows("11")


def test_score_and_batches_stay_in_bounds(spark, small):
    run = note_run.run_notes(small.star(), note_run.RunSettings(START, END))
    low, high, n = run.results.agg(
        F.min(C.SCORE_COLUMN), F.max(C.SCORE_COLUMN), F.count("*")
    ).first()
    assert 0 <= low <= high <= 1 and n == 45
    assert run.report.agg(F.sum("n_notes")).first()[0] == 45
    assert quality.overall_completion(run.results).first().total_records == 45


def test_nightly_run_from_the_command_line(spark, small, tmp_path, capsys):
    import run_notes

    for name, df in small.star().items():
        types = STAR_TABLES[name]
        df.select(*[F.col(t.name).cast(t.dataType) for t in types]).write.parquet(f"{tmp_path}/{name}.parquet")
    output = str(tmp_path / "results")
    given = ["--star", str(tmp_path), "--as-of", "1995-05-30", "--output", output, "--replace-day"]
    for _ in range(2):
        assert run_notes.run(spark, run_notes.arguments(given)) == 2
    rows = spark.read.parquet(output)
    assert rows.count() == 2
    assert set(rows.columns) == {*RESULTS.fieldNames(), "service_day"}
    assert "2 rows written" in capsys.readouterr().out
    # The day is corrected to no rows at all.
    spark.read.schema(STAR_TABLES["dim_company"]).parquet(f"{tmp_path}/dim_company.parquet").limit(0).write.parquet(
        f"{tmp_path}/none.parquet"
    )
    empty = {**small.star(), "dim_company": spark.read.parquet(f"{tmp_path}/none.parquet")}
    run = note_run.run_notes(empty, note_run.RunSettings.for_day_before(dt.date(1995, 5, 30)))
    assert run.replace_day(dt.date(1995, 5, 29), output) == 0
    assert spark.read.schema(rows.schema).parquet(output).count() == 0


def test_nightly_run_with_a_named_backend(spark, small, tmp_path, monkeypatch):
    import run_notes

    for name, df in small.star().items():
        types = STAR_TABLES[name]
        df.select(*[F.col(t.name).cast(t.dataType) for t in types]).write.parquet(f"{tmp_path}/{name}.parquet")
    (tmp_path / "told.py").write_text(
        "def call(system, user, budget):\n    return '{\"results\": [{\"Allergy\": \"%d\"}]}' % ('ICD-10' in user)\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    import told

    cloudpickle.register_pickle_by_value(told)
    name = "results_" + tmp_path.name.replace("-", "_")
    given = [
        "--star", str(tmp_path), "--as-of", "1995-05-30", "--output-table", name, "--replace-day",
        "--backend", "told:call", "--responses", str(tmp_path / "responses"), "--billing-code",
    ]
    try:
        assert run_notes.run(spark, run_notes.arguments(given)) == 2
        assert run_notes.run(spark, run_notes.arguments(given)) == 2
        assert spark.table(name).count() == 2
        assert spark.read.parquet(str(tmp_path / "responses")).count() == 1
        assert {r.Allergy for r in spark.table(name).collect()} <= {"1", "0", ""}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_one_run_leaves_nothing_behind(spark):
    from pathlib import Path

    from noteloom.session import one_run, stored

    with one_run(spark) as folder:
        assert stored(spark.range(3), "x").count() == 3
        place = Path(folder.removeprefix("file:"))
        assert list(place.iterdir())
    assert not place.exists()
    assert fresh_path(spark, "x").startswith(work_folder(spark))


# --- sinks ----------------------------------------------------------------------------


def test_append_counts_and_repeats(spark, small, tmp_path):
    path, records_ = str(tmp_path / "out"), small["records"]
    assert sinks.append_to_path(records_, path) == 200
    assert sinks.append_to_path(records_, path) == 200
    assert spark.read.schema(records_.schema).parquet(path).count() == 400


def test_overwriting_partitions_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "day int, x string")
    sinks.append_to_path(df, path, partition_by=["day"], overwrite_partitions=True)
    again = df.filter("day = 1").withColumn("x", F.upper("x"))
    assert sinks.append_to_path(again, path, partition_by=["day"], overwrite_partitions=True) == 2
    found = spark.read.parquet(path)
    assert sorted((r.day, r.x) for r in found.collect()) == [(1, "A"), (1, "B"), (2, "c")]
    with pytest.raises(ValueError):
        sinks.append_to_path(df, path, overwrite_partitions=True)


def test_a_day_is_replaced_also_by_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(dt.date(2024, 5, 1), "a"), (dt.date(2024, 5, 1), "b"), (dt.date(2024, 5, 2), "c")], "day date, x string")
    sinks.append_to_path(df, path, partition_by=["day"])
    found = lambda: sorted((str(r.day), r.x) for r in spark.read.schema(df.schema).parquet(path).collect())
    first = df.filter("day = '2024-05-01'")
    assert sinks.replace_in_path(first.filter("x = 'a'"), path, {"day": dt.date(2024, 5, 1)}) == 1
    assert found() == [("2024-05-01", "a"), ("2024-05-02", "c")]
    assert sinks.replace_in_path(first.limit(0), path, {"day": dt.date(2024, 5, 1)}) == 0
    assert found() == [("2024-05-02", "c")]
    with pytest.raises(Exception, match="row outside"):
        sinks.replace_in_path(df, path, {"day": dt.date(2024, 5, 1)})


def test_a_day_is_replaced_in_a_table(spark, tmp_path):
    name = "days_" + tmp_path.name.replace("-", "_")
    rows = [(dt.date(2024, 5, 1), "a"), (dt.date(2024, 5, 1), "b")]
    df = spark.createDataFrame(rows, "day date, x string")
    try:
        assert sinks.replace_in_table(df, name, {"day": dt.date(2024, 5, 1)}) == 2
        other = df.limit(1).withColumn("day", F.lit(dt.date(2024, 5, 2)))
        assert sinks.replace_in_table(other, name, {"day": dt.date(2024, 5, 2)}) == 1
        assert sinks.replace_in_table(df.limit(0), name, {"day": dt.date(2024, 5, 1)}) == 0
        assert [str(r.day) for r in spark.table(name).collect()] == ["2024-05-02"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_failing_write_raises(spark, tmp_path):
    df = spark.range(1).select(F.raise_error(F.lit("stop")).alias("x"))
    with pytest.raises(Exception, match="stop"):
        sinks.append_to_path(df, str(tmp_path / "out"))


def test_json_keeps_nulls_and_letters(spark, tmp_path):
    df = spark.createDataFrame([("é", None)], "a string, b string")
    sinks.write_json(df, str(tmp_path / "lines"))
    assert [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()] == ['{"a":"é","b":null}']
    sinks.write_json(df, str(tmp_path / "pretty"), pretty=True)
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "pretty")).collect())
    assert json.loads(text) == {"a": "é", "b": None} and '\n  "a"' in text


def test_append_to_table(spark, tmp_path):
    name = "results_" + tmp_path.name.replace("-", "_")
    df = spark.createDataFrame([(1, "a")], "day int, x string")
    spark.sql(f"CREATE TABLE {name} (x STRING, day INT) USING parquet LOCATION '{tmp_path}/t'")
    assert sinks.append_to_table(df, name) == 1
    assert sinks.append_to_table(df, name) == 1
    assert [tuple(r) for r in spark.table(name).collect()] == [("a", 1), ("a", 1)]
    spark.sql(f"DROP TABLE {name}")
