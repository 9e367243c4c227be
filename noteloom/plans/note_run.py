"""The whole run: cohort, prompts, responses, records, scores, results."""

import datetime as dt
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.operators import cohort as cohorts
from noteloom.operators import extract, notes, prompts, quality, records, reuse
from noteloom.schemas import NOTE_INDEX, RESPONSES, RESULTS
from noteloom.session import fresh_path, stored
from noteloom.sources import sinks
from noteloom.sources.files import Folder, mounted
from noteloom.sources.journal import journal_rows


@dataclass(frozen=True)
class RunSettings:
    start: dt.datetime | None = None
    end: dt.datetime | None = None
    organization_key: int | None = None
    ignore_case: bool = False
    note_column: str = "Note"
    max_rows: int | None = None
    batch_size: int = C.BATCH_SIZE
    max_attempts: int = C.MAX_ATTEMPTS
    extras: str = "merge"
    align: str = "position"
    # Columns whose values stand beside each note in the prompt, or fill an empty diagnosis.
    billing_name: str | None = None
    billing_code: str | None = None
    header: str = C.PROMPT_HEADER
    footer: str = C.PROMPT_FOOTER
    system_prompt: str = C.SYSTEM_PROMPT

    @classmethod
    def for_day_before(cls, as_of: dt.date, **settings) -> "RunSettings":
        start, end = cohorts.day_before(as_of)
        return cls(start=start, end=end, **settings)


def cohort_batches(
    star: cohorts.Star, settings: RunSettings = RunSettings(), part: str | None = None
) -> DataFrame:
    """Cohort rows with row_id, batch_id and pos_in_batch, read from the files that fixed
    their order. ``part`` names a column for the part that a row's whole batch lies in."""
    return notes.with_batches(cohort_rows(star, settings, part), settings.batch_size)


def cohort_rows(
    star: cohorts.Star, settings: RunSettings = RunSettings(), part: str | None = None
) -> DataFrame:
    """The same without batches."""
    rows = cohorts.cohort(
        star,
        settings.start,
        settings.end,
        settings.organization_key,
        settings.ignore_case,
        settings.max_rows,
    )
    texts = notes.as_text(rows, settings.note_column)
    return notes.numbered(texts, settings.note_column, batch_size=settings.batch_size, part=part)


def prompts_for(batched: DataFrame, settings: RunSettings = RunSettings()) -> DataFrame:
    return prompts.batch_prompts(
        batched,
        settings.note_column,
        settings.billing_name,
        settings.billing_code,
        settings.header,
        settings.footer,
        settings.system_prompt,
    )


def gather_responses(
    todo: DataFrame,
    backend: extract.Backend,
    path: str,
    settings: extract.CallSettings = extract.CallSettings(),
    slices: int = 1,
) -> DataFrame:
    """Call the model for every prompt without a good response under ``path``.

    A call is kept as soon as it is answered, in a journal below ``path``, and joins the responses when
    its job ends, or when the next run finds the journal of one that did not. So a lost task,
    job or driver costs the calls that were under way. ``slices`` are jobs one after the other.
    Responses to other prompts may lie under the same path, of another day or another wording;
    they are neither taken nor called again. One run at a time calls for a folder.
    """
    spark = todo.sparkSession
    folder = Folder(spark, path)
    settle(spark, folder)
    for part in range(slices):
        batch = todo.filter(F.pmod(F.xxhash64("batch_id"), F.lit(slices)) == part)
        batch = extract.pending(batch, spark.read.schema(RESPONSES).parquet(path))
        run = uuid.uuid4().hex
        calls = extract.call_backend(batch, backend, settings, f"{folder.uri}/{JOURNAL}/{run}", _slots(folder, run, settings))
        calls.write.format("noop").mode("overwrite").save()
        folder.delete(f"_slots-{run}")
        settle(spark, folder)
    return spark.read.schema(RESPONSES).parquet(path)


JOURNAL = "_journal"


def settle(spark: SparkSession, folder: Folder) -> None:
    """Make the calls in journals below a folder part of its responses, each once."""
    folder.make(JOURNAL)
    for run in folder.names(JOURNAL):
        journal = f"{JOURNAL}/{run}"
        sinks.append_once(journal_rows(spark, f"{folder.uri}/{journal}"), folder.uri, run)
        folder.delete(journal)
    for name in folder.names():
        if name.startswith("_slots-"):
            folder.delete(name)


def _slots(folder: Folder, run: str, settings: extract.CallSettings) -> extract.Slots | None:
    """One rate for all tasks, where they share a mounted folder; else each has its share of it."""
    place = mounted(folder.uri)
    if settings.max_batches_per_second is None or place is None:
        return None
    return extract.Slots(f"{place}/_slots-{run}", settings.max_batches_per_second, time.time())


@dataclass(frozen=True)
class NoteRun:
    results: DataFrame  # one scored row per cohort row
    report: DataFrame  # one row per batch
    checked: DataFrame  # one row per record found, before normalization
    responses: DataFrame
    unmatched: DataFrame | None = None  # responses offered that answer other prompts

    def rows(self) -> DataFrame:
        """The columns of the results table."""
        return self.results.select(*RESULTS.fieldNames())

    def append_to(self, path: str, run: str | None = None, **options) -> int:
        """Append the rows to a folder; returns their number.

        With ``partition_by=["service_day"]`` the day of service becomes a column. Repeating a named
        ``run`` adds nothing.
        """
        rows = self.rows()
        if "service_day" in options.get("partition_by", ()):
            rows = rows.withColumn("service_day", F.to_date("FormattedDate"))
        if run is not None:
            return sinks.append_once(rows, path, run, **options)
        return sinks.append_to_path(rows, path, **options)

    def append_to_table(self, table: str, run: str | None = None) -> int:
        """Append the rows to a catalog table (schema-qualified name); repeating a named ``run``,
        for which the table has to be there, adds nothing."""
        if run is not None:
            return sinks.append_once_to_table(self.rows(), table, run)
        return sinks.append_to_table(self.rows(), table)

    def replace_day(self, day: dt.date, path: str | None = None, table: str | None = None) -> int:
        """Make the rows the whole content of a day in a folder or table partitioned by
        ``service_day``, also if there are none; returns their number."""
        rows = self.rows().withColumn("service_day", F.to_date("FormattedDate"))
        if path is not None:
            return sinks.replace_in_path(rows, path, {"service_day": day})
        return sinks.replace_in_table(rows, table, {"service_day": day})

    def summary(self) -> DataFrame:
        return quality.field_summary(self.results)

    def totals(self) -> DataFrame:
        return records.batch_totals(self.report)

    def validation(self) -> DataFrame:
        return quality.validation_totals(self.checked)

    def usage(self) -> DataFrame:
        return records.usage_totals(self.responses)

    def metrics(self) -> DataFrame:
        return quality.quality_metrics(self.report, self.results, self.responses)


def records_to_results(
    batched: DataFrame, responses: DataFrame, settings: RunSettings = RunSettings()
) -> NoteRun:
    """Responses to scored rows, for responses known to answer these very batches.

    Only batch_id, attempt and raw are required of them.
    """
    responses = extract.as_responses(responses)
    attempts = records.parsed_attempts(responses, settings.extras)
    attempts = stored(attempts.withColumn(records.ROW, F.monotonically_increasing_id()), "attempts")
    found = records.repaired_records(records.first_ok_of_stored(attempts, settings.max_attempts))
    aligned = records.records_for_notes(
        batched, records.normalized_records(found), settings.align, settings.note_column
    )
    scored = quality.with_score(aligned)
    results = scored.select(
        "row_id", *[c for c in batched.columns if c not in ("row_id", "batch_id", "pos_in_batch")],
        *C.FIELDS, C.EXTRA_COLUMN, C.SCORE_COLUMN, "falsy_fields", "nan_fields",
    )
    report = records.batch_report(batched, attempts, settings.max_attempts)
    checked = quality.validated(records.with_keys(found))
    return NoteRun(results, report, checked, responses)


def cue_run(batched: DataFrame, settings: RunSettings = RunSettings()) -> NoteRun:
    """Scored rows by the cue rules, note by note: nothing is shuffled or parsed.

    The rules give all seven fields as text, so no field is flagged, every record is valid and
    every batch succeeds at once.
    """
    found = extract.cue_records(batched, settings.note_column, settings.billing_name, settings.billing_code)
    no_flags = F.array().cast("array<string>")
    results = quality.with_score(found).select(
        "row_id", *[c for c in batched.columns if c not in ("row_id", "batch_id", "pos_in_batch")],
        *C.FIELDS, F.lit("").alias(C.EXTRA_COLUMN), C.SCORE_COLUMN,
        no_flags.alias("falsy_fields"), no_flags.alias("nan_fields"),
    )
    records_found = batched.select("batch_id", F.col("pos_in_batch").alias("rec_pos"))
    complete = records_found.withColumn("keys", F.array(*[F.lit(f) for f in C.FIELDS]))
    report = batched.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_notes")).select(
        "batch_id", (F.col("batch_id") + 1).alias("batch_number"), "n_notes",
        F.lit(True).alias("ok"), F.lit(1).cast("bigint").alias("attempts"),
        F.lit(1).alias("strategy"), F.col("n_notes").cast("int").alias("n_records"),
    )
    no_calls = batched.sparkSession.createDataFrame([], RESPONSES)
    checked = quality.validated(complete.withColumn("is_object", F.lit(True)))
    return NoteRun(results, report, checked, no_calls)


def run_notes(
    star: cohorts.Star,
    settings: RunSettings = RunSettings(),
    respond: Callable[[DataFrame], DataFrame] | None = None,
) -> NoteRun:
    """The run with ``respond`` taking prompts to responses.

    None answers by the cue rules. A replay is ``lambda prompts: earlier_responses``; of
    these, responses to other prompts are left aside and reported as ``unmatched``. A model
    is ``model_responder(backend, path)``, which writes its responses before anything reads
    them, so that no call is repeated.
    """
    placed = cohort_batches(star, settings, notes.PART)
    batched = placed.drop(notes.PART)
    if respond is None:
        return cue_run(batched, settings)
    asked = stored(prompts_for(placed, settings), "prompts")
    responses = respond(asked)
    run = records_to_results(batched, extract.answers_to(asked, responses), settings)
    return replace(run, unmatched=extract.unmatched(asked, responses))


NOTES = "_notes"  # below the responses: which notes their prompts held


def run_unanswered(
    rows: DataFrame,
    settings: RunSettings,
    path: str,
    respond: Callable[[DataFrame], DataFrame],
) -> NoteRun:
    """The run over numbered rows that asks only for notes that no answered prompt held.

    ``rows`` have row_id, as from ``cohort_rows``; ``path`` is the folder of responses. A note takes its
    record from the response to an earlier prompt that held the same note, whatever else was in
    that prompt; the others are batched among themselves, blank ones are not asked. So one late
    note costs one call, where ``run_notes`` would call for all batches after it.
    """
    spark = rows.sparkSession
    folder = Folder(spark, path)
    settle(spark, folder)
    folder.make(NOTES)
    index = lambda: spark.read.schema(NOTE_INDEX).parquet(f"{folder.uri}/{NOTES}")
    name, code = (F.col(c) if c else None for c in (settings.billing_name, settings.billing_code))
    digest = reuse.note_digest(
        F.col(settings.note_column), name, code, settings.header, settings.footer, settings.system_prompt
    )
    earlier = spark.read.schema(RESPONSES).parquet(path)
    # The rows are written once. What is looked up, numbered and placed are their marks; texts move
    # once, to the prompts, and once more where the results are read with them.
    written = stored(rows.withColumns({reuse.DIGEST: digest, reuse.MARK: F.monotonically_increasing_id()}), "rows")
    marks = written.select(reuse.MARK, "row_id", reuse.DIGEST)
    known = stored(reuse.with_earlier_answer(marks, index(), earlier), "known")
    rest = stored(notes.with_batches(reuse.to_ask(known), settings.batch_size, "rest_id"), "rest")
    texts = written.drop("row_id", reuse.DIGEST).join(rest.select(reuse.MARK, "batch_id", "pos_in_batch"), reuse.MARK)
    asked = stored(prompts_for(texts, settings), "prompts")
    held = stored(reuse.note_positions(rest, asked), "positions")
    # Before any call, so that no answer is without its notes.
    sinks.append_to_path(held.select(*NOTE_INDEX.fieldNames()), f"{folder.uri}/{NOTES}")
    responses = respond(asked)
    # By now the prompts of this run answer its notes, those that got a good answer at least.
    columns = ["batch_id", "prompt_digest", "rec_pos"]
    placed = stored(reuse.with_earlier_answer(known.drop(*columns), index(), responses), "placed")
    missed = placed.where(F.col("prompt_digest").isNull()).drop(*columns)
    failed = missed.join(held.select("row_id", *columns), "row_id", "left").select(*placed.columns)
    placed = placed.where(F.col("prompt_digest").isNotNull()).unionByName(failed)
    numbered, answers = reuse.in_one_numbering(placed, extract.as_responses(responses))
    batched = stored(numbered.withColumnRenamed("rec_pos", "pos_in_batch").drop(reuse.DIGEST, "prompt_digest"), "batches")
    run = records_to_results(batched, stored(answers, "answers"), replace(settings, align="position"))
    asked_notes = run.report.where(F.col("batch_id").isNotNull())  # blank notes are in no batch
    found = [c for c in run.results.columns if c not in ("row_id", reuse.MARK)]
    results = run.results.join(written.drop("row_id", reuse.DIGEST), reuse.MARK)
    results = results.select("row_id", *[c for c in rows.columns if c != "row_id"], *found)
    return replace(run, results=results, report=asked_notes)


def model_responder(
    backend: extract.Backend,
    path: str | None = None,
    settings: extract.CallSettings = extract.CallSettings(),
    slices: int = 1,
) -> Callable[[DataFrame], DataFrame]:
    """Calls the model for prompts without a good response under ``path``.

    ``settings.system_prompt`` has to be that of the run: it is part of what is answered.
    """

    def respond(asked: DataFrame) -> DataFrame:
        place = path or fresh_path(asked.sparkSession, "model-responses")
        return gather_responses(asked, backend, place, settings, slices)

    return respond
