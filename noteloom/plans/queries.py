"""The registered queries: one per operator, each over whole tables."""

import datetime as dt
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.operators import clean, cohort, extract, measures, notes, prompts, quality, records
from noteloom.plans import note_run
from noteloom.plans.fixture_views import Fixture
from noteloom.schemas import RESPONSES
from noteloom.session import configure, fresh_path, stored
from noteloom.sources import sinks, tables
from noteloom.sources.files import Folder

# Fixed so that results do not depend on a clock.
START, END = dt.datetime(1995, 1, 1), dt.datetime(2002, 1, 1)
AS_OF = dt.date(1996, 4, 29)
AS_OF_INSTANT = dt.datetime(1997, 1, 15, 12, 0)
TOP_N = 10

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(build: Callable[[Fixture], DataFrame]) -> Callable[[Fixture], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return build(Fixture(configure(spark), folder))

    query.__name__, query.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = query
    return build


# --- cohort ---------------------------------------------------------------------------


@registered
def cohort_latest_opd_notes(f: Fixture) -> DataFrame:
    return cohort.cohort(f.star(), START, END)


@registered
def cohort_day_slice(f: Fixture) -> DataFrame:
    return cohort.cohort(f.star(), *cohort.day_before(AS_OF))


@registered
def cohort_one_organization(f: Fixture) -> DataFrame:
    return cohort.cohort(f.star(), START, END, organization_key=1)


@registered
def cohort_rolling_window(f: Fixture) -> DataFrame:
    visits = cohort.with_notes(f["fact_billing"], f).select(
        F.col("patient_id").alias("Patient_ID"),
        F.col("Note").alias("Clinical_Notes"),
        F.col("Service_Date").alias("Visit_Date"),
    )
    return cohort.recent_documents(visits, AS_OF_INSTANT)


@registered
def join_company_credit(f: Fixture) -> DataFrame:
    joined = cohort.with_credit_company(f["fact_billing"], f)
    return joined.select("Service_Date", "patient_id", "Episode_key", "Company_Key", "CashAccounts")


@registered
def join_notes_fanout(f: Fixture) -> DataFrame:
    joined = cohort.with_notes(f["fact_billing"], f)
    return joined.select("Service_Date", "Episode_key", "Doctor_Key", "Note")


@registered
def join_diagnosis_left(f: Fixture) -> DataFrame:
    joined = cohort.with_diagnosis(f["fact_billing"], f)
    return joined.select("Service_Date", "Episode_key", "Doctor_Key", "ICDDiagnoseCode")


@registered
def join_staff(f: Fixture) -> DataFrame:
    joined = cohort.with_staff(f["fact_billing"], f["dim_staff"])
    return joined.select("Service_Date", "Episode_key", "Doctor_Key", "Staff_name", "degree_key")


@registered
def join_episode_type(f: Fixture) -> DataFrame:
    joined = cohort.with_outpatient_type(f["fact_billing"], f)
    return joined.select("Service_Date", "Episode_key", "Doctor_Key", "Unified_ShortName")


@registered
def join_organization_left(f: Fixture) -> DataFrame:
    joined = cohort.with_organization(f["fact_billing"], f)
    return joined.select("Service_Date", "Episode_key", "Organization_Key", "ShortName")


@registered
def exists_doctor_degree(f: Fixture) -> DataFrame:
    """Billing lines of staff who share a doctor's degree."""
    staff = cohort.sharing_a_doctors_degree(f["dim_staff"])
    joined = cohort.with_staff(f["fact_billing"], staff)
    return joined.select("Service_Date", "Episode_key", "Staff_Key", "Staff_name", "category_desc")


@registered
def like_doctor(f: Fixture) -> DataFrame:
    return f["dim_staff"].filter(cohort.mentions_doctor(F.col("category_desc")))


@registered
def dedup_latest(f: Fixture) -> DataFrame:
    """Latest row per doctor name, patient, episode, note and code, over all billing lines."""
    billed = cohort.with_staff(f["fact_billing"], f["dim_staff"])
    services = stored(cohort.latest_services(billed, f), "services")
    return cohort.with_documents(services, f)


@registered
def topn_latest(f: Fixture) -> DataFrame:
    return cohort.cohort(f.star(), START, END, newest=TOP_N)


@registered
def cap_rows(f: Fixture) -> DataFrame:
    return cohort.cohort(f.star(), START, END, newest=C.MAX_ROWS)


@registered
def cohort_ignore_case(f: Fixture) -> DataFrame:
    """Filters and names compared as under a case-insensitive, right-trimmed collation."""
    star = f.star() | {
        "dim_company": f["mixed_case_company"],
        "dim_patient_episode_type": f["mixed_case_type"],
        "dim_staff": f["mixed_case_staff"],
    }
    found = cohort.cohort(star, START, END, ci=True)
    # Which spelling of equal names is kept is not stated; what they have in common is.
    return found.select(
        "FormattedDate", F.lower(F.rtrim("Doctor_Name")).alias("doctor"), "Patient_Code", "Episode_key", "ICD10_code"
    ).distinct()


@registered
def cohort_from_query_file(f: Fixture) -> DataFrame:
    """A query file with named tables and dates."""
    path = Path(__file__).with_name("notes_of_a_period.sql")
    dates = {"start": dt.date(1996, 1, 1), "end": dt.date(1997, 1, 1)}
    names = ("fact_billing", "dim_clinical_notes")
    return tables.run_query_file(f.spark, str(path), {n: f[n] for n in names}, dates)


# --- notes and prompts ----------------------------------------------------------------


def _numbered_notes(f: Fixture, part: str | None = None) -> DataFrame:
    return notes.numbered(notes.as_text(f["dim_clinical_notes"]), part=part)


def _batched_documents(f: Fixture) -> DataFrame:
    """Documents as notes; ids are dense, so they serve as row numbers."""
    return notes.with_batches(f["cue_notes"].withColumn("row_id", F.col("note_id")))


@registered
def notes_as_text(f: Fixture) -> DataFrame:
    return notes.as_text(f["dim_clinical_notes"])


@registered
def note_batches(f: Fixture) -> DataFrame:
    return notes.with_batches(_numbered_notes(f)).select(
        "row_id", "batch_id", "pos_in_batch", "Episode_key", "Note"
    )


@registered
def batch_prompts(f: Fixture) -> DataFrame:
    rendered = prompts.batch_prompts(notes.with_batches(_numbered_notes(f, notes.PART)))
    return rendered.select("batch_id", "n_notes", "user_prompt")


@registered
def batch_prompts_billing(f: Fixture) -> DataFrame:
    rendered = prompts.batch_prompts(
        _batched_documents(f), billing_name="diagnosis_name", billing_code="icd10_code"
    )
    return rendered.select("batch_id", "n_notes", "user_prompt")


@registered
def token_budget(f: Fixture) -> DataFrame:
    return prompts.batch_prompts(_batched_documents(f)).select(
        "batch_id", F.length("user_prompt").cast("bigint").alias("prompt_chars"), "max_tokens"
    )


# --- responses ------------------------------------------------------------------------


def _attempts(f: Fixture, extras: str = "merge") -> DataFrame:
    return records.parsed_attempts(f["responses"], extras)


def _chosen(f: Fixture, extras: str = "merge") -> DataFrame:
    found = records.repaired_records(records.first_ok(_attempts(f, extras)))
    return records.normalized_records(found)


def _fixture_notes(f: Fixture) -> DataFrame:
    rows = f["documents"].select(F.col("doc_id").alias("row_id"))
    return notes.with_batches(rows)


def _response_shapes(f: Fixture) -> DataFrame:
    """Every document wrapped in one of 14 response forms, its text in the record."""
    text = F.col("text")  # replaced bracket by bracket: translate looks up every letter
    for bracket, other in zip("[]{}", "()()"):
        text = F.replace(text, F.lit(bracket), F.lit(other))
    record = F.to_json(F.struct(text.alias("Chief_Complain")))
    full = F.to_json(
        F.struct(text.alias("Chief_Complain"), F.lit("").alias("History"), F.col("lang").alias("Allergy"))
    )
    forms = [
        F.concat(F.lit('{"results":['), record, F.lit("]}")),
        F.concat(F.lit('{"data":['), record, F.lit(","), record, F.lit("]}")),
        F.concat(F.lit('{"notes":['), record, F.lit("]}")),
        F.concat(F.lit('{"extracted_features":['), record, F.lit("]}")),
        F.concat(F.lit('{"records":[1,'), record, F.lit("]}")),
        F.concat(F.lit("["), record, F.lit(","), record, F.lit("]")),
        full,
        F.concat(F.lit('{"items":['), record, F.lit("]}")),
        record,
        F.concat(F.lit('{"results":'), record, F.lit("}")),
        F.lit('"text"'),
        F.concat(F.lit("```\n["), record, F.lit("]\n```")),
        F.concat(F.lit("Note [see {]\n"), record),
        F.concat(record, F.lit(" tail")),
    ]
    # One form is made of each document; an array of all would make fourteen.
    chosen = F.coalesce(*[F.when(F.col("doc_id") % len(forms) == i, form) for i, form in enumerate(forms)])
    return f["documents"].select(
        F.col("doc_id").alias("batch_id"), F.lit(1).alias("attempt"), chosen.alias("raw")
    )


@registered
def repair_strategy(f: Fixture) -> DataFrame:
    return _attempts(f).select(
        "batch_id", "attempt", "strategy", F.size("records").alias("n_records")
    )


@registered
def repair_records(f: Fixture) -> DataFrame:
    found = records.repaired_records(_attempts(f))
    return found.select(
        "batch_id", "attempt", "rec_pos", "is_object",
        F.array_join(F.transform("entries", lambda e: F.concat_ws("=", e["key"], e["text"])), "|").alias("content"),
    )


@registered
def unwrap_records(f: Fixture) -> DataFrame:
    attempts = records.parsed_attempts(_response_shapes(f))
    held = F.transform("records", lambda r: F.array_join(
        F.transform(r["entries"], lambda e: F.concat_ws("=", e["key"], e["text"])), "|"))
    return attempts.select(
        "batch_id", "strategy", F.size("records").alias("n_records"), "ok",
        F.array_join(held, "||").alias("content"),
    )


@registered
def normalize_merge(f: Fixture) -> DataFrame:
    return _chosen(f).select("batch_id", "attempt", "rec_pos", *C.FIELDS, C.EXTRA_COLUMN)


@registered
def normalize_observed(f: Fixture) -> DataFrame:
    return _chosen(f, "observed").select("batch_id", "attempt", "rec_pos", *C.FIELDS, C.EXTRA_COLUMN)


@registered
def fix_count(f: Fixture) -> DataFrame:
    aligned = records.records_for_notes(_fixture_notes(f), _chosen(f))
    return aligned.select("row_id", "batch_id", "pos_in_batch", *C.FIELDS)


@registered
def fix_count_nonblank(f: Fixture) -> DataFrame:
    """As fix_count, past the notes that are blank and so were not in the prompt."""
    aligned = records.records_for_notes(_batched_documents(f), _chosen(f), align="nonblank")
    return aligned.select("row_id", "batch_id", "pos_in_batch", *C.FIELDS)


@registered
def responses_of_another_day(f: Fixture) -> DataFrame:
    """Answers to one day's prompts, offered to the next: only batches whose notes are the same
    take them."""
    asked = prompts.batch_prompts(_batched_documents(f))
    record = F.concat(F.lit('{"Allergy":"first day '), F.col("batch_id").cast("string"), F.lit('"}'))
    listed = F.array_join(F.array_repeat(record, F.col("n_notes").cast("int")), ",")
    responses = asked.select(
        "batch_id", "prompt_digest", F.lit(1).alias("attempt"), F.concat(F.lit("["), listed, F.lit("]")).alias("raw")
    )
    batched = notes.with_batches(f["next_day_notes"].withColumn("row_id", F.col("note_id")))
    taken = extract.answers_to(prompts.batch_prompts(batched), responses)
    run = note_run.records_to_results(batched, taken)
    return run.results.select("row_id", "Allergy")


@registered
def pending_after_failure(f: Fixture) -> DataFrame:
    """Batches to call again: those that failed, were never called, or answered other notes."""
    asked = prompts.batch_prompts(_batched_documents(f))
    kind = F.col("batch_id") % 4
    tried = asked.where(kind != 2).select(
        "batch_id",
        F.when(kind == 3, F.reverse("prompt_digest")).otherwise(F.col("prompt_digest")).alias("prompt_digest"),
        F.when(kind != 1, F.col("user_prompt")).alias("raw"),
        F.when(kind == 1, F.lit("RuntimeError: outage")).alias("error"),
    )
    return extract.pending(asked, tried).select("batch_id", "n_notes")


class _Moody:
    """A backend whose answers follow from the prompt's length: one kind always fails, one fails
    the first time it is asked, one stays blank, one talks."""

    def __init__(self):
        self.asked = set()

    def __call__(self, system: str, user: str, budget: int) -> str:
        kind, again = len(user) % 5, user in self.asked
        self.asked.add(user)
        if kind == 0 or (kind == 1 and not again):
            raise RuntimeError("down")
        return {2: " ", 3: "I would rather not."}.get(kind, f'{{"results":[{{"Allergy":"{len(user)}"}}]}}')


@registered
def model_attempts(f: Fixture) -> DataFrame:
    """Every attempt of the call loop over all documents."""
    calls = extract.CallSettings(backoff_seconds=0, rate_limit_seconds=0)
    asked = prompts.batch_prompts(_batched_documents(f))
    made = stored(extract.call_backend(asked, _Moody(), calls), "model-attempts")
    return made.select("batch_id", "attempt", "raw", "error")


class _Dying:
    """A backend that ends the process it is called in, the first time it is asked one kind of prompt."""

    def __init__(self, mark: Folder):
        mark.make()
        self.mark = mark.uri

    def __call__(self, system: str, user: str, budget: int) -> str:
        from noteloom.sources.files import Lines, names_in_task

        if len(user) % 7 == 3 and not names_in_task(self.mark):
            Lines(self.mark, "died").add(b"")
            os._exit(1)
        return f'{{"results":[{{"Allergy":"{len(user)}"}}]}}'


@registered
def answers_after_lost_task(f: Fixture) -> DataFrame:
    """All calls over the documents, with a task lost on the way: none is made twice, none is missing."""
    path = fresh_path(f.spark, "lost-task")
    backend = _Dying(Folder(f.spark, fresh_path(f.spark, "died")))
    calls = extract.CallSettings(backoff_seconds=0, rate_limit_seconds=0)
    asked = stored(prompts.batch_prompts(_batched_documents(f)), "asked")
    try:
        note_run.gather_responses(asked, backend, path, calls)
    except Exception:  # the lost task ends the job where tasks are not tried again
        pass
    return note_run.gather_responses(asked, backend, path, calls).select("batch_id", "attempt", "raw")


def _told(path: str, day: str) -> Callable[[DataFrame], DataFrame]:
    """Answers every prompt, and says in each record on which day, in which batch and at which place."""

    def respond(asked: DataFrame) -> DataFrame:
        place = lambda i: F.concat(
            F.lit(f'{{"Allergy":"{day} '), F.col("batch_id").cast("string"), F.lit("."), i.cast("string"), F.lit('"}')
        )
        listed = F.array_join(F.transform(F.sequence(F.lit(0), (F.col("n_notes") - 1).cast("int")), place), ",")
        answers = asked.select(
            "batch_id", "prompt_digest", F.lit(1).alias("attempt"), F.concat(F.lit("["), listed, F.lit("]")).alias("raw")
        )
        sinks.append_to_path(extract.as_responses(answers), path)
        return asked.sparkSession.read.schema(RESPONSES).parquet(path)

    return respond


@registered
def late_notes(f: Fixture) -> DataFrame:
    """Notes on two days, some written anew on the second: only these are asked again."""
    path = fresh_path(f.spark, "late-notes")
    settings = note_run.RunSettings()
    note_run.run_unanswered(f["unique_notes"], settings, path, _told(path, "first"))
    run = note_run.run_unanswered(f["late_notes"], settings, path, _told(path, "second"))
    return run.results.select("row_id", "Allergy")


@registered
def resolve_attempts(f: Fixture) -> DataFrame:
    return records.first_ok(_attempts(f, "observed")).select(
        "batch_id", "attempt", "strategy", F.size("records").alias("n_records")
    )


@registered
def batch_report(f: Fixture) -> DataFrame:
    return records.batch_report(_fixture_notes(f), _attempts(f, "observed"))


@registered
def batch_totals(f: Fixture) -> DataFrame:
    report = records.batch_report(_fixture_notes(f), _attempts(f, "observed"))
    return records.batch_totals(report)


@registered
def usage_totals(f: Fixture) -> DataFrame:
    return records.usage_totals(f["billed_responses"])


@registered
def quality_metrics(f: Fixture) -> DataFrame:
    attempts = stored(_attempts(f, "observed"), "attempts")
    found = records.repaired_records(records.first_ok(attempts))
    batched = _fixture_notes(f)
    aligned = records.records_for_notes(batched, records.normalized_records(found))
    report = records.batch_report(batched, attempts)
    return quality.quality_metrics(report, aligned, f["billed_responses"])


@registered
def cue_fields(f: Fixture) -> DataFrame:
    return extract.cue_records(f["cue_notes"]).select("note_id", *C.FIELDS)


@registered
def cue_fields_billing(f: Fixture) -> DataFrame:
    found = extract.cue_records(
        f["cue_notes"], billing_name="diagnosis_name", billing_code="icd10_code"
    )
    return found.select("note_id", "Diagnosis")


# --- quality --------------------------------------------------------------------------


@registered
def opd_score(f: Fixture) -> DataFrame:
    return quality.with_score(f["records"]).select("note_id", C.SCORE_COLUMN)


def _checked_records(f: Fixture) -> DataFrame:
    """Records as JSON without their null fields, read back as responses."""
    responses = f["records"].select(
        F.col("note_id").alias("batch_id"),
        F.lit(1).alias("attempt"),
        F.to_json(F.struct(*C.FIELDS)).alias("raw"),
    )
    found = records.repaired_records(records.parsed_attempts(responses))
    return quality.validated(records.with_keys(found))


@registered
def validate_records(f: Fixture) -> DataFrame:
    return _checked_records(f).select(
        F.col("batch_id").alias("note_id"), "valid", F.array_join("missing", ",").alias("missing")
    )


@registered
def validation_totals(f: Fixture) -> DataFrame:
    return quality.validation_totals(_checked_records(f))


@registered
def field_summary(f: Fixture) -> DataFrame:
    return quality.field_summary(f["records"]).drop("label")


@registered
def field_labels(f: Fixture) -> DataFrame:
    return quality.field_summary(f["records"]).select("field", "label", "cnt")


@registered
def overall_completion(f: Fixture) -> DataFrame:
    return quality.overall_completion(f["records"])


@registered
def top5_fields(f: Fixture) -> DataFrame:
    return quality.top_fields(quality.field_summary(f["records"])).select("field", "cnt", "pct")


@registered
def icd10_agreement(f: Fixture) -> DataFrame:
    return quality.with_agreement(f["code_pairs"])


@registered
def icd10_agreement_counts(f: Fixture) -> DataFrame:
    return quality.agreement_counts(quality.with_agreement(f["code_pairs"]))


# --- cleaning, merging, writing -------------------------------------------------------


@registered
def clean_records(f: Fixture) -> DataFrame:
    return clean.cleaned(f["long_records"])


@registered
def filter_nonempty(f: Fixture) -> DataFrame:
    return clean.nonempty(f["sparse_records"])


@registered
def removed_count(f: Fixture) -> DataFrame:
    return clean.removed_count(f["sparse_records"])


@registered
def merge_by_row(f: Fixture) -> DataFrame:
    """Notes beside diagnosis codes, two tables of different length."""
    codes = f["dim_diagnosis"].select(F.col("Episode_Key").alias("Coded_episode"), "ICDDiagnoseCode")
    order = [F.asc("Coded_episode"), F.asc("ICDDiagnoseCode")]
    return notes.merge_by_row(_numbered_notes(f), notes.with_row_id(codes, order, unique=False))


@registered
def append_roundtrip(f: Fixture) -> DataFrame:
    """Scored records appended twice: an append does not replace."""
    path = fresh_path(f.spark, "results")
    scored = quality.with_score(f["records"])
    for _ in range(2):
        sinks.append_to_path(scored, path)
    return f.spark.read.schema(scored.schema).parquet(path)


@registered
def replace_day(f: Fixture) -> DataFrame:
    """Three days written, one replaced by fewer rows, one by none."""
    path = fresh_path(f.spark, "days")
    scored = quality.with_score(f["records"]).withColumn("service_day", (F.col("note_id") % 3).cast("string"))
    sinks.append_to_path(scored, path, partition_by=["service_day"])
    sinks.replace_in_path(scored.filter("service_day = '0' AND note_id % 2 = 0"), path, {"service_day": "0"})
    sinks.replace_in_path(scored.limit(0), path, {"service_day": "1"})
    return f.spark.read.schema(scored.schema).parquet(path)


@registered
def replace_that_fails(f: Fixture) -> DataFrame:
    """Three days written; one is replaced, by another try with rows that cannot be computed."""
    path = fresh_path(f.spark, "failing-day")
    scored = quality.with_score(f["records"]).withColumn("service_day", (F.col("note_id") % 3).cast("string"))
    sinks.append_to_path(scored, path, partition_by=["service_day"])
    day = scored.filter("service_day = '0'")
    sinks.replace_in_path(day.filter("note_id % 2 = 0"), path, {"service_day": "0"})
    late = F.when(F.col("note_id") >= 0, F.raise_error(F.lit("no such score")).cast("double"))
    try:
        sinks.replace_in_path(day.withColumn(C.SCORE_COLUMN, late), path, {"service_day": "0"})
    except Exception as error:
        if "no such score" not in str(error):
            raise
    return sinks.results_in(f.spark, path, scored.schema)


@registered
def append_once(f: Fixture) -> DataFrame:
    """Two runs appended, each of them repeated: every run's rows are there once."""
    path = fresh_path(f.spark, "runs")
    scored = quality.with_score(f["records"])
    for run in ("monday", "monday", "tuesday", "monday", "tuesday"):
        sinks.append_once(scored, path, run)
    return f.spark.read.schema(scored.schema).parquet(path)


@registered
def measured_during_write(f: Fixture) -> DataFrame:
    """Records with content written, and what the same job found out about them."""
    path = fresh_path(f.spark, "measured")
    measured = measures.Measured(f["sparse_records"])
    sinks.append_to_path(measured.nonempty(), path)
    figures = measured.figures()
    written = f.spark.read.schema(f["sparse_records"].schema).parquet(path).agg(F.count(F.lit(1)).alias("written"))
    return written.select(
        "written", F.lit(figures.total).cast("bigint").alias("total"), F.lit(figures.removed).cast("bigint").alias("removed"),
        *[F.lit(figures.counts[field]).cast("bigint").alias(field) for field in C.FIELDS],
        F.lit(figures.completion_rate).alias("completion_rate"), F.lit(figures.mean_score).alias("mean_score"),
    )


@registered
def rejected_values(f: Fixture) -> DataFrame:
    """Billing lines read from text: the values that are not of their column's type."""
    return tables.split_rejects(f["text_billing"], "fact_billing", key="Episode_key")[1]


@registered
def accepted_rows(f: Fixture) -> DataFrame:
    """The billing lines without such values, and how many values each column cost."""
    good, rejects = tables.split_rejects(f["text_billing"], "fact_billing", key="Episode_key")
    days = good.groupBy("Service_Date").agg(F.count(F.lit(1)).alias("n"), F.sum("patient_id").alias("patients"))
    lost = tables.reject_counts(rejects).select(F.col("column").alias("lost_column"), F.col("rejected").alias("n"))
    return days.unionByName(lost, allowMissingColumns=True)


@registered
def json_export(f: Fixture) -> DataFrame:
    path = fresh_path(f.spark, "json")
    sinks.write_json(f["records"], path)
    return f.spark.read.text(path).select(F.col("value").alias("record_json"))


@registered
def end_to_end_results(f: Fixture) -> DataFrame:
    run = note_run.run_notes(f.star(), note_run.RunSettings(START, END))
    return run.results.drop(C.EXTRA_COLUMN, "falsy_fields", "nan_fields")


@registered
def end_to_end_totals(f: Fixture) -> DataFrame:
    """Batches of a run, and whether every record of it was valid."""
    run = note_run.run_notes(f.star(), note_run.RunSettings(START, END))
    sides = run.totals().unionByName(run.validation(), allowMissingColumns=True)
    return sides.agg(
        *[F.max(c).alias(c) for c in ("total_batches", "successful", "failed", "total", "valid", "all_valid")]
    )
