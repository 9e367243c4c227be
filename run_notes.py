"""Nightly run for spark-submit: yesterday's notes to scored rows in a results folder or table.

    spark-submit run_notes.py --star <folder> --as-of 2024-05-03 --output <folder>
    spark-submit run_notes.py --database warehouse --as-of 2024-05-03 --output-table results.notes
    spark-submit run_notes.py ... --backend my_module:call --responses <folder>
    spark-submit run_notes.py --jdbc-url jdbc:sqlserver://... --jdbc-option user=reader ...

Without --backend and --responses the cue rules answer. A backend is a callable that takes the
system prompt, the user prompt and the token budget and returns text or a Reply; its responses
are kept under --responses as they come in, and a rerun calls only what has no good response there.
With --unanswered-only a note that any answered prompt held is not asked again. With
--responses alone the responses kept there are replayed; those that answer other prompts are
left aside and counted. With --run-id, repeating a run appends nothing. With --rejects, rows of the star
that hold values of a wrong type are left out, and these values written there; without, they end
the run. Any failure ends the run with an error.
"""

import argparse
import datetime as dt
import importlib
from dataclasses import replace

from pyspark.sql import SparkSession

from noteloom import contract as C
from noteloom.operators import extract, measures
from noteloom.plans import note_run
from noteloom.schemas import RESPONSES, STAR_TABLES
from noteloom.session import configure, one_run, stored
from noteloom.sources import sinks, tables


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--star", help="folder with one parquet table per star-schema name")
    source.add_argument("--database", help="catalog database with those tables")
    source.add_argument("--jdbc-url", help="database with those tables")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE", help="such as user, driver")
    parser.add_argument("--rejects", help="folder for values of the star that are not of their column's type")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, required=True, help="the day after the one to read")
    output = parser.add_mutually_exclusive_group(required=True)
    output.add_argument("--output", help="results folder; rows are appended")
    output.add_argument("--output-table", help="results table; rows are appended")
    parser.add_argument("--replace-day", action="store_true", help="the day's rows replace earlier ones, also by none")
    parser.add_argument("--backend", help="module:function that calls a model")
    parser.add_argument("--responses", help="folder of responses, kept there by a backend or replayed")
    parser.add_argument("--unanswered-only", action="store_true", help="ask only for notes that no answered prompt held")
    parser.add_argument("--max-batches-per-second", type=float, help="over all tasks together")
    parser.add_argument("--seconds-between-calls", type=float, default=C.RATE_LIMIT_SECONDS, help="of one task")
    parser.add_argument("--max-attempts", type=int, default=C.MAX_ATTEMPTS)
    parser.add_argument("--parallelism", type=int, help="tasks that call at once")
    parser.add_argument("--slices", type=int, default=1, help="jobs that the calls are split into")
    parser.add_argument("--run-id", help="name of this run; its rows are appended once")
    parser.add_argument("--organization", type=int)
    parser.add_argument("--max-rows", type=int, default=0, help="newest rows to keep; 0 keeps all")
    parser.add_argument("--batch-size", type=int, default=C.BATCH_SIZE)
    parser.add_argument("--extras", choices=("merge", "observed"), default="merge")
    parser.add_argument("--align", choices=("position", "nonblank"), default="position")
    parser.add_argument("--ignore-case", action="store_true")
    parser.add_argument("--billing-code", action="store_true", help="show the billed code beside each note")
    return parser.parse_args(given)


def responder(spark: SparkSession, options: argparse.Namespace):
    if options.backend:
        module, _, name = options.backend.partition(":")
        calls = extract.CallSettings(
            max_attempts=options.max_attempts,
            rate_limit_seconds=options.seconds_between_calls,
            max_batches_per_second=options.max_batches_per_second,
            parallelism=options.parallelism,
            extras=options.extras,
        )
        backend = getattr(importlib.import_module(module), name)
        return note_run.model_responder(backend, options.responses, calls, options.slices)
    if options.responses:
        earlier = spark.read.schema(RESPONSES).parquet(options.responses)
        return lambda prompts: earlier
    return None


def star_of(spark: SparkSession, options: argparse.Namespace):
    """The tables as they are, or without the rows that go to the rejects."""
    if options.star:
        star = tables.star_from_parquet(spark, options.star)
    elif options.database:
        star = tables.star_from_catalog(spark, options.database, typed=not options.rejects)
    else:
        connection = {"url": options.jdbc_url} | dict(option.split("=", 1) for option in options.jdbc_option)
        star = tables.star_from_jdbc(spark, connection, {t: t for t in STAR_TABLES}, typed=not options.rejects)
    if not options.rejects:
        return star
    star, rejects = tables.star_and_rejects(star)
    lost = sinks.append_to_path(rejects, options.rejects)
    print(f"{lost} values rejected")
    return star


def run(spark: SparkSession, options: argparse.Namespace) -> int:
    configure(spark)
    star = star_of(spark, options)
    settings = note_run.RunSettings.for_day_before(
        options.as_of,
        organization_key=options.organization,
        ignore_case=options.ignore_case,
        max_rows=options.max_rows or None,
        batch_size=options.batch_size,
        extras=options.extras,
        align=options.align,
        billing_code="ICD10_code" if options.billing_code else None,
    )
    with one_run(spark):
        respond = responder(spark, options)
        if options.unanswered_only:
            if not (options.backend and options.responses):
                raise SystemExit("--unanswered-only needs --backend and --responses")
            rows = note_run.cohort_rows(star, settings)
            done = note_run.run_unanswered(rows, settings, options.responses, respond)
        else:
            done = note_run.run_notes(star, settings, respond)
        # Written once: what follows reads it, not the joins behind it. The same job takes the figures.
        measured = measures.Measured(done.results)
        done = replace(done, results=stored(measured.records, "results"))
        if options.replace_day:
            day = options.as_of - dt.timedelta(days=1)
            written = done.replace_day(day, options.output, options.output_table)
        elif options.output:
            written = done.append_to(options.output, options.run_id)
        else:
            written = done.append_to_table(options.output_table, options.run_id)
        print(f"{written} rows written")
        if done.unmatched is not None:
            print(f"{done.unmatched.count()} responses answer other prompts")
        done.totals().show()
        done.validation().show()
        figures = measured.figures()
        print(f"{figures.total} records, {figures.removed} without content, {figures.completion_rate:.1f} % complete,")
        print(f"mean score {figures.mean_score:.3f}")
        for field, _, share in figures.top_fields():
            print(f"{field.replace('_', ' ').title():<25}{share:.1f} %")
    return written


if __name__ == "__main__":
    run(SparkSession.builder.appName("noteloom").getOrCreate(), arguments())
