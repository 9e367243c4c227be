"""Prompts to responses: a model behind a callable, or the cue rules."""

import math
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from noteloom import contract as C
from noteloom.functions.cues import cue_fields, with_cues
from noteloom.functions.prompts import prompt_digest
from noteloom.functions.responses import parse
from noteloom.schemas import RESPONSES
from noteloom.sources.journal import Journal


@dataclass(frozen=True)
class Reply:
    text: str | None
    prompt_tokens: int | None = None
    completion_tokens: int | None = None


# (system prompt, user prompt, token budget) -> text or Reply
Backend = Callable[[str, str, int], "Reply | str | None"]


@dataclass(frozen=True)
class CallSettings:
    max_attempts: int = C.MAX_ATTEMPTS
    backoff_seconds: float = 1.0  # doubled after every failed attempt
    rate_limit_seconds: float = C.RATE_LIMIT_SECONDS
    max_batches_per_second: float | None = None  # over all tasks together
    parallelism: int | None = None  # tasks that call at once; None takes the cluster's default
    extras: str = "merge"
    system_prompt: str = C.SYSTEM_PROMPT

    def tasks(self, default: int) -> int:
        """Tasks to call from."""
        return max(1, self.parallelism or default)

    def delay(self, tasks: int) -> float:
        """Seconds from one call of a task to its next, retries included: with it, ``tasks``
        tasks together keep to ``max_batches_per_second``."""
        if self.max_batches_per_second is None:
            return self.rate_limit_seconds
        return max(self.rate_limit_seconds, tasks / self.max_batches_per_second)


def _failure(text: str | None, extras: str) -> str | None:
    """Why a reply does not count, or None if it does."""
    if not (text or "").strip():
        return "empty response"
    _, records = parse(text)
    if not records:
        return "no records"
    if not all(isinstance(record, dict) for record in records):
        return "a record is not an object"
    if extras == "observed" and any(
        value and str(value).strip()
        for record in records
        for key, value in record.items()
        if key not in C.FIELDS
    ):
        return "unknown key"
    return None


class _Pace:
    """Lets one task call once per delay, and with slots only at times that are its own."""

    def __init__(self, delay: float, slots: "Slots | None" = None):
        self.delay, self.slots, self.next = delay, slots, 0.0

    def wait(self, pause: float = 0.0) -> None:
        """Until the next call is due, and at least ``pause`` seconds."""
        time.sleep(max(pause, self.next - time.monotonic(), 0.0))
        if self.slots is not None:
            self.slots.wait()
        self.next = time.monotonic() + self.delay


@dataclass(frozen=True)
class Slots:
    """Times at which one call may start, ``1 / rate`` seconds apart, for all tasks of a job.

    A slot belongs to the task that makes its file, so what a slow task leaves is taken by the others.
    ``folder`` is one that all machines mount; their clocks should agree to a fraction of a second.
    """

    folder: str
    rate: float
    start: float

    def wait(self) -> None:
        slot = math.ceil(max(0.0, time.time() - self.start) * self.rate)
        while not self._taken(slot):
            slot += 1
        time.sleep(max(0.0, self.start + slot / self.rate - time.time()))

    def _taken(self, slot: int) -> bool:
        place = f"{self.folder}/{slot // 10_000}"  # no folder of millions of files
        os.makedirs(place, exist_ok=True)
        try:
            os.close(os.open(f"{place}/{slot}", os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True


def _writable(text: str | None) -> str | None:
    """Without halves of character pairs, which no table can hold."""
    return None if text is None else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _attempts(backend: Backend, batch: dict, settings: CallSettings, pace: _Pace) -> Iterator[dict]:
    for attempt in range(1, settings.max_attempts + 1):
        pace.wait(settings.backoff_seconds * 2 ** (attempt - 2) if attempt > 1 else 0.0)
        began = time.monotonic()
        try:
            reply = backend(settings.system_prompt, batch["user_prompt"], batch["max_tokens"])
            reply = reply if isinstance(reply, Reply) else Reply(reply)
            error = _failure(reply.text, settings.extras)
        except Exception as problem:  # any failure of the call is one failed attempt
            reply, error = Reply(None), f"{type(problem).__name__}: {problem}"
        yield {
            "batch_id": batch["batch_id"],
            "prompt_digest": batch["prompt_digest"],
            "attempt": attempt,
            "raw": _writable(reply.text),
            "error": _writable(error),
            "prompt_tokens": reply.prompt_tokens,
            "completion_tokens": reply.completion_tokens,
            "elapsed_ms": round((time.monotonic() - began) * 1000),
        }
        if error is None:
            return


def call_backend(
    prompts: DataFrame,
    backend: Backend,
    settings: CallSettings = CallSettings(),
    journal: str | None = None,
    slots: Slots | None = None,
) -> DataFrame:
    """responses: one row per attempt.

    Calls cost money and differ from one run to the next, so write the result once
    (``stored`` or a sink) before reading it. Speculative tasks would call twice. With a ``journal``
    (``Folder.uri``) every call is kept there as soon as it is answered, and a task that is tried
    again does not repeat the calls that an earlier attempt of it got good answers to. With
    ``slots`` the rate holds over all tasks together, without a share for each.
    """
    spark = prompts.sparkSession
    if spark.sparkContext.getConf().get("spark.speculation", "false") == "true":
        raise ValueError("spark.speculation repeats calls; turn it off for this job")
    schema = to_arrow_schema(RESPONSES)

    # A stated number of partitions, as by their size alone a few would hold all prompts; by a
    # hash, as a repartition by batch_id is dropped where the prompts are grouped by it already.
    tasks = settings.tasks(spark.sparkContext.defaultParallelism)
    delay = settings.rate_limit_seconds if slots else settings.delay(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = _Pace(delay, slots)
        kept = Journal(journal, TaskContext.get().partitionId()) if journal else None
        earlier = kept.earlier() if kept else {}
        for record_batch in batches:
            for batch in record_batch.to_pylist():
                rows = earlier.get((batch["batch_id"], batch["prompt_digest"]))
                if rows is None:
                    rows = []
                    for row in _attempts(backend, batch, settings, pace):
                        if kept:
                            kept.add(row)
                        rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if kept:
            kept.close()

    digest = prompt_digest(F.lit(settings.system_prompt), F.col("user_prompt"))
    return (
        prompts.select("batch_id", digest.alias("prompt_digest"), "user_prompt", "max_tokens")
        .repartition(tasks, F.xxhash64("batch_id"))
        .mapInArrow(run, RESPONSES)
    )


def as_responses(df: DataFrame) -> DataFrame:
    """The columns of the responses table, null where ``df`` has none."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RESPONSES
        ]
    )


ANSWERED = ["batch_id", "prompt_digest"]


def pending(prompts: DataFrame, responses: DataFrame) -> DataFrame:
    """Prompts without a good response to exactly them: a rerun pays neither twice for an
    answer nor accepts that of other notes, and calls again what failed."""
    good = responses.filter(F.col("error").isNull() & F.col("raw").isNotNull())
    return prompts.join(good.select(*ANSWERED), ANSWERED, "left_anti")


def answers_to(prompts: DataFrame, responses: DataFrame) -> DataFrame:
    """Responses to exactly these prompts."""
    return _with_digest(responses).join(prompts.select(*ANSWERED), ANSWERED, "left_semi")


def unmatched(prompts: DataFrame, responses: DataFrame) -> DataFrame:
    """Responses to anything else, such as the notes of another day."""
    return _with_digest(responses).join(prompts.select(*ANSWERED), ANSWERED, "left_anti")


def _with_digest(responses: DataFrame) -> DataFrame:
    if "prompt_digest" not in responses.columns:
        raise ValueError("responses need a prompt_digest: their batch numbers alone could be another run's")
    return responses


def cue_records(
    notes: DataFrame,
    note: str = "Note",
    billing_name: str | None = None,
    billing_code: str | None = None,
) -> DataFrame:
    """The seven fields of every note by its labels and cues; other columns are kept."""
    name, code = (F.col(c) if c else None for c in (billing_name, billing_code))
    parts = with_cues(notes, note)
    return parts.select(*notes.columns, *cue_fields(F.col("_parts"), F.col("_lead"), name, code))
